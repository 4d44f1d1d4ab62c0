"""sievemill: Spark operators for curating, auditing and scoring datasets."""
