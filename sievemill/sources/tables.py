"""Lineage cuts in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """Write df and read it back. The folder is spark.checkpoint.dir; where a local session names none, a temporary one."""
    spark = df.sparkSession
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        context = spark.sparkContext._jsc.sc()
        if context.getCheckpointDir().isEmpty():
            if not context.isLocal():
                raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sievemill-"))
        top = context.getCheckpointDir().get()
    path = f"{top.rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
