"""Streams: resumable review queues as Structured Streaming, beyond the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def timed(stream: DataFrame, time: str, delay: str) -> DataFrame:
    """A watermark on time, which may be without a zone."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def first_of_key(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """The first row of each key within delay; state older than that is let go."""
    return timed(stream, time, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, time: str, key: str, delay: str, width: str, slide: str | None = None) -> DataFrame:
    """(start, end, key, n) of each window once the watermark has passed it."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return timed(stream, time, delay).groupBy(window.alias("w"), key).agg(F.count("*").alias("n")).select("w.start", "w.end", key, "n")


def process_new(batch: DataFrame, log_path: str, key: str) -> None:
    """foreachBatch step: rows whose key the log doesn't have are appended to it, one of each key, so a batch may run twice."""
    spark = batch.sparkSession
    new = batch.dropDuplicates([key])
    try:
        done = spark.read.parquet(log_path).select(key)
    except Exception as e:  # the first batch finds no log
        if "PATH_NOT_FOUND" not in str(e):
            raise
    else:
        new = new.join(done, key, "left_anti")
    new.write.mode("append").parquet(log_path)
