"""Calls to a service outside, each made once: an append-only log of what was answered."""

from __future__ import annotations

import time
import urllib.error
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG = "stage string, index long, request_sha256 string, status string, body string, attempts array<struct<attempt: int, seconds: double, error_type: string, http_status: int>>"


def may_succeed(error: Exception) -> bool:
    """Whether trying again can help: time-outs, lost connections, 429 and errors of the server."""
    code = getattr(error, "code", None)
    if isinstance(error, urllib.error.HTTPError):
        return code == 429 or code >= 500
    return isinstance(error, (TimeoutError, urllib.error.URLError, ConnectionError))


def called(text: str, send: Callable[[str], str], tries: int, wait: float) -> tuple[str, str | None, list[dict]]:
    """(status 'ok' or 'error', body, attempts) of one request."""
    attempts = []
    for number in range(1, tries + 1):
        began = time.time()
        try:
            body = send(text)
        except Exception as e:  # noqa: BLE001, whatever the sender raises is told in the log
            attempts.append({"attempt": number, "seconds": time.time() - began, "error_type": type(e).__name__, "http_status": getattr(e, "code", None)})
            if not may_succeed(e):
                break
            if number < tries:
                time.sleep(wait)
        else:
            attempts.append({"attempt": number, "seconds": time.time() - began, "error_type": None, "http_status": None})
            return "ok", body, attempts
    return "error", None, attempts


def logged(spark, log_path: str) -> DataFrame:
    """The log, which is begun if it isn't there."""
    spark.createDataFrame([], LOG).write.mode("append").parquet(log_path)
    return spark.read.schema(LOG).parquet(log_path)


def called_once(
    rows: DataFrame, stage: str, index: str, request: str, send: Callable[[str], str], log_path: str, tries: int = 2, wait: float = 3.0, rounds: int = 16
) -> DataFrame:
    """rows with status, body, attempts and same_request of their calls; (stage, index) names a call.

    What the log names is not sent again, whether it was answered or failed. Calls go out in rounds by a hash of their
    names, and each round is appended to the log before the next one starts; so a run that breaks off has lost the answers
    of one round at most, and the next run sends the rest. same_request is false where the logged request was another one.

    Rows without a stage, an index or a request aren't sent and get nulls. Rows with one name are one call, whose request
    is the least of theirs. A lost executor's tasks run again, and with them their calls of that round. log_path is in a
    store that all executors write to."""
    if clash := {"status", "body", "attempts", "same_request"} & set(rows.columns):
        raise ValueError(f"columns {sorted(clash)} are there already")
    spark = rows.sparkSession
    named = rows.select(F.col(stage).cast("string").alias("stage"), F.col(index).cast("long").alias("index"), F.col(request).alias("_request"))
    wanted = named.dropna().groupBy("stage", "index").agg(F.min("_request").alias("_request")).withColumn("_round", F.pmod(F.xxhash64("stage", "index"), F.lit(rounds)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [called(text, send, tries, wait) for text in frame["_request"]]
            out = frame[["stage", "index", "request_sha256"]].copy()
            out["status"], out["body"], out["attempts"] = ([m[i] for m in made] for i in range(3))
            yield out

    for k in range(rounds):
        done = logged(spark, log_path).select("stage", "index")
        todo = wanted.where(F.col("_round") == k).join(done, ["stage", "index"], "left_anti")
        todo = todo.select("stage", "index", F.sha2("_request", 256).alias("request_sha256"), "_request")
        todo.mapInPandas(run, LOG).write.mode("append").parquet(log_path)
    # Tasks that ran twice may have logged a call twice: one of the answers counts for all rows.
    log = logged(spark, log_path).groupBy("stage", "index").agg(F.max_by(F.struct("request_sha256", "status", "body", "attempts"), F.struct("status", "body")).alias("_log"))
    keyed = rows.withColumn("_stage", F.col(stage).cast("string")).withColumn("_index", F.col(index).cast("long"))
    met = keyed.join(log.select(F.col("stage").alias("_stage"), F.col("index").alias("_index"), "_log"), ["_stage", "_index"], "left")
    answer = F.when(F.col(request).isNotNull(), F.col("_log"))
    return met.select(
        *[F.col(f"`{c}`") for c in rows.columns], answer["status"].alias("status"), answer["body"].alias("body"), answer["attempts"].alias("attempts"),
        (answer["request_sha256"] == F.sha2(F.col(request), 256)).alias("same_request"),
    )
