"""Shared pieces: documents as (doc_id, text), lineage cuts, byte-level word scanning."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java pattern of the white space that separates words; every other character is part of a word.
SPACES = "[\\x20\\x09-\\x0D]+"

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_P = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where a local session names none (tests), a temporary one is set."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        jsc = spark.sparkContext._jsc.sc()
        if jsc.getCheckpointDir().isEmpty():
            if not jsc.isLocal():
                raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sievemill-"))
        found = jsc.getCheckpointDir().get()
    return found.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write df once to the shared folder and read it back: lineage ends here and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/sievemill-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._written = path
    return back


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df written once to the shared folder in buckets by keys, a file each, and read back: joins on the keys leave it where it is."""
    spark, n, name = df.sparkSession, partitions(df.sparkSession), f"sievemill_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    buckets = df.repartition(n, *keys).write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(n, *keys)
    buckets.saveAsTable(name)
    back = spark.table(name)
    back._written = path
    return back


def release(*tables: DataFrame) -> None:
    """Delete tables that cut wrote and that nothing reads any more; other tables are left alone."""
    for df in tables:
        if path := getattr(df, "_written", None):
            spark = df.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tuck(docs: DataFrame, *names: str) -> DataFrame:
    """docs as names and _rest, a struct of all other columns, so that columns added meanwhile clash with none of them."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    return docs.select(*names, (F.struct(*others) if others else F.struct(F.lit(0).alias("none"))).alias("_rest"))


def untuck(tucked: DataFrame, columns: list[str], *names: str) -> DataFrame:
    return tucked.select(*[F.col(c) if c in names else F.col(f"_rest.`{c}`") for c in columns])


def word_count(text):
    """Words of a string column, counted in the JVM; null counts as 0."""
    return F.coalesce(F.size(F.filter(F.split(text, SPACES), lambda w: w != "")), F.lit(0)).cast("long")


def words(text):
    """Words of a string column in order; null gives an empty array."""
    return F.coalesce(F.filter(F.split(text, SPACES), lambda w: w != ""), F.array().cast("array<string>"))


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 of a string column; null becomes empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def chunks(sizes: list[int], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows holding about limit bytes, one row at least."""
    at = total = 0
    for i, n in enumerate(sizes):
        if i > at and total + n > limit:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; bijective."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 5 << 18)
        tables = []
        for base in (_P, pow(_P, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers[:] = tables
    return _powers[0], _powers[1]


class Words:
    """Words of some texts: doc (index of the text), starts and ends in raw (the texts, each followed by a space), hash (64 bits of the word, by default with A-Z lower-cased), first (index of each text's first word, and the total at the end)."""

    def __init__(self, texts: list[bytes], lower: bool = True):
        raw = self.raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        low = _LOWER[raw] if lower else raw
        inside = np.zeros(len(raw) + 1, np.int8)
        inside[1:] = ~_SPACE[raw]
        step = np.diff(inside)
        self.starts = np.flatnonzero(step == 1)
        self.ends = np.flatnonzero(step == -1)
        offsets = self.offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
        self.first = np.searchsorted(self.starts, offsets)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        power, inverse = _power_tables(len(raw))
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[: len(raw)], out=sums[1:])
        self.hash = mix((sums[self.ends] - sums[self.starts]) * inverse[self.starts] + (self.ends - self.starts).astype(np.uint64))


def gram_hashes(word_hash: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; the last n - 1 positions have none."""
    if len(word_hash) < n:
        return np.zeros(0, np.uint64)
    m = len(word_hash) - n + 1
    total = word_hash[:m].copy()
    for i in range(1, n):
        total = total * np.uint64(0xD6E8FEB86659FD93) + word_hash[i : i + m]
    return mix(total)


def pack(bucket_of: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """Rows grouped by bucket, each column of a bucket as bytes; order within a bucket is kept."""
    if not len(bucket_of):
        return
    order = np.argsort(bucket_of, kind="stable")
    ranked = bucket_of[order]
    edges = np.concatenate([[0], np.flatnonzero(np.diff(ranked)) + 1, [len(ranked)]])
    columns = [c[order] for c in columns]
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(ranked[a]), [c[a:b].tobytes() for c in columns]
