"""Counts, histograms, digests and examples."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def cross_tab(df: DataFrame, a: str, b: str, separator: str = "/") -> DataFrame:
    """(cell 'a/b', n) of the combinations that occur."""
    return df.groupBy(F.concat_ws(separator, F.col(a).cast("string"), F.col(b).cast("string")).alias("cell")).agg(F.count("*").alias("n"))


def top_counts(df: DataFrame, key: str, k: int) -> DataFrame:
    """The k most frequent values, ties by value."""
    return counts(df, key).orderBy(F.desc("n"), key).limit(k)


def character_histogram(df: DataFrame, text: str) -> DataFrame:
    """(character, n) over all texts: counted within a row first, so that a row gives each character once."""
    chars = F.split(F.col(text), "")
    per_row = F.explode(F.transform(F.array_distinct(F.filter(chars, lambda c: c != "")), lambda c: F.struct(c.alias("character"), (F.length(text) - F.length(F.replace(F.col(text), c, F.lit("")))).alias("k"))))
    return df.select(per_row.alias("x")).groupBy("x.character").agg(F.sum("x.k").alias("n"))


def conditional_counts(df: DataFrame, **conditions: Column) -> DataFrame:
    return df.agg(F.count("*").alias("n"), *[F.count_if(c).alias(name) for name, c in conditions.items()])


def distinct_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Strings are told apart by SHA-256, so that no whole text is exchanged."""
    text = {f.name for f in df.schema if f.dataType.typeName() == "string"}
    return df.agg(*[F.countDistinct(F.sha2(c, 256) if c in text else F.col(c)).alias(f"n_{c}") for c in columns])


def largest_deviation(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.max(F.abs(F.col(a) - F.col(b))).alias("largest"))


def score_summary(df: DataFrame, group: str, score: str, full: float, valid: str) -> DataFrame:
    """(group, mean_score, fully_correct, all_valid)."""
    return df.groupBy(group).agg(F.avg(score).alias("mean_score"), F.count_if(F.col(score) == full).alias("fully_correct"), F.bool_and(valid).alias("all_valid"))


def first_examples(df: DataFrame, key: str, order: str, n: int = 2) -> DataFrame:
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn("example", F.row_number().over(w)).where(F.col("example") <= n)


def row_digest(*columns: str) -> Column:
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def dataset_digest(df: DataFrame, order: str, *columns: str, block: int = 100_000) -> DataFrame:
    """One digest of all rows in order: rows' digests by block of the order column (a number), then the blocks'.

    A hash over one stream of rows would run in one task; of blocks, each is hashed where it lies, and only a digest
    for each block of rows meets in the end."""
    rows = df.select(F.floor(F.col(order) / block).alias("_b"), F.col(order).alias("_o"), row_digest(*columns).alias("_d"))
    line = lambda name: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(name, "_d"))), lambda x: x["_d"]), "\n"), 256).alias("_d")
    return rows.groupBy("_b").agg(line("_o")).agg(line("_b").alias("digest"))


def id_list_digest(df: DataFrame, identity: str, *group: str, leaf: int = 4096) -> DataFrame:
    """(group, digest) of each group's ids, whatever their order and partitions.

    Up to leaf ids: SHA-256 of the sorted ids, a line each. Groups of more are dealt to parts by the first d hexadecimal
    digits of each id's SHA-256, the least d with leaf * 16 ** d ids or more; parts are digested like small groups, and
    the digests of up to 4096 neighbouring parts, in order of their digits, likewise, until one is left. So no task
    holds a whole group. d follows from the group's size alone, hence the digest from its ids. Null ids don't count,
    repeated ones do; a group of nulls only has the digest of nothing; an empty table gives an empty table."""
    text = F.col(identity).cast("string")
    keys = [F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]
    names = [f"_g{i}" for i in range(len(group))]
    ids = df.select(*keys, text.alias("_id"))
    sizes = ids.groupBy(*names).agg(F.count("_id").alias("_n"))
    depths = sizes.select(*names, F.greatest(F.lit(0), F.ceil(F.round(F.log(F.col("_n") / leaf) / math.log(16), 9))).cast("int").alias("_d"))
    deepest = depths.agg(F.max("_d")).first()[0] or 0
    same = lambda a, b: [F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}")) for n in names] or [F.lit(True)]
    if deepest:
        deep = depths.where("_d > 0")
        placed = ids.alias("x").join(deep.alias("y"), same("x", "y"), "left").select("x.*", F.coalesce("y._d", F.lit(0)).alias("_d"))
    else:
        placed = ids.withColumn("_d", F.lit(0))
    lines = lambda column: F.sha2(F.array_join(F.sort_array(F.collect_list(column)), "\n"), 256)
    parts = placed.where("_id is not null").select(*names, "_id", F.expr("substring(sha2(_id, 256), 1, _d)").alias("_part"))
    found = parts.groupBy(*names, "_part").agg(lines("_id").alias("_sha"))
    for _ in range(-(-deepest // 3)):
        # Each round takes up to three digits off; parts without digits stay as they are.
        shorter = F.expr("substring(_part, 1, greatest(length(_part) - 3, 0))")
        joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_part", "_sha"))), lambda x: x["_sha"]), "\n")
        whole = F.max(F.length("_part")) == 0
        found = found.groupBy(*names, shorter.alias("_up")).agg(F.when(whole, F.max("_sha")).otherwise(F.sha2(joined, 256)).alias("_sha")).withColumnRenamed("_up", "_part")
    void = sizes.where("_n = 0").select(*names, F.sha2(F.lit(""), 256).alias("_sha"))
    return found.drop("_part").unionByName(void).select(*[F.col(n).alias(g) for n, g in zip(names, group)], F.col("_sha").alias("digest"))


def numeric_summary(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quantiles by sketch: beyond what the curation operators need."""
    return df.groupBy(group).agg(F.count("*").alias("n"), F.percentile_approx(value, F.array(F.lit(0.5), F.lit(0.95)), 10_000).alias("quantiles"))
