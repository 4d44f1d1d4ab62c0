"""Seeded samples, quotas, round robins and splits. Hash order takes the place of a random generator: the same on any
number of machines. Where parity with CPython's generator is asked for, the drawn ids are computed on the driver."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_order(identity: Column, seed: str) -> Column:
    """SHA-256 of seed:identity: a random order that SQL engines agree on."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), identity.cast("string")), 256)


def hash_sample(df: DataFrame, identity: str, n: int, seed: str) -> DataFrame:
    """n rows in draw order; a top-n per task, then one merge of n rows a task."""
    return df.orderBy(hash_order(F.col(identity), seed), identity).limit(n)


def cpython_sample(df: DataFrame, identity: str, n: int, seed: int) -> DataFrame:
    """(identity, draw): what random.Random(seed).sample(sorted ids, n) draws. The generator is sequential, so the ids
    come to the driver: for universes of a size that a driver holds; use hash_sample beyond."""
    ids = sorted(r[0] for r in df.select(identity).distinct().collect())
    drawn = random.Random(seed).sample(ids, n)
    return df.sparkSession.createDataFrame([(x, i) for i, x in enumerate(drawn)], f"{identity} {dict(df.dtypes)[identity]}, draw int")


def stratified(df: DataFrame, stratum: str, identity: str, n: int, seed: str) -> DataFrame:
    """n rows of each stratum, the first in hash order; Spark keeps the top n of each task before it deals them."""
    w = Window.partitionBy(stratum).orderBy(hash_order(F.col(identity), seed), identity)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def largest_remainder(sizes: DataFrame, stratum: str, size: str, total: int) -> DataFrame:
    """sizes (a row a stratum) with quota: the floor of the proportional share, and one more for the largest remainders, ties by name."""
    everything = Window.partitionBy(F.lit(1))
    share = sizes.withColumn("_all", F.sum(size).over(everything)).withColumn("_floor", F.expr(f"({size} * {total}) div _all")).withColumn("_rest", F.expr(f"({size} * {total}) % _all"))
    rank = F.row_number().over(everything.orderBy(F.desc("_rest"), stratum))
    return share.withColumn("quota", (F.col("_floor") + F.when(rank <= total - F.sum("_floor").over(everything), 1).otherwise(0)).cast("long")).drop("_all", "_floor", "_rest")


def quota_sample(df: DataFrame, stratum: str, identity: str, total: int, seed: str) -> DataFrame:
    """total rows, strata in proportion: ranks in hash order against quotas."""
    quotas = largest_remainder(df.groupBy(stratum).agg(F.count("*").alias("_size")), stratum, "_size", total).select(stratum, "quota")
    w = Window.partitionBy(stratum).orderBy(hash_order(F.col(identity), seed), identity)
    # No quota is above total, which the planner knows: each task keeps that many rows of a stratum and sorts no more.
    top = df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= total)
    return top.join(quotas, stratum).where(F.col("_n") <= F.col("quota")).drop("_n", "quota")


def representatives(df: DataFrame, group: str, identity: str, seed: str) -> DataFrame:
    """(group, representative): the id of least hash; partial minima, no sort."""
    return df.groupBy(group).agg(F.min_by(identity, F.sha2(F.concat(F.lit(f"{seed}:representative:"), F.col(identity).cast("string")), 256)).alias("representative"))


def representative_quota_sample(df: DataFrame, group: str, stratum: str, identity: str, total: int, seed: str) -> DataFrame:
    """One row of each group, then strata in proportion: groups are unique in the sample."""
    one = representatives(df, group, identity, seed).select(F.col("representative").alias(identity))
    return quota_sample(df.join(one, identity, "left_semi"), stratum, identity, total, seed)


def round_robin(df: DataFrame, group: str, keys: list[str], n: int) -> DataFrame:
    """n rows, taking turns among groups: each group's largest keys first, groups by their largest key."""
    k = F.struct(*keys)
    top = df.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(*[F.desc(c) for c in keys]))).where(F.col("_n") <= n)
    ranked = top.withColumn("_most", F.max(k).over(Window.partitionBy(group)))
    return ranked.orderBy("_n", F.desc("_most"), *[F.desc(c) for c in keys]).limit(n).drop("_n", "_most")


def disjoint_split(df: DataFrame, group: str, fraction: float) -> DataFrame:
    """df with split: the first max(1, half-even round of groups * fraction) groups by name are 'validation', the rest
    'test'. Only the distinct groups are ranked, by ranges of names and the ranges' sizes, and rows join their group's
    split."""
    from sievemill.sources.tables import cut

    groups = cut(df.select(group).distinct().repartitionByRange(F.col(group)).withColumn("_range", F.spark_partition_id()))
    # A row a range, as many as there are shuffle partitions.
    ranges = groups.groupBy("_range").agg(F.count("*").alias("_size"))
    everything = Window.partitionBy(F.lit(1))
    ranges = ranges.select("_range", (F.sum("_size").over(everything.orderBy("_range")) - F.col("_size")).alias("_before"), F.sum("_size").over(everything).alias("_k"))
    ranked = groups.join(ranges, "_range").withColumn("_n", F.col("_before") + F.row_number().over(Window.partitionBy("_range").orderBy(group)))
    first = F.greatest(F.lit(1), F.bround(F.col("_k") * fraction).cast("long"))
    return df.join(ranked.select(group, F.when(F.col("_n") <= first, "validation").otherwise("test").alias("split")), group)


def opaque_ids(sample: DataFrame, order: Column, prefix: str, width: int = 3) -> DataFrame:
    """A drawn sample with blind ids by position; samples are small, so one ordered window is enough."""
    return sample.withColumn("opaque_id", F.format_string(f"{prefix}-%0{width}d", F.row_number().over(Window.orderBy(order)) - 1))


def wrong_alternative(value: Column, upper: Column, identity: Column, seed: str) -> Column:
    """One of 0 to upper other than value, by hash; null where there is none."""
    drawn = F.conv(F.substring(hash_order(identity, seed), 1, 8), 16, 10).cast("long")
    inside = value.between(0, upper)
    others = upper + 1 - inside.cast("int")
    at = F.pmod(drawn, F.greatest(others, F.lit(1)))
    return F.when(others > 0, at + F.when(inside & (at >= value), 1).otherwise(0)).cast("int")


def shuffled_options(options: Column, identity: Column, salt: str) -> Column:
    """array<string>, the gold option first -> struct(options array<struct(letter, text)>, gold) in hash order."""
    keyed = F.transform(options, lambda x, i: F.struct(F.sha2(F.concat_ws(":", F.lit(salt), identity.cast("string"), i.cast("string")), 256).alias("k"), i.alias("i"), x.alias("text")))
    mixed = F.array_sort(keyed)
    letter = lambda i: F.chr(F.lit(65) + i)
    return F.struct(F.transform(mixed, lambda x, i: F.struct(letter(i).alias("letter"), x["text"].alias("text"))).alias("options"), letter(F.array_position(F.transform(mixed, lambda x: x["i"]), F.lit(0)) - 1).alias("gold"))


def sampling_weight(population: Column, sample: int) -> Column:
    return population / sample


def take_ids(df: DataFrame, ids: DataFrame, key: str, position: str | None = None) -> DataFrame:
    """Rows of the requested ids, in the order of position where given; repeated and unknown ids fail as the plan runs."""
    from sievemill.operators.joins import lookup
    from sievemill.operators.validate import require_unique

    wanted = require_unique(ids.select(*([key, position] if position else [key])), key)
    out = lookup(wanted, df, key)
    return out.orderBy(position) if position else out


def unfinished(df: DataFrame, *done: DataFrame, key: str) -> DataFrame:
    """Rows that none of the logs has: where a run was cut off, it goes on."""
    for log in done:
        df = df.join(log.select(key), key, "left_anti")
    return df


def redrawn_difference(frozen: DataFrame, redrawn: DataFrame, key: str) -> DataFrame:
    """Keys that only one of a frozen sample and its repetition has; empty where the draw reproduces."""
    from sievemill.operators.joins import keys_match

    return keys_match(frozen, redrawn, key)
