"""Grouping, duplicates, conflicts, transitive groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exclude_duplicates(df: DataFrame, key: str, order: str, signature: str | Column, missing: Column) -> DataFrame:
    """Adds reason: 'missing' rows first leave the grouping; a key with several signatures makes all of its rows
    'conflict'; else all but the first in order are 'duplicate'; null means kept. order tells the rows of a key apart
    and isn't null.

    Keys that recur are counted by partial sums, and rows look theirs up, so a frequent key is no task's alone."""
    signature = F.col(signature) if isinstance(signature, str) else signature
    split = df.withColumn("_missing", F.coalesce(missing, F.lit(False)))
    grouped = split.where("not _missing").groupBy(F.col(key).alias("_key"))
    recurring = grouped.agg(F.count("*").alias("_n"), F.min(order).alias("_first"), (F.min(signature) != F.max(signature)).alias("_mixed")).where("_n > 1")
    found = split.join(recurring, ~F.col("_missing") & F.col(key).eqNullSafe(F.col("_key")), "left")
    reason = F.when(F.col("_missing"), "missing").when(F.col("_mixed"), "conflict").when(F.col(order) > F.col("_first"), "duplicate")
    return found.withColumn("reason", reason).drop("_missing", "_key", "_n", "_first", "_mixed")


def duplicate_report(df: DataFrame, key: str, order: str, signature: str, examples: int = 5) -> DataFrame:
    """One row: groups, rows in them, groups with several signatures, and the first rows of the first groups."""
    groups = df.groupBy(key).agg(F.count("*").alias("n"), F.min(order).alias("first"), (F.min(signature) != F.max(signature)).alias("mixed")).where("n > 1")
    counts = groups.agg(F.count("*").alias("n_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count_if("mixed").alias("n_conflicting"))
    firsts = groups.orderBy("first", key).limit(examples).agg(F.sort_array(F.collect_list("first")).alias("examples"))
    return counts.join(F.broadcast(firsts))


def first_by_normal_form(df: DataFrame, text: str, order: list[str]) -> DataFrame:
    """The first row of each text, stripped and in lower case."""
    w = Window.partitionBy(F.lower(F.trim(text))).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def latest(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key: an upsert of all rows in order."""
    w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def ordered_distinct(df: DataFrame, key: str, order: str) -> DataFrame:
    """Distinct keys in the order in which they first occur."""
    return df.groupBy(key).agg(F.min(order).alias("first")).orderBy("first")


def distinct_passages(df: DataFrame, key: list[str], passage: str, order: str, limit: int = 7000) -> DataFrame:
    """(key, text): a key's distinct passages in order, joined and cut off."""
    parts = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct(order, passage))), lambda x: x[passage]))
    return df.where(F.col(passage) != "").groupBy(*key).agg(F.substring(F.array_join(parts, " "), 1, limit).alias("text"))


def disjoint(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that both have: none where they are disjoint."""
    return a.select(key).intersect(b.select(key))


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 64) -> DataFrame:
    """(node, component: the least node reachable) of undirected edges.

    Each round takes the least label among neighbours and jumps to that label's own label, so that paths halve; the
    labels are written to the checkpoint folder every round. Nodes without edges don't occur."""
    from sievemill.sources.tables import cut

    both = cut(edges.select(F.col(a).alias("node"), F.col(b).alias("other")).union(edges.select(b, a)).distinct())
    labels = cut(both.groupBy("node").agg(F.least("node", F.min("other")).alias("component")))
    for _ in range(rounds):
        near = both.join(labels.select(F.col("node").alias("other"), "component"), "other").groupBy("node").agg(F.min("component").alias("near"))
        least = labels.join(near, "node").select("node", F.least("component", "near").alias("component"), F.col("component").alias("was"))
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("up"))
        labels = cut(least.join(up, "component", "left").select("node", F.least("component", F.coalesce("up", "component")).alias("component"), "was"))
        if labels.where("component <> was").isEmpty():
            return labels.select("node", "component")
        labels = labels.select("node", "component")
    raise RuntimeError(f"labels still moved after {rounds} rounds")


def group_digest(labels: DataFrame, node: str = "node", component: str = "component", leaf: int = 4096) -> DataFrame:
    """(component, group_id): the digest of the members as id_list_digest gives it, so that the name follows from them alone."""
    from sievemill.operators.aggregate import id_list_digest

    return id_list_digest(labels, node, component, leaf=leaf).withColumnRenamed("digest", "group_id")
