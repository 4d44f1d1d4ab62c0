"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key divided by its quality weight. A source takes complete epochs of all its
documents first; what is left of its target goes to the documents with the smallest keys, by a prefix sum of sizes.
Keys are dealt to buckets of their distribution, so a source's prefix sum is one over bucket totals and one inside
each bucket: no source, however large, is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemill.llm.common import cut, tuck, untuck, word_count

#: Buckets of keys, for each source: so many that a bucket has about ROWS rows, within these bounds.
ROWS, LEAST_BUCKETS, MOST_BUCKETS = 1 << 16, 64, 1 << 20
SEED = 17


def exponential_key(identity: Column, weight: Column, seed: int) -> Column:
    """-ln(u) / weight, u uniform in (0, 1) from a hash of the identity (a string): the same at every run."""
    first = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), identity).cast("binary")), 1, 13)
    u = (F.conv(first, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / weight


def quality_weight(text: Column, size: Column) -> Column:
    """In [0.2, 1]: highest where characters per word are as in prose; a text without words weighs 0.2."""
    per_word = F.length(text) / F.greatest(size, F.lit(1))
    return F.greatest(F.lit(0.2), F.coalesce(1 / (1 + F.abs(per_word - F.lit(6.5)) / 3), F.lit(0.2)))


def source_targets(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(source_key, source, source_size) -> the same with target double.

    Sources in code point order, null last, weigh as cycle repeats and share the sum of all sizes; a target stops at
    cap times its source's size. Resharing the excess until none is above ends at the level L with
    target = min(cap * size, L * weight), found by one pass over the sources by cap / weight. The windows have one row
    a source, never one a document.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in cycle]), (place % len(cycle) + 1).cast("int"))
    ranked = sizes.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * cap)
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), "source_key")
    before, after, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing), by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    ranked = ranked.withColumn("_level", left / F.sum("_w").over(after)).withColumn("_free", F.col("_cap") / F.col("_w") >= F.col("_level"))
    level = F.first(F.when(F.col("_free"), F.col("_level")), ignorenulls=True).over(everything)
    return ranked.withColumn("target", F.least(F.col("_cap").cast("double"), F.coalesce(level, F.lit(0.0)) * F.col("_w"))).select("source_key", "source", "source_size", "target")


def mix(df: DataFrame, size: str, weight: str, identity: str = "doc_id", source: str = "source", cycle: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: int = SEED, totals: DataFrame | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    """df with source_size, target, copies and taken (copies * size), which replace columns of these names; all rows and
    other columns stay. totals: the same rows' identity, ties, source, size and weight, where they are at hand as a written
    table; sums then come from it and df is read once. ties: columns that tell rows with one identity apart, as hashes of
    what they hold; the first goes into the key, all into its order.

    Nulls: a null source is a source of its own, last in order; a null identity is one of its own, told apart by ties.
    Rows of size 0 take 0 words. Rows equal in identity and ties draw equal keys, and either may be the one that the
    boundary falls to: they are equal throughout, so reruns agree. An empty table gives an empty table.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))
    name = F.concat(F.coalesce(F.col(identity).cast("string"), F.lit("~")), F.lit(":"), F.col(ties[0]) if ties else F.lit(""))

    def keyed(d: DataFrame, buckets: int) -> DataFrame:
        drawn = d.withColumn("_source_key", key).withColumn("_key", exponential_key(name, F.col(weight), seed))
        return drawn.withColumn("_bucket", F.floor((1 - F.exp(-F.col("_key"))) * buckets).cast("int"))

    known = df if totals is None else totals
    wide = min(MOST_BUCKETS, max(LEAST_BUCKETS, known.count() // ROWS))
    rows = keyed(df, wide)
    buckets = keyed(known, wide).groupBy(F.col("_source_key").alias("source_key"), F.col("_bucket").alias("bucket")).agg(F.first(source).alias("source"), F.sum(size).alias("bucket_size"))
    targets = source_targets(buckets.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("bucket_size").alias("source_size")), cycle, cap)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = buckets.drop("source").join(targets.drop("source"), "source_key").select(
        F.col("source_key").alias("_source_key"),
        F.col("bucket").alias("_bucket"),
        "source_size",
        "target",
        epochs.alias("_epochs"),
        F.coalesce(F.sum("bucket_size").over(Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy("_source_key", "_bucket").orderBy("_key", identity, *ties).rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("_before") + F.coalesce(F.sum(size).over(inside), F.lit(0))
    # The document across the boundary is taken where more than half of it fits.
    chosen = (at + F.col(size) / 2 <= F.col("target") - F.col("_epochs") * F.col("source_size")) & (F.col(size) > 0)
    joined = rows.join(plan, ["_source_key", "_bucket"]).withColumn("copies", F.col("_epochs") + F.when(chosen, 1).otherwise(0))
    return joined.withColumn("taken", F.col("copies") * F.col(size)).drop("_source_key", "_key", "_bucket", "_epochs", "_before")


def with_size_and_weight(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text and others) with size, weight and tie, a hash of the text."""
    sized = docs.withColumn("size", word_count(F.col("text"))).withColumn("tie", F.md5(F.coalesce(F.col("text"), F.lit("~")).cast("binary")))
    return sized.withColumn("weight", quality_weight(F.col("text"), F.col("size")))


def repeat_documents(docs: DataFrame) -> DataFrame:
    """Each row of docs (doc_id, source, text and others) as many times as the mix takes it; other columns may have any
    names. Null or empty texts have no words and are not taken; null sources and ids, repeated rows and empty tables are
    as for mix."""
    tucked = with_size_and_weight(tuck(docs, "doc_id", "source", "text"))
    # Rows that differ in other columns only are told apart by these.
    tucked = tucked.withColumn("others", F.xxhash64("_rest"))
    known = cut(tucked.select("doc_id", "source", "size", "weight", "tie"))
    taken = mix(tucked, "size", "weight", totals=known, ties=("tie", "others")).where("copies > 0")
    return untuck(taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))), docs.columns, "doc_id", "source", "text")


def op1_mixing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    slim = cut(with_size_and_weight(docs).select("doc_id", "source", "size", "weight", "tie"))
    return mix(slim, "size", "weight", ties=("tie",)).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


#: The same with one window a source in place of buckets, and the level of the targets found source by source.
OP1_SQL = f"""
with d as (select doc_id, source, text, cast(coalesce(len(list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')), 0) as bigint) size from documents),
w as (select *, greatest(0.2::double, coalesce(1 / (1 + abs(length(text) / greatest(size, 1) - 6.5::double) / 3), 0.2::double)) weight from d),
k as (select *, -ln((cast(('0x' || substr(md5('{SEED}:' || coalesce(cast(doc_id as varchar), '~') || ':' || md5(coalesce(text, '~'))), 1, 13)) as bigint) + 0.5::double) / {float(1 << 52)!r}::double) / weight draw from w),
s as (select source, sum(size)::bigint source_size, row_number() over (order by source nulls last) - 1 place from k group by source),
v as (select *, case place % 3 when 0 then 1 when 1 then 2 else 3 end share, source_size * 3 cap from s),
o as (select *, (sum(source_size) over () - coalesce(sum(cap) over (order by cap / share, source nulls first rows between unbounded preceding and 1 preceding), 0))
  / sum(share) over (order by cap / share, source nulls first rows between current row and unbounded following) level from v),
g as (select source, source_size, least(cap::double, coalesce((select arg_min(level, {{'ratio': cap / share, 'key': coalesce('=' || source, '')}}) from o where cap / share >= level), 0.0::double) * share) target from o),
e as (select k.*, source_size, target, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end epochs,
  coalesce(sum(size) over (partition by k.source order by draw, doc_id, md5(coalesce(text, '~')) rows between unbounded preceding and 1 preceding), 0) before from k join g on k.source is not distinct from g.source)
select doc_id, size, source_size, target, source, copies, copies * size taken from (
  select *, epochs + case when size > 0 and before + size / 2 <= target - epochs * source_size then 1 else 0 end copies from e)"""
