"""Joins as curation uses them: lookups that must hit, eligibility, pairs, tolerances, containment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.functions import fixed
from sievemill.operators.validate import close


def lookup(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join that fails, as the plan runs, on a key without a partner. Spark picks the strategy by size."""
    found = left.join(right.withColumn("_hit", F.lit(True)), key, "left")
    ok = F.when(F.col("_hit"), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("no partner for "), F.col(key).cast("string"))))
    return found.where(ok).drop("_hit")


def eligible(left: DataFrame, right: DataFrame, key: str, reason: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a partner, joined; rows without, with reason)."""
    return left.join(right, key), left.join(right.select(key), key, "left_anti").withColumn("reason", F.lit(reason))


def relabel(df: DataFrame, sample: DataFrame, key: str, new: str) -> DataFrame:
    """Rows of df whose key is in sample (key, new), under the new name alone."""
    return df.join(sample.select(key, new), key).drop(key)


def pair_sides(pairs: DataFrame, rows: DataFrame, pair_id: str, sides: dict[str, str], key: str, values: list[str]) -> DataFrame:
    """Each side of a pair looks up its row: (pair_id, n_<side>, <value>_<side>...). A side counts only where it has just one row. One join for all sides."""
    stacked = pairs.select(pair_id, F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(c).alias(key)) for s, c in sides.items()])).alias("x")).select(pair_id, "x.*")
    joined = stacked.join(rows.select(key, *values, F.lit(1).alias("_hit")), key, "left")
    on = lambda s: F.col("side") == s
    counts = [F.sum(F.when(on(s), F.coalesce("_hit", F.lit(0))).otherwise(0)).alias(f"n_{s}") for s in sides]
    found = [F.max(F.when(on(s), F.col(v))).alias(f"{v}_{s}") for s in sides for v in values]
    one = lambda v, s: F.when(F.col(f"n_{s}") == 1, F.col(f"{v}_{s}")).alias(f"{v}_{s}")
    return joined.groupBy(pair_id).agg(*counts, *found).select(pair_id, *[f"n_{s}" for s in sides], *[one(v, s) for s in sides for v in values])


def tolerant_join(left: DataFrame, right: DataFrame, key: list[str], a: Column, b: Column, absolute: float, relative: float = 0.0) -> DataFrame:
    """Equal keys, and values within a tolerance: the equality deals the rows, the tolerance is a filter on the join."""
    return left.join(right, key).where(close(a, b, absolute, relative))


def keys_match(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side): keys that only one side has; empty where both have the same."""
    a, b = left.select(key).distinct().withColumn("_a", F.lit(1)), right.select(key).distinct().withColumn("_b", F.lit(1))
    return a.join(b, key, "full_outer").where("_a is null or _b is null").select(key, F.when(F.col("_b").isNull(), "left").otherwise("right").alias("side"))


def missing_keys(wanted: DataFrame, available: DataFrame, key: str) -> DataFrame:
    return wanted.select(key).distinct().join(available.select(key), key, "left_anti")


def planned_outcomes(planned: DataFrame, trials: DataFrame, key: str) -> DataFrame:
    """All planned rows; those without a trial have nulls and stay in every denominator."""
    return planned.join(trials, key, "left")


def prefix_join(left: DataFrame, right: DataFrame, name: str, delimiter: str, key: str) -> DataFrame:
    """left's name up to the delimiter equals right's key: an equality join, not a scan for prefixes."""
    return left.withColumn(key, F.substring_index(F.col(name), delimiter, 1)).join(right, key)


def containment_join(
    long: DataFrame, short: DataFrame, long_text: str, short_text: str, long_keys: list[str], short_keys: list[str], k: int = 16, frequent: int = 10_000
) -> DataFrame:
    """Pairs where short_text is a substring of long_text; empty and null texts are in none. Keys tell rows apart.

    The long text is cut into blocks of k characters. A string of 2k - 1 characters or more that occurs in it lies at one of
    k alignments to the blocks, and all its whole blocks there are blocks of the text. So blocks are counted over all long
    texts, and for each alignment the string meets texts by its rarest block only; an alignment with a block that no text
    has is none. Keys and blocks meet; texts join the pairs that share one and are checked. Shorter strings do the same with
    blocks of half the size, and so on down to single characters; texts are cut into the sizes that the strings have, which
    a subquery of one row tells. A block in more than frequent texts is dealt to several tasks, strings to all of these.
    """
    t, s = F.col(long_text), F.col(short_text)
    sizes = [k >> i for i in range(k.bit_length())]
    size = F.lit(None).cast("int")
    for j in reversed(sizes):
        size = F.when(F.length(s) >= 2 * j - 1, j).otherwise(size)
    used = short.where(F.length(s) > 0).agg(F.collect_set(size).alias("_sizes")).scalar()
    blocks = []
    for j in sizes:
        cuts = F.regexp_extract_all(t, F.lit(f"(?s).{{{j}}}"), 0)
        blocks.append(F.when(F.array_contains(F.col("_sizes"), j), cuts).otherwise(F.array().cast("array<string>")))
    left = long.withColumn("_sizes", used).select(*long_keys, F.explode(F.array_distinct(F.concat(*blocks))).alias("_gram"))
    counted = left.groupBy("_gram").agg(F.count("*").alias("_texts"))

    strings = short.where(F.length(s) > 0).select(*short_keys, s.alias("_s"), size.alias("_size"))
    at = F.posexplode(F.sequence(F.lit(1), F.length("_s") - F.col("_size") + 1)).alias("_at", "_from")
    grams = strings.select(*short_keys, "_s", "_size", at).select(*short_keys, (F.col("_at") % F.col("_size")).alias("_shift"), F.expr("substring(_s, _from, _size)").alias("_gram"))
    rarest = grams.join(counted, "_gram", "left").groupBy(*short_keys, "_shift").agg(
        F.min(F.coalesce("_texts", F.lit(0))).alias("_texts"), F.min_by("_gram", F.struct("_texts", "_gram")).alias("_gram")
    )
    parts = F.ceil(F.col("_texts") / frequent).cast("int")
    right = rarest.where("_texts > 0").select(*short_keys, "_gram", parts.alias("_parts")).distinct()
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    split = counted.where(F.col("_texts") > frequent).select("_gram", parts.alias("_parts"))
    dealt = left.join(split, "_gram", "left").withColumn("_salt", F.pmod(F.hash(*long_keys), F.coalesce("_parts", F.lit(1)))).drop("_parts")
    pairs = dealt.join(right, ["_gram", "_salt"]).select(*long_keys, *short_keys).distinct()
    return pairs.join(long, long_keys).join(short, short_keys).where(t.contains(s)).select(*long.columns, *short.columns)


def passages_around(documents: DataFrame, labels: DataFrame, group: str, text: str, label: str, reach: int = 2200) -> DataFrame:
    """(group, label, passage): text around each mention \\ref{label} in the documents of the label's group.

    Documents give their mentions once, and labels meet them by equality."""
    parts = F.split(F.col(text), fixed.TEX_MENTION, -1)
    names = F.regexp_extract_all(text, F.lit(fixed.TEX_MENTION), 1)
    # Text before mention i is all parts up to i, with the mentions between them; lengths are enough for its place.
    found = documents.select(group, F.col(text).alias("_t"), F.posexplode(names).alias("_i", label), parts.alias("_p"))
    head = F.array_join(F.slice("_p", 1, F.col("_i") + 1), " ")
    tail = F.array_join(F.slice("_p", F.col("_i") + 2, F.size("_p")), " ")
    passages = found.select(group, label, F.concat(F.substring(head, F.greatest(F.lit(1), F.length(head) - reach + 1), F.lit(reach)), F.lit(" "), F.substring(tail, 1, reach)).alias("passage"))
    return passages.join(labels.select(group, label).distinct(), [group, label])
