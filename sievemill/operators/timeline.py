"""Rows over time: as-of joins, interval joins and sessions, none of which needs a whole key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a time slice in an as-of join, on average.
SLICE_ROWS = 1_000_000
MICROS = 1_000_000


def as_number(df: DataFrame, column: str) -> Column:
    """Times as microseconds, dates as days' microseconds, numbers as they are."""
    kind = dict(df.dtypes)[column]
    return F.unix_micros(F.col(column).cast("timestamp")) if kind.startswith(("timestamp", "date")) else F.col(column)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_time: str,
    right_time: str,
    match: str,
    ties: list[str] | None = None,
    same_time: bool = True,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """left, and in match (a struct of right's columns, or null) the last row of right with equal keys up to left's time.

    Of right's rows at one time the last by ties counts. same_time: rows at left's own time count too. Both sides are cut
    into equal slices of time, as many as give slice_rows rows on average; each key and slice is sorted by itself, behind
    a row that carries the last match of the slices before. These rows come from partial maxima, one for each key and
    slice, so a key with a third of all rows is spread over its slices.

    Rows of left with a null in keys or time stay without a match; such rows of right take no part. Repeated rows of left
    stay repeated. match must not be a column of left; other columns of both sides may share names."""
    if match in left.columns:
        raise ValueError(f"left has a column {match}")
    whole = lambda df, time: [F.col(c).isNotNull() for c in (*keys, time)]
    both = lambda conditions: F.expr("true") if not conditions else conditions[0] & both(conditions[1:])
    usable, skipped = both(whole(left, left_time)), ~both(whole(left, left_time))
    names = [f"_k{i}" for i in range(len(keys))]
    keyed = [F.col(k).alias(n) for k, n in zip(keys, names)]
    tie = F.struct(*[F.col(c) for c in ties]) if ties else F.lit(None)
    first, second = (0, 1) if same_time else (1, 0)
    r = right.where(both(whole(right, right_time))).select(
        *keyed, as_number(right, right_time).alias("_t"), F.lit(first).alias("_side"), tie.alias("_tie"), F.struct("*").alias("_right")
    )
    r = r.withColumn("_left", F.lit(None).cast(left.select(F.struct("*").alias("s")).schema["s"].dataType))
    l = left.where(usable).select(*keyed, as_number(left, left_time).alias("_t"), F.lit(second).alias("_side"), F.struct("*").alias("_left"))
    l = l.withColumn("_tie", F.lit(None).cast(r.schema["_tie"].dataType)).withColumn("_right", F.lit(None).cast(r.schema["_right"].dataType))
    rows = r.unionByName(l)
    low, high, n = rows.agg(F.min("_t"), F.max("_t"), F.count("*")).first()
    width = max((high - low) / max(1, -(-n // slice_rows)), 1e-9) if n else 1
    sliced = rows.withColumn("_slice", F.floor((F.col("_t") - F.lit(low)) / F.lit(width)))
    place = F.when(F.col("_side") == first, F.struct("_t", "_tie"))
    ends = sliced.groupBy(*names, "_slice").agg(F.max_by("_right", place).alias("_last"))
    before = Window.partitionBy(*names).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_right", F.last("_last", ignorenulls=True).over(before)).where("_right is not null").drop("_last")
    for c in ("_t", "_tie", "_left"):
        carried = carried.withColumn(c, F.lit(None).cast(sliced.schema[c].dataType))
    running = Window.partitionBy(*names, "_slice").orderBy(F.asc_nulls_first("_t"), "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    found = sliced.unionByName(carried.withColumn("_side", F.lit(-1))).withColumn("_match", F.last("_right", ignorenulls=True).over(running))
    matched = found.where(F.col("_side") == second).where("_left is not null").select("_left.*", F.col("_match").alias(match))
    return matched.unionByName(left.where(skipped).withColumn(match, F.lit(None).cast(r.schema["_right"].dataType)))


def interval_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_ends: tuple[str, str], right_ends: tuple[str, str], names: tuple[str, str] = ("l", "r")
) -> DataFrame:
    """Two structs of each pair with equal keys whose half-open intervals [start, end) overlap. Ends are whole numbers or times.

    An interval of length n lies in one or two bins of the power of two at or above n, its level. A pair meets at the larger
    of its levels: each side goes to the bins of its own level and of the other side's larger ones, at most two for a level,
    so long intervals among short ones cost no more bins. The bin is part of an equality join; a pair is told in the bin
    where the later one starts, hence once, and the exact condition follows.

    Intervals with a null or without a positive length overlap nothing; so do null keys. Repeated rows pair repeatedly.
    An empty side gives no pairs."""

    def leveled(df: DataFrame, ends: tuple[str, str], name: str) -> DataFrame:
        out = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.struct("*").alias(name), *[as_number(df, e).cast("long").alias(x) for e, x in zip(ends, ("_a", "_b"))])
        out = out.where("_b > _a").withColumn("_own", F.length(F.bin(F.col("_b") - F.col("_a") - 1)))
        return out.withColumn("_own", F.when(F.col("_b") - F.col("_a") == 1, 0).otherwise(F.col("_own")).cast("int"))

    l, r = leveled(left, left_ends, names[0]), leveled(right, right_ends, names[1])
    # Which levels a side has: 64 at most, a subquery of one row.
    present = lambda df: df.agg(F.collect_set("_own").alias("_levels")).scalar()

    def dealt(df: DataFrame, other: DataFrame) -> DataFrame:
        own = F.col("_own")
        levels = F.array_union(F.array(own), F.filter(F.col("_levels"), lambda x: x > own))
        spread = df.withColumn("_levels", present(other)).withColumn("_level", F.explode(levels)).drop("_levels")
        low, high = F.expr("shiftright(_a, _level)"), F.expr("shiftright(_b - 1, _level)")
        return spread.withColumn("_first", low).withColumn("_bin", F.explode(F.sequence(low, high)))

    on = [*[f"_k{i}" for i in range(len(keys))], "_level", "_bin"]
    l, r = dealt(l, r).alias("x"), dealt(r, l).alias("y")
    once = F.greatest("x._first", "y._first") == F.col("_bin")
    met = (F.greatest("x._own", "y._own") == F.col("_level")) & once & (F.col("x._a") < F.col("y._b")) & (F.col("y._a") < F.col("x._b"))
    return l.join(r, on).where(met).select(*names)


def sessions(df: DataFrame, keys: list[str], time: str, gap: str, *measures: Column) -> DataFrame:
    """(keys, start, end: the last row's time and the gap, n, measures) of each session: rows of a key at most gap apart.

    Rows with a null time belong to none; a null key is a key. On a stream with a watermark on time, a session is told once
    the watermark has passed its end, and late rows are dropped."""
    column = F.col(time) if dict(df.dtypes)[time] == "timestamp" else F.col(time).cast("timestamp")  # a cast would lose the watermark
    window = F.session_window(column, gap)
    grouped = df.where(F.col(time).isNotNull()).groupBy(window.alias("_w"), *keys).agg(F.count("*").alias("n"), *measures)
    return grouped.select(*keys, F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *[c for c in grouped.columns if c not in ("_w", *keys)])
