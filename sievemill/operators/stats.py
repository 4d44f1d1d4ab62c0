"""Rates, intervals and gates as column expressions over counted rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.functions.fixed import GATE, Z


def rate(errors: Column, n: Column) -> Column:
    return F.when(n > 0, errors / n)


def wilson(successes: Column, n: Column, pinned: bool = True) -> Column:
    """struct(low, high), the 95 % score interval within [0, 1]; null for n = 0. pinned: no successes give exactly 0
    and n of n exactly 1."""
    p, z2 = successes / n, Z * Z
    centre, half = (p + z2 / (2 * n)) / (1 + z2 / n), Z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n)) / (1 + z2 / n)
    low, high = F.greatest(F.lit(0.0), centre - half), F.least(F.lit(1.0), centre + half)
    if pinned:
        low, high = F.when(successes == 0, 0.0).otherwise(low), F.when(successes == n, 1.0).otherwise(high)
    return F.when(n > 0, F.struct(low.alias("low"), high.alias("high")))


def accuracy(planned: DataFrame, group: str, reward: str) -> DataFrame:
    """(group, planned, scored, correct, accuracy) over all planned rows: those without a reward count as failed."""
    n, k = F.count("*"), F.count_if(F.col(reward) == 1)
    return planned.groupBy(group).agg(n.alias("planned"), F.count(reward).alias("scored"), k.alias("correct"), (k / n).alias("accuracy"))


def error_rates(rows: DataFrame, false_positive: Column, false_negative: Column, invalid: Column, valid: Column) -> DataFrame:
    """One row: errors of each kind over their own denominators, with intervals."""
    counted = rows.agg(F.count_if(false_positive & invalid).alias("fp"), F.count_if(invalid).alias("n_invalid"), F.count_if(false_negative & valid).alias("fn"), F.count_if(valid).alias("n_valid"))
    return counted.withColumns({"fp_rate": rate(F.col("fp"), F.col("n_invalid")), "fn_rate": rate(F.col("fn"), F.col("n_valid")), "fp_interval": wilson(F.col("fp"), F.col("n_invalid")), "fn_interval": wilson(F.col("fn"), F.col("n_valid"))})


def missing_bounds(errors: Column, judged: Column, planned: Column) -> Column:
    """struct(low, high) of the rate if no missing row were an error, or each were."""
    return F.when(planned > 0, F.struct((errors / planned).alias("low"), ((errors + planned - judged) / planned).alias("high")))


def exact_upper_bound(n: Column) -> Column:
    """Upper end of the exact 95 % interval after n trials without an error."""
    return F.when(n > 0, 1 - F.pow(F.lit(0.025), 1 / n))


def balanced_accuracy(rows: DataFrame, gold: str, correct: Column) -> DataFrame:
    """One row: mean of the classes' recalls, and the share of the largest class."""
    classes = rows.groupBy(gold).agg(F.count("*").alias("n"), F.avg(F.coalesce(correct, F.lit(False)).cast("double")).alias("recall"))
    return classes.agg(F.avg("recall").alias("balanced_accuracy"), (F.max("n") / F.sum("n")).alias("majority_baseline"))


def bootstrap_interval(rows: DataFrame, value: str, resamples: int = 100_000, seed: int = 0) -> DataFrame:
    """One row (low, high): the 95 % percentile interval of the mean by Poisson resampling.

    Rows are counted by value first. In each resample a value's weight is one Poisson draw with its count as mean, which is
    distributed as the sum of its rows' weights; so the cost follows distinct values and resamples, not rows. Draws are
    seeded by the value. Tasks send one sum for each resample. Nulls don't count; without values both ends are null."""
    counted = rows.select(F.col(value).cast("double").alias("v")).where("v is not null").groupBy("v").agg(F.count("*").alias("n"))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, total = np.zeros(resamples), np.zeros(resamples)
        for batch in batches:
            for v, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                drawn = np.random.default_rng([seed, *np.array([v]).view(np.uint32).tolist()]).poisson(n, resamples)
                weight += drawn
                total += drawn * v
        if weight.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(resamples)), pa.array(weight), pa.array(total)], ["r", "w", "t"])

    sums = counted.mapInArrow(draw, "r long, w double, t double").groupBy("r").agg(F.sum("w").alias("w"), F.sum("t").alias("t"))
    means = sums.where("w > 0").select((F.col("t") / F.col("w")).alias("m"))
    return means.agg(F.percentile("m", F.lit(0.025)).alias("low"), F.percentile("m", F.lit(0.975)).alias("high"))


def near_threshold(x: Column, within: float = 0.001) -> Column:
    return F.count_if(F.abs(x) <= within)


def gate(interval: Column, fp: Column, fn: Column) -> Column:
    """Whether accuracy may lie strictly within (10 %, 70 %) and both error rates stay under 15 %; null without figures."""
    return (interval["low"] > GATE[0]) & (interval["high"] < GATE[1]) & (fp < GATE[2]) & (fn < GATE[2])


def resolve(first: Column, flagged: Column, second: Column, third: Column) -> Column:
    """A review that stands unless flagged; then a second that agrees settles it, and else a third does."""
    return F.when(~flagged, first).when(first == second, first).otherwise(third)


def signed_error(measured: Column, stated: Column) -> Column:
    return F.struct((measured - stated).alias("delta"), (F.signum(measured) == F.signum(stated)).alias("same_sign"))


def report_status(planned: Column, scored: Column) -> Column:
    return F.when(scored == 0, "not_measured").when(scored < planned, "incomplete").otherwise("complete")


def paired_candidates(gold: DataFrame, key: str, valid: Column, invalid: Column) -> DataFrame:
    """(key, candidate, should_pass): a right and a wrong candidate for each gold row, to be graded alike."""
    two = F.explode(F.array(F.struct(valid.alias("candidate"), F.lit(True).alias("should_pass")), F.struct(invalid.alias("candidate"), F.lit(False).alias("should_pass"))))
    return gold.select(key, two.alias("x")).select(key, "x.*")
