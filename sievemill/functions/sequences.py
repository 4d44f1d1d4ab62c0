"""DNA and protein sequence columns. Catalyst expressions, but for alignment, which needs a dynamic programme."""

from __future__ import annotations

import itertools
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemill.functions import fixed


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), value being computed once however often use names it, lambdas included."""
    return F.transform(F.array(value), use)[0]


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGT", "TGCA"))


def canonical_orientation(seq: Column) -> Column:
    """The lesser of a strand and its reverse complement: equal for both."""
    return F.least(seq, reverse_complement(seq))


def match_positions(seq: Column, part: Column) -> Column:
    """array<int>: 0-based starts of all occurrences, overlapping ones too."""
    last = F.length(seq) - F.length(part)
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    # Characters are split once: a substring by position would walk there from the start each time.
    return bound(F.struct(F.split(seq, "").alias("s"), F.split(part, "").alias("p")), lambda x: F.filter(starts, lambda i: F.slice(x["s"], i + 1, F.length(part)) == F.slice(x["p"], 1, F.length(part))))


def codon_table() -> Column:
    entries = [F.lit(x) for codon, acid in zip(map("".join, itertools.product("TCAG", repeat=3)), fixed.AMINO_ACIDS) for x in (codon, acid)]
    return F.create_map(*entries)


def proteins(seq: Column) -> Column:
    """array<string>: translations from each ATG to its first stop, stop left out, by start; starts without a stop give none.
    Codons that the code doesn't know are left out.

    Each of the three frames is cut into codons once and translated once. Stops part the frame into segments, the last of
    which has none; within a segment, a protein begins at each M, as ATG alone gives M. So proteins follow the frame's ATGs."""
    table = codon_table()
    unknown = "?"

    def of_segment(segment: Column) -> Column:
        parts = F.split(segment, "M", -1)
        last = F.size(parts)
        starts = F.when(last > 1, F.sequence(F.lit(2), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat(F.lit("M"), F.array_join(F.slice(parts, i, last), "M")))

    def of_frame(shift: int) -> Column:
        def translated(codons: Column) -> Column:
            acids = F.array_join(F.transform(codons, lambda c: F.coalesce(table[c], F.lit(unknown))), "")
            segments = F.split(acids, r"\*", -1)
            starts = F.filter(F.transform(codons, lambda c, i: F.when(c == "ATG", 3 * i + shift)), lambda i: i.isNotNull())
            made = bound(segments, lambda x: F.flatten(F.transform(F.slice(x, 1, F.size(x) - 1), of_segment)))
            return bound(made, lambda m: F.zip_with(F.slice(starts, 1, F.size(m)), m, lambda at, p: F.struct(at.alias("at"), p.alias("p"))))

        return bound(F.regexp_extract_all(F.substring(seq, shift + 1, 1 << 30), F.lit("(?s)..."), F.lit(0)), translated)

    return F.transform(F.array_sort(F.concat(*[of_frame(i) for i in range(3)])), lambda x: F.replace(x["p"], F.lit(unknown), F.lit("")))


def complete_proteins(seq: Column) -> Column:
    """proteins with their closing stop."""
    return F.transform(proteins(seq), lambda p: F.concat(p, F.lit("*")))


def longest_unique(values: Column) -> Column:
    """The longest string, or null where none or several are longest."""
    longest = F.filter(values, lambda p: F.length(p) == F.array_max(F.transform(values, F.length)))
    return F.when(F.size(longest) == 1, longest[0])


def amplicons(seq: Column, a: Column, b: Column) -> Column:
    """array<string>: distinct products of two primers, either being the forward one."""

    def products(forward: Column, reverse: Column) -> Column:
        back = reverse_complement(reverse)
        pairs = F.flatten(F.transform(match_positions(seq, forward), lambda i: F.transform(match_positions(seq, back), lambda j: F.struct(i.alias("i"), j.alias("j")))))
        fit = F.filter(pairs, lambda p: (p["i"] <= p["j"]) & (p["i"] + F.length(forward) <= p["j"] + F.length(reverse)))
        return F.transform(fit, lambda p: F.substring(seq, p["i"] + 1, p["j"] + F.length(reverse) - p["i"]))

    return F.array_distinct(F.concat(products(a, b), products(b, a)))


def gc_percent(seq: Column) -> Column:
    """Whole percent of G and C, halves up; null for an empty sequence."""
    n = F.length(seq)
    gc = n - F.length(F.translate(seq, "GC", ""))
    return F.when(n > 0, F.floor((200 * gc + n) / (2 * n)))


def hamming(a: Column, b: Column) -> Column:
    """Positions that differ; null where lengths differ."""
    differ = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x != y)
    return F.when(F.length(a) == F.length(b), F.size(F.filter(differ, lambda x: x)))


def first_difference(a: Column, b: Column) -> Column:
    """0-based; the shorter length where one is a prefix; null where both are equal."""
    # The shorter side is filled with nulls, which differ from any character.
    differ = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: ~x.eqNullSafe(y))
    return F.when(a != b, (F.array_position(differ, True) - 1).cast("int"))


def excerpt(seq: Column, at: Column, before: int = 12, after: int = 28) -> Column:
    start = F.greatest(F.lit(0), at - before)
    return F.substring(seq, start + 1, at + after - start)


def classify_change(a: Column, b: Column, longest: int = 256, overlap: int = 64) -> Column:
    """struct(kind, size, overlap): identical, single_substitution, an insertion or deletion of the least size after which the rest agrees, or other_difference."""
    rest = lambda s: F.substring(s, first_difference(a, b) + 1, F.length(s))
    skip = lambda s, k: F.substring(s, k + 1, F.length(s))
    made = lambda kind, size=None, n=None: F.struct(F.lit(kind).alias("kind"), (F.lit(None).cast("int") if size is None else size).alias("size"), (F.lit(None).cast("int") if n is None else n).alias("overlap"))

    def agrees(x: Column, y: Column) -> Column:
        n = F.least(F.length(x), F.length(y))
        return F.when((n >= overlap) & (F.substring(x, F.lit(1), n) == F.substring(y, F.lit(1), n)), n)

    def least_shift(x: Column) -> Column:
        shifts = F.transform(F.sequence(F.lit(1), F.lit(longest)), lambda k: F.struct(k.alias("size"), agrees(x["a"], skip(x["b"], k)).alias("ins"), agrees(skip(x["a"], k), x["b"]).alias("del")))
        return F.try_element_at(F.filter(shifts, lambda t: t["ins"].isNotNull() | t["del"].isNotNull()), F.lit(1))

    def shifted(hit: Column) -> Column:
        return (
            F.when(hit["ins"].isNotNull(), made("consistent_with_insertion_and_boundary_change", hit["size"], hit["ins"]))
            .when(hit["del"].isNotNull(), made("consistent_with_deletion_and_boundary_change", hit["size"], hit["del"]))
            .when(a.isNotNull() & b.isNotNull(), made("other_difference"))
        )

    hit = bound(F.struct(rest(a).alias("a"), rest(b).alias("b")), least_shift)
    return F.when(a == b, made("identical")).when(hamming(a, b) == 1, made("single_substitution")).otherwise(bound(hit, shifted))


def alphabet_flags(seq: Column) -> Column:
    """struct(other_than_acgt, other_than_acgtn, n_tail: n only at the end)."""
    return F.struct(seq.rlike("[^ACGT]").alias("other_than_acgt"), seq.rlike("[^ACGTN]").alias("other_than_acgtn"), (seq.endswith("N") & ~F.rtrim(seq, F.lit("N")).contains("N")).alias("n_tail"))


def apply_mutation(seq: Column, mutation: Column) -> Column:
    """The sequence after a substitution such as A12V (from 1); null where it doesn't parse, fit or change anything."""
    part = lambda i: F.regexp_extract(mutation, r"^([A-Z])(\d+)([A-Z])\z", i)
    at = part(2).try_cast("int")
    fits = (F.substring(seq, at, F.lit(1)) == part(1)) & (part(1) != part(3)) & (at >= 1) & (at <= F.length(seq))
    return F.when(fits, F.concat(F.substring(seq, F.lit(1), at - 1), part(3), F.substring(seq, at + 1, F.length(seq))))


def determinant3(m: Column) -> Column:
    """Of array<array<double>> of 3 by 3."""
    minor = lambda i: m[1][(i + 1) % 3] * m[2][(i + 2) % 3] - m[1][(i + 2) % 3] * m[2][(i + 1) % 3]
    return m[0][0] * minor(0) + m[0][1] * minor(1) + m[0][2] * minor(2)


def align(a: str, b: str) -> tuple[float, float]:
    """(identity, coverage) of the best global alignment: match 2, mismatch -1, gap -2; of equal scores the one with
    more matches, then with more aligned pairs. Anti-diagonals are computed at once; score, matches and pairs are
    digits of one integer, so that the largest integer is the best alignment."""
    if not a or not b:
        return 0.0, 0.0
    unit, base = 1 << 20, 1 << 40
    (match, miss, gap), pair = (s * base for s in fixed.ALIGNMENT), 1
    match, miss = match + unit + pair, miss + pair
    x, y = (np.frombuffer(s.encode("utf-32-le"), np.uint32) for s in (a, b))
    m, n = len(x), len(y)
    two = one = np.zeros(0, np.int64)
    for d in range(m + n + 1):
        lo, hi = max(0, d - n), min(m, d)
        i = np.arange(lo, hi + 1)
        now = np.where((i == 0) | (i == d), gap * d, np.iinfo(np.int64).min)
        inner = (i > 0) & (i < d)
        if inner.any():
            k = i[inner]
            lo1, lo2 = max(0, d - 1 - n), max(0, d - 2 - n)
            up, left, diagonal = one[k - 1 - lo1], one[k - lo1], two[k - 1 - lo2]
            now[inner] = np.maximum(np.maximum(up, left) + gap, diagonal + np.where(x[k - 1] == y[d - k - 1], match, miss))
        two, one = one, now
    best = int(one[0])
    pairs = best % unit
    matches = (best // unit) % (base // unit)
    return (matches / pairs if pairs else 0.0), pairs / max(m, n)


@F.pandas_udf(T.StructType([T.StructField("identity", T.DoubleType()), T.StructField("coverage", T.DoubleType())]))
def alignment(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """align of each pair of strings; nulls count as empty."""
    return pd.DataFrame([align(x or "", y or "") for x, y in zip(a, b)], columns=["identity", "coverage"])
