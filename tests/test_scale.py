"""Plans that must hold where one key, value, block or length has a large share of all rows; results against brute force."""

import collections
import hashlib
import itertools
import random
import time

import numpy as np
from pyspark.sql import functions as F

from sievemill.functions import sequences
from sievemill.operators import aggregate, curate, joins, stats


def tree_digest(ids, leaf):
    sha = lambda lines: hashlib.sha256("\n".join(lines).encode()).hexdigest()
    ids, depth = [str(i) for i in ids], 0
    while leaf * 16**depth < len(ids):
        depth += 1
    parts = collections.defaultdict(list)
    for i in ids:
        parts[hashlib.sha256(i.encode()).hexdigest()[:depth]].append(i)
    found = {p: sha(sorted(x)) for p, x in parts.items()}
    while depth:
        depth = max(0, depth - 3)
        up = collections.defaultdict(list)
        for p in sorted(found):
            up[p[:depth]].append(found[p])
        found = {p: sha(x) for p, x in up.items()}
    return found.get("", sha([]))


def test_digest_tree(spark):
    """Groups of no digits, one, two and five, nulls and repeated ids."""
    groups = {"one": [7], "some": list(range(40)), "more": [*range(300), 5, 5], None: list(range(9))}
    rows = [(g, i) for g, ids in groups.items() for i in ids] + [("some", None), ("void", None)]
    df = spark.createDataFrame(rows, "g string, i long").repartition(5)
    for leaf in (4, 16, 4096):
        found = {r["g"]: r["digest"] for r in aggregate.id_list_digest(df, "i", "g", leaf=leaf).collect()}
        assert found == {g: tree_digest(ids, leaf) for g, ids in {**groups, "void": []}.items()}
    many = spark.range(3000)
    assert aggregate.id_list_digest(many, "id", leaf=1).first()["digest"] == tree_digest(range(3000), 1)  # three digits
    assert aggregate.id_list_digest(spark.range(20000), "id", leaf=1).first()["digest"] == tree_digest(range(20000), 1)  # four, in two rounds
    assert aggregate.id_list_digest(df.limit(0), "i", "g").count() == 0


def test_bootstrap_by_values(spark):
    """100,000 resamples of many rows in seconds, in agreement with the mean's normal interval; partitions don't matter."""
    df = spark.range(300_000).select((F.col("id") % 3).alias("v"), F.lit(1).alias("low"))
    began = time.time()
    low, high = stats.bootstrap_interval(df, "v").first()
    assert time.time() - began < 60
    spread = 1.96 * np.sqrt(2 / 3 / 300_000)
    assert abs(low - (1 - spread)) < spread / 20 and abs(high - (1 + spread)) < spread / 20
    few = spark.createDataFrame([(0.0,), (0.0,), (3.5,), (None,), (3.5,)], "v double")
    assert stats.bootstrap_interval(few, "v", 2000).first() == stats.bootstrap_interval(few.repartition(3), "v", 2000).first()
    assert tuple(stats.bootstrap_interval(few.where("v is null"), "v", 50).first()) == (None, None)


def test_containment_with_a_hot_block(spark):
    """One block in all long texts, and strings that hold it beside a rarer one: they meet by the rarer one."""
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("acgt") for _ in range(n))
    hot = "z" * 64
    long = [(i, hot + word(40) + hot) for i in range(400)]
    short = [(i, long[i * 7][1][40:90]) for i in range(40)] + [(100, "z" * 31), (101, "z" * 5), (102, ""), (103, None), (104, "zx" * 20)]
    left, right = spark.createDataFrame(long, "i int, t string").repartition(4), spark.createDataFrame(short, "j int, s string")
    want = {(i, j) for (i, t), (j, s) in itertools.product(long, short) if s and s in t}
    for frequent in (10_000, 50):
        found = joins.containment_join(left, right, "t", "s", ["i"], ["j"], frequent=frequent)
        assert {(r["i"], r["j"]) for r in found.collect()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # What meets before the texts are checked: by the hot block, only the two strings that have nothing else.
    met = joins.containment_join(left.withColumn("t2", F.col("t")), right.where("j < 100"), "t", "s", ["i"], ["j"])
    assert met.count() == len([p for p in want if p[1] < 100])
    assert joins.containment_join(left.limit(0), right, "t", "s", ["i"], ["j"]).count() == 0
    assert joins.containment_join(left, right.limit(0), "t", "s", ["i"], ["j"]).count() == 0


def test_similar_pairs_lose_none(spark):
    """Lengths with many sequences and few, in small blocks: every pair that reaches both bounds is a candidate."""
    rng = random.Random(9)
    seqs = {}
    for i in range(90):
        n = rng.choice([30, 30, 30, 31, 34, 40, 55, 90])
        base = rng.choice(list(seqs.values())) if seqs and rng.random() < 0.5 else "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(n))
        seqs[i] = "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") if rng.random() < 0.3 else c for c in base)
    df = spark.createDataFrame(list(seqs.items()), "node long, s string")
    found = [tuple(r) for r in curate.similar_pairs(df, 0.6, 0.8, block=7).collect()]
    reach = [(a, b) for a, b in itertools.combinations(seqs, 2) if (x := sequences.align(seqs[a], seqs[b])) and x[0] >= 0.6 and x[1] >= 0.8]
    assert len(found) == len(set(found)) < 90 * 89 // 2 and set(reach) <= set(found) and len(reach) > 20
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        parts = curate.similar_pairs(df, 0.6, 0.8, block=7).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) > 1


def test_similarity_groups_of_copies_and_nothing(spark):
    rows = [(1, "MKVLAAGIVGLC"), (2, "MKVLAAGIVGLC"), (3, ""), (4, None), (5, ""), (6, "WWWWPPPPWWWW"), (7, "MKVLAAGIVGLC")]
    df = spark.createDataFrame(rows, "id long, s string")
    names = {r["id"]: r["group_id"] for r in curate.similarity_groups(df, "id", "s").collect()}
    assert names[1] == names[2] == names[7] and len({names[i] for i in (1, 3, 4, 5, 6)}) == 5
    assert curate.similarity_groups(df.limit(0), "id", "s").count() == 0


def test_proteins_of_a_long_sequence(spark):
    """A million bases in seconds; against a plain translation."""
    rng = random.Random(1)
    seq = "".join(rng.choice("ACGT") for _ in range(1_000_000))
    began = time.time()
    row = spark.createDataFrame([(seq,)], "s string").select(F.size(sequences.proteins(F.col("s"))).alias("n")).first()
    assert time.time() - began < 120
    want = 0
    for frame in range(3):
        open_starts = 0
        for i in range(frame, len(seq) - 2, 3):
            codon = seq[i : i + 3]
            if codon in ("TAA", "TAG", "TGA"):
                want, open_starts = want + open_starts, 0
            elif codon == "ATG":
                open_starts += 1
    assert row["n"] == want
