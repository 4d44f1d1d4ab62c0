"""Operators on small literal tables."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from sievemill.operators import curate, grade, group, joins, project, sample, stats, validate


def test_conflicts_and_duplicates(spark):
    rows = [(0, "k", "a"), (1, "k", "b"), (2, "m", "a"), (3, "m", "a"), (4, "m", None), (5, "n", "c")]
    df = spark.createDataFrame(rows, "i int, k string, s string")
    out = {r["i"]: r["reason"] for r in group.exclude_duplicates(df, "k", "i", "s", F.col("s").isNull()).collect()}
    assert out == {0: "conflict", 1: "conflict", 2: None, 3: "duplicate", 4: "missing", 5: None}


def test_components_and_digest(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r["node"]: r["component"] for r in group.components(df).collect()} == {x: find(x) for x in parent}


def test_samples_are_stable(spark):
    df = spark.range(500).withColumn("g", F.col("id") % 7)
    for f in (lambda d: sample.hash_sample(d, "id", 20, "s"), lambda d: sample.quota_sample(d, "g", "id", 30, "s"), lambda d: sample.stratified(d, "g", "id", 3, "s")):
        assert sorted(r["id"] for r in f(df).collect()) == sorted(r["id"] for r in f(df.repartition(5).orderBy(F.desc("id"))).collect())
    assert sample.quota_sample(df, "g", "id", 30, "s").count() == 30
    assert [r["id"] for r in sample.cpython_sample(df, "id", 5, 7).orderBy("draw").collect()] == random.Random(7).sample(range(500), 5)


def test_round_robin_and_split(spark):
    df = spark.createDataFrame([("c1", "p1", "2024"), ("c2", "p1", "2025"), ("c3", "p2", "2023")], "candidate string, paper string, published string")
    assert [r["candidate"] for r in sample.round_robin(df, "paper", ["published", "candidate"], 2).collect()] == ["c2", "c3"]
    parts = {r["paper"]: r["split"] for r in sample.disjoint_split(df, "paper", 0.2).collect()}
    assert sorted(parts.values()) == ["test", "validation"]
    assert {r["split"] for r in sample.disjoint_split(df.where("paper = 'p1'"), "paper", 0.2).collect()} == {"validation"}


def test_requested_ids_fail(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, v string")
    ids = lambda *x: spark.createDataFrame([(p, i) for p, i in enumerate(x)], "pos int, i int")
    assert [r["v"] for r in sample.take_ids(df, ids(2, 1), "i", "pos").collect()] == ["b", "a"]
    for wrong in (ids(3), ids(1, 1)):
        with pytest.raises(Exception, match="no partner|repeated"):
            sample.take_ids(df, wrong, "i", "pos").collect()


def test_joins(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2, "x"), (3, "y")], "k int, v string")
    good, bad = joins.eligible(a, b, "k", "missing")
    assert good.collect() == [(2, "x")] and bad.collect() == [(1, "missing")]
    assert {(r["k"], r["side"]) for r in joins.keys_match(a, b, "k").collect()} == {(1, "left"), (3, "right")}
    with pytest.raises(Exception, match="no partner"):
        joins.lookup(a, b, "k").collect()
    tex = spark.createDataFrame([("p", "before text \\ref{fig:a} between \\cref{fig:b} after")], "p string, t string")
    labels = spark.createDataFrame([("p", "fig:b")], "p string, label string")
    found = joins.passages_around(tex, labels, "p", "t", "label", 9).collect()
    assert len(found) == 1 and found[0]["passage"].split() == ["between", "after"]


def test_containment(spark):
    rng = random.Random(4)
    long = ["".join(rng.choice("ab") for _ in range(rng.choice([0, 10, 60, 200]))) for _ in range(40)]
    short = [x[i : i + n] for x in long if len(x) > 50 for i, n in [(rng.randint(0, 20), rng.choice([1, 12, 31, 40]))]] + ["", "zz"]
    left = spark.createDataFrame(list(enumerate(long)), "i int, t string")
    right = spark.createDataFrame(list(enumerate(short)), "j int, s string")
    found = {(r["i"], r["j"]) for r in joins.containment_join(left, right, "t", "s", ["i"], ["j"]).collect()}
    assert found == {(i, j) for (i, t), (j, s) in itertools.product(enumerate(long), enumerate(short)) if s and s in t}


BAD_JSON = ['{"k":1,"k":2}', '{"k":NaN}', '{"k":Infinity}', '{"k":1}x', '[{"k":1}]', '{"k":1},{}', '"k"', "", "{", '{"k":1} {"k":1}']


@pytest.mark.parametrize("text", BAD_JSON)
def test_strict_json_rejects(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(validate.strict_object(F.col("t")).isNull().alias("x")).first()["x"]


def test_bounded_int_exhaustively(spark):
    rows = [(n, g, c) for n in range(6) for g in range(n + 1) for c in range(-1, n + 2)]
    df = spark.createDataFrame([(n, g, c, json.dumps({"key": c})) for n, g, c in rows], "n int, g int, c int, t string")
    out = df.select("g", "c", grade.json_int(F.col("t"), "key", F.col("n"), F.col("g")).alias("r")).collect()
    assert all(r["r"] == float(r["c"] == r["g"]) for r in out)
    wrong = ['{"key": true}', '{"key": 1.0}', '{"key": "1"}', '{"key": 1, "x": 2}', "{}", '{"key": null}', '{"key": 99999999999999999999999}']
    out = spark.createDataFrame([(t,) for t in wrong], "t string").select(grade.json_int(F.col("t"), "key", F.lit(3), F.lit(1)).alias("r")).collect()
    assert {r["r"] for r in out} == {0.0}
    assert spark.createDataFrame([(' {"key": 1}\n',)], "t string").select(grade.json_int(F.col("t"), "key", F.lit(3), F.lit(1)).alias("r")).first()["r"] == 1.0


def test_letters_and_tags(spark):
    letters = F.array(F.lit("A"), F.lit("B"))
    for said, want in {"B": 1.0, "B\n": 1.0, "B\n\n": 0.0, " B": 0.0, "b": 0.0, "BB": 0.0, "": 0.0, "A": 0.0, "C": 0.0}.items():
        assert spark.createDataFrame([(said,)], "t string").select(grade.letter(F.col("t"), letters, F.lit("B")).alias("r")).first()["r"] == want
    bounds = [F.lit(x).cast("decimal(38,18)") for x in ("0.07", "0.08")]
    for said, want in {"<answer>7.5e-2</answer>": 1.0, " <answer> 0.07 </answer>\n": 1.0, "<answer>0.08</answer>": 1.0, "<answer>0.0699</answer>": 0.0, "<answer>NaN</answer>": 0.0, "<answer>x</answer>": 0.0}.items():
        g = spark.createDataFrame([(said,)], "t string").select(grade.tagged(F.col("t"), F.lit("range_verifier"), *bounds, F.lit(None).cast("string")).alias("g")).first()["g"]
        assert (g["status"], g["reward"]) == ("graded", want), said
    g = spark.createDataFrame([("<answer>82,000</answer>",)], "t string").select(grade.tagged(F.col("t"), F.lit("str_verifier"), *bounds, F.lit("82000")).alias("g")).first()["g"]
    assert g["reward"] == 0.0


def test_verdicts(spark):
    ask = lambda f, t: spark.createDataFrame([(t,)], "t string").select(f(F.col("t")).alias("x")).first()["x"]
    assert ask(grade.ordinal_verdict, '{"score": 0.25, "rationale": "r"}') == 0.25
    assert ask(grade.ordinal_verdict, '{"score": 1, "rationale": "r"}') == 1.0
    for bad in ('{"score": true, "rationale": "r"}', '{"score": 0.3, "rationale": "r"}', '{"score": 1, "rationale": " "}', '{"score": 1}'):
        assert ask(grade.ordinal_verdict, bad) is None
    assert ask(grade.binary_verdict, '{"answer_correct": true, "score": 1, "rationale": "r"}') == 1.0
    assert ask(grade.binary_verdict, '{"answer_correct": true, "score": 0, "rationale": "r"}') is None


def test_published_intervals(spark):
    known = {(22, 50): (0.312, 0.577), (3, 100): (0.01025, 0.08452), (36, 98): (0.2786, 0.4661)}
    df = spark.createDataFrame(list(known), "k int, n int").select("k", "n", stats.wilson(F.col("k"), F.col("n")).alias("w"))
    for r in df.collect():
        assert (r["w"]["low"], r["w"]["high"]) == pytest.approx(known[r["k"], r["n"]], abs=6e-4)
    edge = spark.createDataFrame([(0, 100), (100, 100), (0, 0)], "k int, n int").select(stats.wilson(F.col("k"), F.col("n")).alias("w")).collect()
    assert edge[0]["w"]["low"] == 0.0 and edge[1]["w"]["high"] == 1.0 and edge[2]["w"] is None
    upper = spark.createDataFrame([(50,), (100,), (148,)], "n int").select(stats.exact_upper_bound(F.col("n")).alias("u")).collect()
    assert [round(100 * r["u"], 2) for r in upper] == [7.11, 3.62, 2.46]


def test_bootstrap(spark):
    df = spark.range(400).withColumn("v", (F.col("id") % 2).cast("double"))
    low, high = stats.bootstrap_interval(df, "v", 3000).first()
    assert 0.43 < low < 0.48 and 0.52 < high < 0.57


def test_structures(spark):
    good = ([[1.0, 0, 0], [0, 1.0, 0], [0, 0, 1.0]], [([("Fe", 1)], [0.0, 0.5, 0.5])])
    schema = "m array<array<double>>, s array<struct<species: array<struct<element: string, occu: int>>, abc: array<double>>>"
    rows = [good, ([[1.0, 0, 0], [2.0, 0, 0], [0, 0, 1.0]], good[1]), (good[0], []), (good[0], [([("Fe", 1), ("O", 1)], [0.0, 0.0, 0.0])]), (good[0], [([("F3", 1)], [0.0, 0.0, 0.0])]), (good[0], [([("Fe", 1)], [0.0, float("nan"), 0.0])])]
    df = spark.createDataFrame([([[float(x) for x in r] for r in m], s) for m, s in rows], schema)
    assert [r["x"] for r in df.select(validate.valid_structure(F.col("m"), F.col("s")).alias("x")).collect()] == [True] + [False] * 5
    assert df.select(project.public_structure(F.col("m"), F.col("s")).alias("x")).first()["x"]["sites"][0]["species"][0]["element"] == "Fe"


def test_options_paths_maps(spark):
    opts = lambda *x: F.array(*[F.struct(F.lit(a).alias("letter"), F.lit(b).alias("text")) for a, b in x])
    v = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert v(validate.valid_options(opts(("A", "x"), ("B", "y"))))
    assert not v(validate.valid_options(opts(("A", "x"), ("B", "x")))) and not v(validate.valid_options(opts(("a", "x"), ("B", "y"))))
    for path, ok in {"a/b": True, "/a": False, "a/../b": False, "a\\b": False, "": False}.items():
        assert v(validate.safe_relative_path(F.lit(path))) is ok
    assert v(project.merge_maps(F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2)), F.create_map(F.lit("b"), F.lit(3)))) == {"a": 1, "b": 3}


def test_blinding(spark, tmp_path):
    spark.createDataFrame([(1, "q", "secret")], "i int, q string, gold string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    public, gold = project.public_gold(df, "i", ["q"], ["gold"])
    assert public.columns == ["i", "q"] and "gold" not in public._jdf.queryExecution().executedPlan().toString()
    assert project.gold_leaks(public.withColumn("t", F.lit("the secret")), gold, "i", "t", "gold").count() == 1
    with pytest.raises(ValueError):
        project.public_gold(df, "i", ["q"], ["q"])


def test_computed_gold(spark):
    plain = "ATGAAACCCGGGTAACCC"
    rows = [("Prop-seq-gcpercent", f"GC of {plain}?", "56", ["40"], True), ("Prop-seq-gcpercent", f"GC of {plain}?", "56", ["56"], False), ("ORF-seq-AAseq", f"ORF of {plain}?", "MKPG*", ["M*"], True), ("ORF-seq-numlen", f"longer, greater than 3, in {plain}?", "1", ["0"], True), ("ORF-seq-AAseq", f"ORF of {plain}?", "M*", ["M*"], False)]
    df = spark.createDataFrame(rows, "f string, q string, i string, d array<string>, ok boolean")
    for r in df.select("ok", curate.computed_gold(F.col("f"), F.col("q"), F.col("i"), F.col("d")).alias("x")).collect():
        assert r["x"]["valid"] is r["ok"]


def test_sequence_groups(spark):
    rng = random.Random(6)
    base = "".join(rng.choice("ACGT") for _ in range(80))
    back = base[10:60][::-1].translate(str.maketrans("ACGT", "TGCA"))
    other = "".join(rng.choice("ACGT") for _ in range(80))
    df = spark.createDataFrame([("a", base), ("b", base[5:50]), ("c", back), ("d", other)], "id string, s string")
    names = {r["id"]: r["group_id"] for r in curate.containment_groups(df, "id", "s").collect()}
    assert names["a"] == names["b"] == names["c"] != names["d"]
    proteins = spark.createDataFrame([("x", "MKVLAAGIVGLC"), ("y", "MKVLSAGIVGLC"), ("z", "WWWWPPPPWWWW")], "id string, s string")
    names = {r["id"]: r["group_id"] for r in curate.similarity_groups(proteins, "id", "s").collect()}
    assert names["x"] == names["y"] != names["z"]


def test_outcomes(spark):
    df = spark.createDataFrame([(1.0, False, False), (1.0, True, False), (1.0, False, True)], "r double, bad boolean, infra boolean")
    out = [tuple(r["x"]) for r in df.select(grade.outcome(F.col("r"), F.col("bad"), F.col("infra")).alias("x")).collect()]
    assert out == [("graded", 1.0), ("invalid_submission", 0.0), ("infrastructure_error", None)]
