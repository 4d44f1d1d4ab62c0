"""Order and partition invariance, write modes, result trees, and the smaller operators."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from sievemill.functions import literals, text
from sievemill.operators import aggregate, curate, group, joins, project, sample, stats, validate
from sievemill.sources import readers, sinks


def shuffled(df):
    return df.repartition(7).orderBy(F.rand(3))


def test_digests_do_not_depend_on_partitions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    one, other = (aggregate.dataset_digest(d, "doc_id", "doc_id", "lang", block=37).first()["digest"] for d in (docs, shuffled(docs)))
    assert one == other != aggregate.dataset_digest(docs.where("doc_id <> 5"), "doc_id", "doc_id", "lang", block=37).first()["digest"]
    ids = aggregate.id_list_digest(shuffled(docs), "doc_id").first()["digest"]
    assert ids == hashlib.sha256("\n".join(sorted(str(r[0]) for r in docs.select("doc_id").collect())).encode()).hexdigest()


@pytest.mark.parametrize("f", [lambda d: sample.representatives(d, "source", "doc_id", "s"), lambda d: sample.round_robin(d, "source", ["n_chars", "doc_id"], 30).select("doc_id"), lambda d: sample.disjoint_split(d, "source", 0.3).select("doc_id", "split"), lambda d: sample.representative_quota_sample(d, "source", "lang", "doc_id", 8, "s").select("doc_id"), lambda d: group.exclude_duplicates(d, "lang", "doc_id", "source", F.lit(False)).select("doc_id", "reason")])
def test_order_invariance(spark, sf, f):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert sorted(map(tuple, f(docs).collect())) == sorted(map(tuple, f(shuffled(docs)).collect())) if "reason" not in f(docs).columns else sorted((r[0], r[1] or "") for r in f(docs).collect()) == sorted((r[0], r[1] or "") for r in f(shuffled(docs)).collect())


def test_split_is_disjoint(spark, sf):
    out = sample.disjoint_split(spark.read.parquet(f"{sf}/documents.parquet"), "source", 0.3)
    assert group.disjoint(out.where("split = 'test'"), out.where("split = 'validation'"), "source").count() == 0


def test_shuffled_options_keep_gold(spark):
    df = spark.range(40).select("id", F.array(*[F.concat(F.lit(f"o{i}-"), F.col("id").cast("string")) for i in range(4)]).alias("o"))
    rows = df.select("id", "o", sample.shuffled_options(F.col("o"), F.col("id"), "s").alias("x")).collect()
    for r in rows:
        letters = {o["letter"]: o["text"] for o in r["x"]["options"]}
        assert sorted(letters) == list("ABCD") and letters[r["x"]["gold"]] == r["o"][0]
    assert len({r["x"]["gold"] for r in rows}) == 4


def test_reproduced_draw(spark):
    df = spark.range(100)
    drawn = sample.hash_sample(df, "id", 10, "a")
    assert sample.redrawn_difference(drawn, sample.hash_sample(df, "id", 10, "a"), "id").count() == 0
    assert sample.redrawn_difference(drawn, sample.hash_sample(df, "id", 10, "b"), "id").count() > 0


def test_groups(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "x"), ("b", 4, "x")], "k string, i int, p string")
    assert {(r["k"], r["i"]) for r in group.latest(df, "k", ["i"]).collect()} == {("a", 3), ("b", 4)}
    assert {(r["k"], r["text"]) for r in group.distinct_passages(df, ["k"], "p", "i").collect()} == {("a", "x y"), ("b", "x")}
    assert [r["p"] for r in group.ordered_distinct(df, "p", "i").collect()] == ["x", "y"]
    assert readers.upsert_by_name(df, "k", "i").count() == 2


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, "v", [("a", 1), ("b", 2)])], "i int, variant_sequence string, items array<struct<n: string, secret: int>>")
    assert project.rename_for(df, "coding", {"coding": {"variant_sequence": "mutated_sequence"}}).columns[1] == "mutated_sequence"
    assert [(r["position"], r["item"]["n"]) for r in project.explode_items(df, "items").collect()] == [(0, "a"), (1, "b")]
    assert df.select(project.allow_fields(F.col("items"), ["n"]).alias("x")).schema["x"].dataType.elementType.names == ["n"]


def test_pairs_and_relabels(spark):
    pairs = spark.createDataFrame([(1, "a", "b"), (2, "a", "c"), (3, "d", "b")], "id int, left string, right string")
    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("d", 3.0), ("d", 4.0)], "key string, v double")
    found = {r["id"]: (r["n_x"], r["n_y"], r["v_x"], r["v_y"]) for r in joins.pair_sides(pairs, rows, "id", {"x": "left", "y": "right"}, "key", ["v"]).collect()}
    assert found == {1: (1, 1, 1.0, 2.0), 2: (1, 0, 1.0, None), 3: (2, 1, None, 2.0)}


def test_write_modes(spark, tmp_path):
    df = spark.range(3)
    path = str(tmp_path / "t")
    sinks.write_table(df, path)
    with pytest.raises(Exception, match="already exists"):
        sinks.write_table(df, path)
    sinks.write_table(df, path, "skip")
    assert spark.read.parquet(path).count() == 3
    sinks.write_table(df, path, "append")
    assert spark.read.parquet(path).count() == 6
    sinks.write_split(*validate.split_valid(df, [("even", F.col("id") % 2 == 0)]), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s/excluded")).select("reason").first()["reason"] == "even"


def test_results_and_digests(spark, tmp_path):
    for name in ("t1__abc", "t2__xyz"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "result.json").write_text(json.dumps({"reward": 1.0}))
    rows = readers.results(spark, str(tmp_path / "*/result.json"), "reward double")
    assert {r["trial_id"] for r in rows.collect()} == {"t1", "t2"}
    planned = spark.createDataFrame([("t1", "g"), ("t2", "g"), ("t3", "g")], "trial_id string, g string")
    out = stats.accuracy(joins.planned_outcomes(planned, rows, "trial_id"), "g", "reward").first()
    assert (out["planned"], out["scored"], out["correct"]) == (3, 2, 2)
    (tmp_path / "f.bin").write_bytes(b"abc")
    found = readers.files(spark, str(tmp_path / "f.bin"), 10)
    good, bad = hashlib.sha256(b"abc").hexdigest(), "0" * 64
    assert found.where(readers.verify_digests(found, {"f.bin": good})).count() == 1
    assert found.where(readers.verify_digests(found, {"f.bin": bad})).count() == 0
    assert readers.files(spark, str(tmp_path / "f.bin"), 2).count() == 0
    assert readers.file_set_difference(spark.createDataFrame([("a",)], "n string"), spark.createDataFrame([("b",)], "n string"), "n").count() == 2


def test_requirements_fail_in_the_plan(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(Exception, match="repeated k"):
        validate.require_unique(df, "k").collect()
    with pytest.raises(Exception, match="positive"):
        validate.require(df, F.col("k") > 5, "positive").collect()


def test_statistics(spark):
    df = spark.createDataFrame([(True, False), (True, True), (False, None), (False, False)], "valid boolean, said boolean")
    r = stats.error_rates(df, F.coalesce("said", F.lit(False)), ~F.coalesce("said", F.lit(False)), ~F.col("valid"), F.col("valid")).first()
    assert (r["fp"], r["n_invalid"], r["fn"], r["n_valid"]) == (0, 2, 1, 2)
    b = stats.balanced_accuracy(spark.createDataFrame([("benign", i < 16) for i in range(20)] + [("pathogenic", i < 12) for i in range(30)], "g string, ok boolean"), "g", F.col("ok")).first()
    assert (round(b[0], 9), round(b[1], 9)) == (0.6, 0.6)
    v = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert v(stats.resolve(F.lit("a"), F.lit(True), F.lit("b"), F.lit("c"))) == "c" and v(stats.resolve(F.lit("a"), F.lit(False), F.lit("b"), F.lit("c"))) == "a"
    assert tuple(v(stats.missing_bounds(F.lit(1), F.lit(8), F.lit(10)))) == (0.1, 0.3)
    assert v(stats.report_status(F.lit(10), F.lit(0))) == "not_measured" and v(stats.report_status(F.lit(10), F.lit(4))) == "incomplete"


def test_candidates_of_a_document(spark):
    tex = "intro \\ref{fig:a} says so \\begin{figure}\\includegraphics{a.png}\\caption{One {nested} caption}\\label{fig:a}\\end{figure}"
    docs = spark.createDataFrame([("p", tex)], "paper string, t string")
    bodies = docs.select("paper", F.posexplode(text.figure_bodies(F.col("t"))).alias("n", "body"))
    found = bodies.select("paper", F.explode(text.figure_labels(F.col("body"))).alias("label"), text.clean_tex(literals.command_argument(F.col("body"), "caption")).alias("caption"), text.figure_images(F.col("body")).alias("images"))
    prose = docs.withColumn("t", F.regexp_replace("t", r"(?s)\\begin\{figure\}.*?\\end\{figure\}", " "))
    said = joins.passages_around(prose, found, "paper", "t", "label")
    row = found.join(said, ["paper", "label"]).first()
    assert (row["label"], row["caption"], row["images"]) == ("fig:a", "One nested caption", ["a.png"]) and "says so" in row["passage"]


def test_paths_and_mutations(spark):
    v = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert v(curate.path_agrees(F.lit("x-test-000012"), F.lit("test"), F.lit(12)))
    assert not v(curate.path_agrees(F.lit("x-test-000012"), F.lit("train"), F.lit(12)))
    assert v(curate.mutation_pair(F.lit("MKV"), F.lit("K2A"), F.lit("MAV"), F.lit("MAV"))) and not v(curate.mutation_pair(F.lit("MKV"), F.lit("K2A"), F.lit("MAV"), F.lit("MKV")))


def test_similarity_without_blocking(spark):
    rng = random.Random(8)
    seqs = [(i, "".join(rng.choice("ACDEFG") for _ in range(rng.randint(8, 14)))) for i in range(14)]
    df = spark.createDataFrame(seqs, "id int, s string")
    names = {r["id"]: r["group_id"] for r in curate.similarity_groups(df, "id", "s", block=5).collect()}
    from sievemill.functions.sequences import align

    parent = {i: i for i, _ in seqs}
    find = lambda x: x if parent[x] == x else find(parent[x])
    for i, a in seqs:
        for j, b in seqs:
            if i < j:
                same, cover = align(a, b)
                if same >= 0.3 and cover >= 0.8:
                    x, y = sorted((find(i), find(j)))
                    parent[y] = x
    assert all((names[i] == names[j]) == (find(i) == find(j)) for i, _ in seqs for j, _ in seqs)
