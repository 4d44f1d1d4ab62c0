"""Operators that compare rows: nearest neighbours, suffixes, lines, n-gram sets; and the pipeline."""

import collections
import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievemill.llm import line_dedup, nearest, ngram_join, substrings


def test_nearest(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 24)) * rng.uniform(0.5, 2, (600, 1))
    x[100:140] = x[100]  # copies
    data = [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(x)]
    odd = [(1000, None), (1020, [0.0] * 24), (1040, [1.0, None] + [0.0] * 22), (1060, [float("nan")] + [1.0] * 23), (1080, [1.0, 2.0])]
    df = spark.createDataFrame(data + odd + [data[7]], "vec_id long, embedding array<float>").repartition(4)
    out = nearest.search(df).collect()
    exact = np.array([v for _, v in data])
    scores = exact @ exact.T
    found, found_scores = collections.defaultdict(list), collections.defaultdict(list)
    for r in sorted(out, key=lambda r: r["rank"]):
        assert r["score"] == pytest.approx(scores[r["query_id"], r["vec_id"]]) and r["query_id"] != r["vec_id"]
        found[r["query_id"]].append(r["vec_id"])
        found_scores[r["query_id"]].append(r["score"])
    hits = 0
    for q in range(0, 600, 20):
        best = sorted((i for i in range(600) if i != q), key=lambda i: (-scores[q, i], i))[:20]
        hits += len(set(best) & set(found[q]))
        assert len(found[q]) == 20 and sorted(found_scores[q], reverse=True) == found_scores[q]
    assert hits / (30 * 20) >= 0.9 and set(found) == set(range(0, 600, 20))
    copies = [v for v in found[120] if 100 <= v < 140]
    assert copies == sorted(copies) and copies[:20] == list(range(100, 120))[: len(copies)]
    assert nearest.search(df.limit(0)).count() == 0
    few = nearest.search(df.where("vec_id in (0, 5, 9)"), tables=64, probes=8).collect()
    assert [r["rank"] for r in sorted(few, key=lambda r: r["rank"])] == [1, 2]


def unit_rows(rng, n, width):
    x = rng.normal(size=(n, width))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nearest_recall(spark, x, **plan):
    """(share of the 20 nearest found, fewest found for a query) over all queries."""
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    found = collections.defaultdict(set)
    for r in nearest.search(df, **plan).collect():
        found[r["query_id"]].add(r["vec_id"])
    exact, hits, asked = x.astype(float), 0, range(0, len(x), 20)
    for q in asked:
        scores = exact @ exact[q]
        scores[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-scores)[: min(20, len(x) - 1)].tolist()))
    return hits / (len(asked) * min(20, len(x) - 1)), min(len(found[q]) for q in asked)


@pytest.mark.parametrize("width, larger, factor", [(64, 120, 10), (64, 1500, 3), (64, 1200, 1.3), (128, 0, 1), (256, 0, 1)])
def test_nearest_of_skewed_norms_and_wide_vectors(spark, width, larger, factor):
    """Some vectors longer than the others by a factor, and equal norms at other widths, with the query's own plan."""
    x = unit_rows(np.random.default_rng(width + larger), 3000, width)
    x[1:][:larger] *= factor
    assert nearest_recall(spark, x)[0] >= 0.93


def brute_nearest(x, k=20, every=20):
    """Lists by exact scores of small integers, ties to smaller ids."""
    out = {}
    for i in range(0, len(x), every):
        if x[i].any():
            near = sorted((-float(x[i] @ x[j]), j) for j in range(len(x)) if j != i and x[j].any())[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


@pytest.mark.parametrize("n, width, plan", [(400, 8, {}), (60, 3, {}), (3000, 10, {}), (3000, 10, {"tables": 32, "probes": 4}), (3000, 10, {"per_bucket": 2})])
def test_nearest_of_ties(spark, n, width, plan, monkeypatch):
    """Integer vectors, most of whose scores tie, in one bucket, in split buckets and in tables."""
    x = np.random.default_rng(n).integers(-1, 2, (n, width)).astype(float)
    if n > 400:
        monkeypatch.setattr(nearest, "SPLIT", 64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(5)
    found = collections.defaultdict(list)
    for r in sorted(nearest.search(df, **plan).collect(), key=lambda r: (r.query_id, r["rank"])):
        found[r.query_id].append((r.vec_id, r.score))
    want = brute_nearest(x)
    if n <= 400 or not plan:
        assert dict(found) == want
    else:  # buckets may miss some; what they find is in order, and every list's ties are by id among what was found
        hits = sum(len({j for j, _ in found[i]} & {j for j, _ in want[i]}) for i in want)
        assert hits >= 0.9 * sum(map(len, want.values()))
        assert all(near == sorted(near, key=lambda p: (-p[1], p[0])) for near in found.values())


def test_first_of_ties():
    rng = np.random.default_rng(3)
    q, x = rng.integers(-1, 2, (7, 10)).astype(float), rng.integers(-1, 2, (500, 10)).astype(float)
    ids = rng.permutation(500)
    for i, near, scores in nearest._first(q, x, ids, 21):
        want = sorted((-float(q[i] @ x[j]), int(ids[j])) for j in range(500))[:21]
        assert list(zip(near, scores)) == [(j, -s) for s, j in want]
    assert [len(near) for _, near, _ in nearest._first(q, x[:3], ids[:3], 21)] == [3] * 7


@pytest.mark.parametrize("plan", [{}, {"per_bucket": 1, "tables": 32, "probes": 4}])
def test_nearest_of_few_candidates(spark, plan):
    """The query's own plan, and its tables where they find too few: small tables, and opposite vectors of two lengths."""
    for n in (5, 20):
        assert nearest_recall(spark, unit_rows(np.random.default_rng(n), n, 64), **plan)[1] == n - 1
    x = unit_rows(np.random.default_rng(3), 60, 64) * 0.01 + np.eye(64)[0]
    x[0] = -x[0]
    assert nearest_recall(spark, x, **plan)[1] == 20


def test_rotations_keep_lengths():
    x = np.random.default_rng(1).normal(size=(5, 33))
    assert np.linalg.norm(nearest.rotations(x, 3), axis=1) == pytest.approx(np.linalg.norm(x, axis=1))


@pytest.mark.parametrize("places", [1, 7, 69, 70, 500])
def test_anchors_in_blocks(places, monkeypatch):
    """Texts longer than the bits for places reach: blocks give what one block gives."""
    rng = random.Random(places)
    texts = [bytes(rng.choice(b"ab") for _ in range(n)) for n in (99, 100, 101, 0, 400, 900)] + [b"x" * 700]
    one = substrings.Anchors(texts)
    monkeypatch.setattr(substrings, "PLACES", places)
    many = substrings.Anchors(texts)
    assert len(one.position) > 20
    for field in ("position", "first", "last", "text", "hash"):
        assert (getattr(one, field) == getattr(many, field)).all()


def brute_substrings(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - 99):
            part = raw[s : s + 100]
            if part in seen:
                gone[s : s + 100] = True
            seen.add(part)
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out[doc_id] = (len(raw), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def test_substrings(docs, rows, empty):
    want = brute_substrings([(r[0], r[1]) for r in rows])
    out = substrings.remove_repeats(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]], r["doc_id"]
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]
    assert substrings.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("frequent", [16 * substrings.FREQUENT, 2])
def test_substrings_of_repetitive_texts(spark, monkeypatch, frequent):
    """Few letters, long runs and periods; also with frequent anchors dealt by suffixes."""
    rng = random.Random(frequent)
    texts = ["ab" * rng.randint(40, 120) + "".join(rng.choice("abc") for _ in range(rng.randint(0, 150))) + "c" * rng.randint(0, 300) for _ in range(25)]
    rows = list(enumerate(texts + texts[:3]))
    monkeypatch.setattr(substrings, "FREQUENT", frequent if frequent < 100 else substrings.FREQUENT)
    if frequent < 100:
        found = substrings.cut(substrings.repeated_anchors(spark.createDataFrame(rows, "doc long, text string").select("doc", F.lit(0).alias("k"), "text")))
        hot = {(r["doc"], r["at"]) for r in found.where("frequent is not null").collect()}
        assert hot
        original = substrings.covered_starts
        monkeypatch.setattr(substrings, "covered_starts", lambda placed, _: original(placed, hot))
    out = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = brute_substrings(rows)
    assert all((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]] for r in out)


def test_deep_shallow_sort():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 2, (400, 40), dtype=np.uint8)
    rows[200:, :30] = rows[0, :30]
    rows[300:] = rows[:100]
    group = rng.integers(0, 3, 400)
    label = substrings.equal_classes(rows, group)
    for i, j in itertools.combinations(range(0, 400, 3), 2):
        assert (label[i] == label[j]) == (group[i] == group[j] and bytes(rows[i]) == bytes(rows[j]))


def shingles(text, n):
    words = [w for w in (text or "").encode().lower().split() if w]
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def brute_components(rows, percent, n):
    sets = {(r[0], r[1]): shingles(r[1], n) for r in rows}
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = lambda k: (k[0] is None, k[0] or 0)
    for a, b in itertools.combinations(sets, 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)), key=order)
            parent[y] = x
    return {k: (len(sets[k]), find(k)[0]) for k in sets}


@pytest.mark.parametrize("percent, n", [(85, 4), (80, 5)])
def test_ngram_join(docs, rows, empty, percent, n):
    want = brute_components(rows, percent, n)
    texts = {r[0]: r[1] for r in rows}
    out = ngram_join.join(docs, percent, n).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"], texts[r["doc_id"]]], r["doc_id"]
    assert ngram_join.join(empty).count() == 0


def test_ngram_join_of_close_sets(spark):
    """A group about the threshold: many links, many near misses."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(120):
        own = list(words)
        for _ in range(rng.randint(0, 7)):
            own[rng.randrange(120)] = f"x{rng.randrange(40)}"
        texts.append(" ".join(own[: rng.choice([120, 110])]))
    rows = [(i, t) for i, t in enumerate(texts)]
    want = brute_components(rows, 85, 4)
    out = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == {k[0]: v for k, v in want.items()}


def test_ngram_join_tells_colliding_names_apart(docs, rows):
    """Names of eight bits: many different sets have one, and go by the other half of their identities."""
    want = brute_components(rows, 85, 4)
    texts = {r[0]: r[1] for r in rows}
    for r in ngram_join.join(docs, identity_bits=8).collect():
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"], texts[r["doc_id"]]], r["doc_id"]


def test_ngram_join_of_a_star(spark, monkeypatch):
    """More near copies of one text than a task compares with one pivot, all linked with it."""
    words = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(words))] + [(i, " ".join(words[:i] + [f"x{i}"] + words[i + 1 :])) for i in range(1, 120)]
    linked = ngram_join.linked
    naming = ngram_join.Naming()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    nodes = ngram_join.nodes_of(ngram_join.members(docs, 4, naming))
    named = {r["least"]: r["node"] for r in nodes.collect()}
    pairs = spark.createDataFrame([(min(named[0], named[i]), max(named[0], named[i])) for i in range(1, 120)], "a long, b long")
    monkeypatch.setattr(ngram_join, "STAR", 16)
    assert linked(pairs, nodes, docs, 85, 4, naming).count() == 119
    assert linked(pairs, nodes, docs, 99, 4, naming).count() == 0


def test_ngram_join_deals_texts_once(spark, docs, monkeypatch):
    """However large the tables are, each join with the texts leaves these where they lie."""
    key, texts_of, plans = "spark.sql.autoBroadcastJoinThreshold", ngram_join.texts_of, []
    before = spark.conf.get(key)

    def seen(*a):
        plans.append((out := texts_of(*a))._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(ngram_join, "texts_of", seen)
    spark.conf.set(key, "-1")
    ngram_join.join(docs).count()
    spark.conf.set(key, before)
    assert len(plans) > 1 and [p.count("Exchange hashpartitioning") for p in plans] == [1] * len(plans)


def test_linked_sets_share_a_signature():
    """Also with empty cells: sets of all sizes, just within the threshold."""
    sim, rng = ngram_join.similarity(85), np.random.default_rng(4)
    for size in list(range(1, 60)) + [100, 240, 251, 400, 1500]:
        for _ in range(12):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.int64).astype(np.uint64) * np.uint64(2))
            gone = rng.integers(0, len(a) * 15 // 185 + 1)
            b = np.union1d(rng.permutation(a)[gone:], rng.integers(0, 1 << 63, gone, dtype=np.int64).astype(np.uint64))
            shared = len(np.intersect1d(a, b))
            if sim.links(shared, len(a), len(b)) and shared < max(len(a), len(b)):
                assert set(sim.signatures(a)) & set(sim.signatures(b)), size
                prints = ngram_join.Prints([ngram_join.fingerprint(a).tobytes(), ngram_join.fingerprint(b).tobytes()])
                assert sim.may_link(prints.apart(np.array([0]), np.array([1]))[0], len(a), len(b))


def test_keep_one(docs, rows):
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    left = collections.Counter(r["doc_id"] for r in kept.collect())
    want = brute_components(rows, 80, 5)
    for (doc_id, text), (size, component) in want.items():
        assert (left[doc_id] > 0) == (size == 0 or component == doc_id or doc_id is None)


def test_line_templates(docs, rows, empty):
    out = line_dedup.drop_lines(docs.select("doc_id", "text"), least_docs=10).collect()
    assert len(out) == len(rows)
    posted = [r[0] for r in rows if r[0] is not None and "Posted by user" in (r[1] or "")]
    texts = {r[0]: r[1] for r in rows}
    for r in out:
        if r["text"] is not None and r["doc_id"] is not None:
            assert ("Posted by user" in r["text"]) == (r["doc_id"] == min(posted)), r["doc_id"]
            kept = iter((texts[r["doc_id"]]).split("\n"))
            assert all(line in kept for line in r["text"].split("\n") if line)
        if r["text"] is None:
            assert texts[r["doc_id"]] is None and r["n_lines"] == 0
    assert line_dedup.drop_lines(empty.select("doc_id", "text")).count() == 0
    cleaned = line_dedup.clean_documents(docs)
    assert cleaned.columns == docs.columns and cleaned.where("n_chars <> length(text) and text is not null and bucket = 'z'").count() == 0


def test_line_dedup_is_native(docs):
    plan = line_dedup.drop_lines(docs.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_lines_of_a_template_go_however_many_there_are(spark):
    """One template with two fields of 30 values, one with few values, and a recurring short line, at three sizes."""
    rng = random.Random(4)
    for n in (60, 400, 2000):
        texts = [
            f"report sent by the user named{rng.randrange(30)} from room{rng.randrange(30)} to the main office\n"
            f"all the signs of level {'abcdefghi'[rng.randrange(9)]} stand on side {'klmnopqrs'[rng.randrange(9)]} of this road today\n"
            f"All rights reserved.\nmy own words {i} {rng.random()}"
            for i in range(n)
        ]
        out = line_dedup.drop_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()
        left = [r["text"].split("\n") for r in out]
        assert sum(x.startswith("report sent") for t in left for x in t) <= 1, n
        assert sum(x.startswith("all the signs") for t in left for x in t) <= 1, n
        assert sum(x == "All rights reserved." for t in left for x in t) == 1 and all("my own words" in t[-1] for t in left)


def test_each_line_of_a_document_counts(spark):
    """Two footers of one leaf in the same documents, one of them mostly of digits, go both."""
    footers = "call us at the office 10 20 30 40 50\ncall us at the office in our main town"
    rows = [(i, f"text number {i} {'x' * i}\n{footers}") for i in range(40)]
    out = line_dedup.drop_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sum("call us" in r["text"] for r in out) == 1 and sum(r["n_dropped"] for r in out) == 78


def test_pipeline(spark, tmp_path, docs, rows):
    """Each stage on its own input against what it promises, and run() against the stages."""
    pipeline = pytest.importorskip("corpus_pipeline")
    source = docs.select("doc_id", "text", "lang", "source", "n_chars")
    source.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    read = spark.read.parquet(str(tmp_path / "documents.parquet"))
    made = read
    for k, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, made, str(tmp_path)).write.parquet(str(tmp_path / f"s{k}"))
        after = spark.read.parquet(str(tmp_path / f"s{k}"))
        if k < 4:
            assert after.columns == read.columns, name
        if k == 1:
            assert after.count() == made.count()
        if k == 2:
            want = brute_components([(r["doc_id"], r["text"]) for r in made.collect()], 80, 5)
            assert {r["doc_id"] for r in after.collect()} == {d for (d, _), (size, c) in want.items() if size == 0 or c == d or d is None}
        made = after
    key = lambda r: (str(r["doc_id"]), r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(key, made.collect()))
