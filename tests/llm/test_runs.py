"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sievemill.llm import runs


def brute(words):
    """Every period, every stretch; a stretch counts with its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        start = 0
        for i in range(q, n + 1):
            if i == n or words[i] != words[i - q]:
                if i - start >= max(6, 4 * q):
                    found.setdefault((start, i), q)
                start = i - q + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def made(rng):
    """Words with runs inside runs, copies of stretches with runs, and noise."""
    words = []
    for _ in range(rng.randint(1, 12)):
        kind = rng.random()
        if kind < 0.4:
            words += [rng.choice("abc") for _ in range(rng.randint(1, 5))] * rng.randint(1, 8)
        elif kind < 0.7 and words:
            a = rng.randrange(len(words))
            words += words[a : a + rng.randint(1, 40)]
        else:
            words += [rng.choice("abcdefgh") for _ in range(rng.randint(1, 12))]
    return [w.encode() for w in words]


def test_against_brute_force():
    rng = random.Random(2)
    texts = [made(rng) for _ in range(1500)] + [[], [b"a"] * 5, [b"a"] * 6, [b"a", b"b"] * 4, [b"x"] * 3000, [b"a", b"a", b"b"] * 700]
    assert any(len(brute(t)) > 3 for t in texts)
    for k in range(0, len(texts), 50):
        for text, found in zip(texts[k : k + 50], runs.runs_of(texts[k : k + 50])):
            assert found == brute(text), text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b"]), max_size=40), max_size=3))
def test_two_words(texts):
    assert runs.runs_of(texts) == [brute(t) for t in texts]


def test_parts():
    """Suffix array, common prefixes and suffixes, previous factors and blocks of one text."""
    rng = random.Random(3)
    for _ in range(60):
        words = [rng.choice("ab") for _ in range(rng.randint(1, 40))]
        n = len(words)
        names = runs.Names(np.array([ord(w) for w in words]), np.array([0, n]))
        order = np.argsort(names.rank).tolist()
        assert order == sorted(range(n), key=lambda i: words[i:])
        common = lambda x, y: next((k for k, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))
        a, b = np.array([(i, j) for i in range(n) for j in range(n) if i != j] or np.zeros((0, 2), int), int).reshape(-1, 2).T
        assert names.ahead(a, b).tolist() == [common(words[i:], words[j:]) for i, j in zip(a, b)]
        assert names.behind(a, b).tolist() == [common(words[:i][::-1], words[:j][::-1]) for i, j in zip(a, b)]
        length, source = runs.previous_factors(order, [0, *names.ahead(np.array(order[:-1], int), np.array(order[1:], int)).tolist()])
        assert length == [max([common(words[i:], words[j:]) for j in range(i)], default=0) for i in range(n)]
        assert all(s < i and words[s : s + k] == words[i : i + k] for i, (s, k) in enumerate(zip(source, length)) if k)
        starts = runs.blocks(length)
        assert starts[-1] == n and all(e - b == max(1, length[b]) for b, e in zip(starts[:-1], starts[1:]))


def digest(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (
        doc_id, len(found), *top, top[0] if top[0] is None else 1000 * top[1] // top[2],
        sha("".join(f"{s},{k},{q}\n" for s, k, q in found).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query(spark, sf):
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    out = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in runs.op12_runs(spark, sf).collect()}
    assert len(out) == len(texts) and sum(x[1] > 0 for x in out.values()) > 3
    short = [r for r in texts if len((r.text or "").split()) < 1500]
    for r in short:
        assert out[r.doc_id] == digest(r.doc_id, r.text)


def test_operator(spark, docs, rows, empty):
    long = [(5, "tick tock " * 40000), (5, "tick tock " * 40000), (None, "no " * 7 + "way " * 3), (6, None)]
    df = docs.select("doc_id", "text", "size").union(spark.createDataFrame([(*r, 0) for r in long], "doc_id long, text string, size int"))
    found = runs.find_runs(df).collect()
    assert len(found) == len(rows) + 4
    want = [(i, brute((t or "").encode().split())) for i, t, *_ in rows] + [(5, [(0, 80000, 2)])] * 2 + [(None, [(0, 7, 1)]), (6, [])]
    assert sorted((str(r.doc_id), [tuple(x) for x in r.runs]) for r in found) == sorted((str(i), x) for i, x in want)
    assert {r.collapsed for r in found if r.doc_id == 5 and r.best and r.best.length == 80000} == {"tick tock"}
    assert [r.collapsed for r in found if r.doc_id is None and r.best] == ["no way way way"]
    assert runs.find_runs(empty).count() == 0
