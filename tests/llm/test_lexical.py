"""Ranked lexical search against brute force; test_sql compares it with SQL."""

import collections
import math
import random
import re

import numpy as np
import pytest

from sievemill.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    counts = [(i, collections.Counter(terms(t))) for i, t in docs]
    held, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    holding = collections.Counter(t for _, c in counts for t in c)
    wanted = collections.defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    out = []
    for item, own in wanted.items():
        scores = []
        for doc, c in counts:
            if c:
                m = 10 + 90 * sum(c.values()) * held // total
                s = sum(math.floor(1000 * math.log((2 * held + 2) / (2 * holding[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in own if c[t])
                scores.append((-s, doc is None, doc))
        out += [(item, k + 1, doc, -s) for k, (s, _, doc) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top]) if s < 0]
    return out


def test_terms():
    text = "Ünïcode-Wörter, A_b 3x7 İ ſ K\x7fdel nbsp 漢字。[x]{y}`z`"
    assert [t.decode() for t in lexical.terms(text.encode())] == terms(text)


def test_radix_order():
    rng = np.random.default_rng(1)
    for high in (1, 5, 70_000, 1 << 40):
        keys = rng.integers(0, high, 3000)
        assert (lexical.radix_order(keys) == np.argsort(keys, kind="stable")).all()
    assert len(lexical.radix_order(np.zeros(0, np.int64))) == 0


ITEMS = "item_id long, text string, doc_id int, score string"


@pytest.fixture(scope="module")
def items(rows):
    rng = random.Random(8)
    out = [(k, " ".join((rng.choice(rows)[1] or "none").split()[: rng.randint(1, 60)]), 1, "s") for k in range(25)]
    return [*out, (3, "more words for 3", 2, "t"), out[5], (None, "posted BY user", 3, None), (90, None, 4, ""), (91, " -- ", 4, "")]


@pytest.mark.parametrize("most", [1 << 18, 60])
def test_search(spark, docs, rows, items, most):
    long = [(-7, "posted by user " * 40000, None), (-7, "posted by user " * 40000, None)]
    df = docs.select("doc_id", "text", "kept").union(spark.createDataFrame(long, "doc_id long, text string, kept int"))
    found = lexical.search(df, spark.createDataFrame(items, ITEMS), most=most)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    key = lambda r: (str(r[0]), r[1])
    want = brute([r[:2] for r in rows] + [r[:2] for r in long], [r[:2] for r in items])
    assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)


def test_blocks(spark, items):
    pairs = lexical.term_pairs(spark.createDataFrame(items, ITEMS))
    parts = list(lexical.blocks(pairs, 60))
    assert len(parts) > 3 and all(sum(len(t) for _, t in p) <= 60 or len(p) == 1 for p in parts)
    assert sorted((str(i), t) for p in parts for i, own in p for t in own) == sorted((str(r.item), bytes(r.term)) for r in pairs.collect())


def test_ties_and_text_ids(spark):
    """Hundreds of equal scores over many tasks; items with textual ids."""
    df = spark.createDataFrame([(i, f"same words {'x' if i % 3 else 'y'}") for i in range(600, 0, -1)] + [(i, "other") for i in range(700, 900)], "doc_id long, text string").repartition(7)
    found = lexical.search(df, spark.createDataFrame([("b", "same words"), ("a", "y")], "item_id string, text string")).collect()
    assert [r.doc_id for r in sorted(found, key=lambda r: (r.item_id, r["rank"]))] == [*range(3, 33, 3), *range(1, 11)]


def test_empty(spark, docs, empty):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.search(empty, items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(spark.createDataFrame([(1, " . "), (2, None)], "doc_id long, text string"), items).count() == 0
