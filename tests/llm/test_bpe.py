"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import numpy as np
import pytest

from sievemill.llm import byte_bpe


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(), special_tokens={})


@pytest.mark.parametrize("leaf, span", [(2, 8), (8, 2048)])
def test_codec(library, leaf, span, monkeypatch):
    monkeypatch.setattr(byte_bpe, "LEAF", leaf)
    monkeypatch.setattr(byte_bpe, "SPAN", span)
    monkeypatch.setattr(byte_bpe, "KEPT", 500)
    codec, rng = byte_bpe.Codec(byte_bpe.read_ranks()), random.Random(4)
    some = ["a", "b", " ", "  ", "\n", "\t", "'", "s", "re", "'ll", "é", "ſ", "漢", "字", "1", "²", "Ⅷ", "!", "_", " ", "　", "the", "ing", "AAAA", "\r", "😀", "​"]
    texts = ["", " ", "\n", " a", "a ", "<|endoftext|>", "a" * 3000, "ab" * 500 + " " + "é" * 999, " " * 700 + "x", "x\n \n y  z" * 90, "can't" * 400, ("word " * 30 + "x" * 300) * 9]
    for k in range(3000):
        texts.append("".join(rng.choice(some[: 6 if k % 2 else 99]) for _ in range(rng.randint(0, 40))) * (rng.randint(1, 30) if k % 50 == 0 else 1))
    for text in texts:
        ids = np.frombuffer(codec.encode(text), "<i4").tolist()
        assert ids == library.encode_ordinary(text), text[:80]
        assert codec.decode(ids) == text.encode()


def test_merging(library):
    """Both ways of direct merging agree, and joins of any two parts give the whole."""
    codec, rng = byte_bpe.Codec(byte_bpe.read_ranks()), random.Random(1)
    for _ in range(500):
        raw = "".join(rng.choice(["a", "the", "tion", "é", "0", "aa", " "]) for _ in range(rng.randint(1, 20))).encode()
        whole, at = codec.merged_long(raw), rng.randint(0, len(raw))
        assert codec.merged_short(raw) == whole == list(codec.reduced(raw))
        if 0 < at < len(raw):
            assert list(codec.join(tuple(codec.merged(raw[:at])), tuple(codec.merged(raw[at:])))) == whole


def test_operator(spark, docs, rows, empty, library, monkeypatch):
    long = spark.createDataFrame([(-1, "lorem ipsum, " * 30000), (None, None)], "doc_id long, text string")
    found = byte_bpe.encode(docs.select("doc_id", "text").union(long))
    assert found.columns == ["doc_id", "ids"]
    want = sorted(((str(i), tuple(library.encode_ordinary(t or ""))) for i, t, *_ in [*rows, (-1, "lorem ipsum, " * 30000), (None, None)]))
    assert sorted((str(r.doc_id), tuple(r.ids)) for r in found.collect()) == want
    back = byte_bpe.decode(found).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in back) == sorted((str(i), (t or "").encode()) for i, t, *_ in [*rows, (-1, "lorem ipsum, " * 30000), (None, None)])
    assert byte_bpe.decode(byte_bpe.encode(empty)).count() == 0
    odd = spark.createDataFrame([(1, None, 5), (2, [], 6)], "doc_id long, ids array<int>, decoded int")
    assert [bytes(r.decoded) for r in byte_bpe.decode(odd).collect()] == [b"", b""]
    for bad in ([50256], [-1], [None]):
        with pytest.raises(Exception, match="no token has the id"):
            byte_bpe.decode(spark.createDataFrame([(1, bad)], "doc_id long, ids array<int>")).collect()


def test_query(spark, sf, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    out = byte_bpe.op11_byte_bpe(spark, sf).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
