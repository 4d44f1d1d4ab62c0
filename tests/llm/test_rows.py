"""Operators that judge rows by themselves or by counts: mixing, tokens, quality, secrets, packing, scoring."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from sievemill.llm import language_model, mixing, packing, quality, secrets, tokens

SPACE = rb"[\x20\x09-\x0D]+"


def split(text):
    return [w for w in re.split(SPACE, (text or "").encode()) if w]


def fill(sizes, cycle=(1, 2, 3), cap=3):
    """Targets by resharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(order)}
    left, target, free = float(sum(sizes.values())), dict.fromkeys(sizes, 0.0), set(sizes)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > cap * sizes[s]}
        for s in over or free:
            target[s] = cap * sizes[s] if over else level * weight[s]
        if not over:
            break
        left -= sum(target[s] for s in over)
        free -= over
    return target


def test_mixing(spark, docs, rows, empty):
    slim = mixing.with_size_and_weight(docs.select("doc_id", "source", "text"))
    out = mixing.mix(slim, "size", "weight", ties=("tie",)).collect()
    assert len(out) == len(rows)
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len(split(r[1]))
    want, taken = fill(sizes), collections.Counter()
    for r in out:
        assert r["size"] == len(split(r["text"])) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] in (r["size"] * int(r["target"] // r["source_size"]), r["size"] * (int(r["target"] // r["source_size"]) + 1)) and r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(len(split(r[1])) for r in rows) / 2 + 1
    key = lambda r: (str(r["doc_id"]), r["text"] or "", r["taken"])
    assert sorted(map(key, mixing.mix(slim.repartition(9), "size", "weight", ties=("tie",)).collect())) == sorted(map(key, out))
    assert mixing.mix(mixing.with_size_and_weight(empty.select("doc_id", "source", "text")), "size", "weight").count() == 0
    repeated = mixing.repeat_documents(docs)
    assert repeated.columns == docs.columns and repeated.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == sum(taken.values())


def test_mixing_of_repeated_ids(spark):
    """Different texts under one id, and under none: reruns agree however the rows are dealt."""
    rows = [(7 if i % 2 else None, "a" if i % 3 else "b", " ".join(f"w{i}{k}" for k in range(5 + i))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    runs = []
    for parts in (1, 3, 8):
        slim = mixing.with_size_and_weight(df.repartition(parts))
        runs.append(sorted((r["text"], r["copies"]) for r in mixing.mix(slim, "size", "weight", ties=("tie",)).collect()))
    assert runs[0] == runs[1] == runs[2] and len({c for _, c in runs[0]}) > 1


def test_mixing_prefers_weight(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 3000, "a").otherwise("b").alias("source"), F.lit(1).cast("long").alias("size"), F.when(F.col("id") % 2 == 0, 4.0).otherwise(1.0).alias("weight"))
    out = mixing.mix(df, "size", "weight").where("source = 'a'").groupBy("weight").agg(F.sum("copies").alias("n")).collect()
    n = {r["weight"]: r["n"] for r in out}
    assert n[4.0] > 1.5 * n[1.0]


def test_token_tree():
    counter, rng = tokens.Counter(), random.Random(1)
    alphabet = ["a", "b", " ", "  ", "\n", "'s", "é", "1", "23", "!", "日", "x's", "\t", "the ", " and", "'"]
    some = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    for _ in range(400):
        text = some(rng.choice([0, 1, 5, 40, 300, 900]))
        tree = tokens.Tree(text, counter)
        for _ in range(6):
            a = rng.randint(0, len(text))
            b, new = min(len(text), a + rng.choice([0, 1, 3, 10, 100, 400])), some(rng.choice([0, 1, 2, 5, 60, 500]))
            tree.replace(a, b, new)
            text = text[:a] + new + text[b:]
            assert tree.text == text and tree.total == len(counter.encoding.encode_ordinary(text))


def test_token_counts(docs, rows, empty):
    counter = tokens.Counter()
    out = tokens.count_edited(docs).collect()
    assert len(out) == len(rows)
    texts = {r[0]: r[1] or "" for r in rows}
    for r in out:
        text = texts[r["doc_id"]]
        after = text
        for pattern, new in tokens.EDITS:
            after = re.sub(pattern, lambda _: new, after)
        assert (r["n_tokens"], r["n_tokens_after"], r["n_chars_after"]) == (len(counter.encoding.encode_ordinary(text)), len(counter.encoding.encode_ordinary(after)), len(after))
    assert any(r["n_edits"] for r in out) and tokens.count_edited(empty).count() == 0


def test_edits_encode_little():
    counter = tokens.Counter()
    tree = tokens.Tree("some words here " * 5000, counter)
    tree.encoded = 0
    tree.replace(40_000, 40_005, "else")
    assert tree.encoded < 1500


def base(text):
    words, lines = split(text), [x for x in (text or "").split("\n") if split(x)]
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    marked = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return [len(words), sum(len(w.decode()) for w in words), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(marked)]


def test_quality(spark, docs, rows, empty):
    out = quality.features(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        assert [r[c] for c in quality.BASE[:5]] == base(r["text"])
    kept = quality.filter_documents(docs)
    assert kept.columns == docs.columns and quality.filter_documents(empty).count() == 0
    left = {r["doc_id"] for r in kept.collect()}
    assert all("###" not in (r[1] or "") for r in rows if r[0] in left)
    clean = [r for r in rows if len(split(r[1])) >= 10 and "###" not in (r[1] or "") and 100 * base(r[1])[4] <= 20 * base(r[1])[0] and base(r[1])[3] == 0 and "ſ" not in r[1]]
    assert {r[0] for r in clean} <= left


def test_quality_thresholds_by_brute_force(spark):
    """kept against exact quantiles: all but documents within the sketches' accuracy of a fence."""
    rng = random.Random(6)
    rows = []
    for i in range(900):
        lang, source = rng.choice([("en", "a")] * 8 + [("en", "b"), ("de", "a"), (None, None)])
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(30, 200))]
        if rng.random() < 0.2:
            words = [w + rng.choice(["#", "##", "|$%", ""]) for w in words]
        lines = [" ".join(words[k : k + 10]) for k in range(0, len(words), 10)]
        rows.append((i, "\n".join(lines + lines[: rng.choice([0, 0, 0, 1])]), lang, source))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    feats = quality.features(df)
    judged = {r["doc_id"]: r for r in quality.judge(feats, quality.thresholds(feats)).collect()}

    def metrics(text):
        n_words, chars, symbols, dups, _ = base(text)
        return {"symbols_per_word": symbols / max(1, n_words), "dup_line_share": dups / max(1, len(text.split("\n"))), "word_length": chars / max(1, n_words)}

    passed = [r for r in rows if base(r[1])[0] >= 10 and 100 * base(r[1])[4] <= 20 * base(r[1])[0]]
    measured = {r[0]: metrics(r[1]) for r in rows}

    def fences(own):
        out = {}
        for m, (spread, above, below) in quality.FENCES.items():
            values = sorted(measured[r[0]][m] for r in own)
            q25, q50 = (values[max(0, math.ceil(q * len(values)) - 1)] for q in (0.25, 0.5))
            wide = max(q50 - q25, spread)
            out[m] = (-math.inf if below is None else q50 - below * wide, q50 + above * wide)
        return out

    def blend(n, own, more):
        return {m: tuple((n * x + quality.BORROWED * y) / (n + quality.BORROWED) for x, y in zip(own[m], more[m])) for m in own}

    everything, rejected = fences(passed), 0
    for doc_id, text, lang, source in rows:
        of_lang, of_group = ([r for r in passed if r[2] == lang and (r[3] == source or not narrow)] for narrow in (False, True))
        limits = blend(len(of_lang), fences(of_lang), everything)
        limits = blend(len(of_group), fences(of_group), limits)
        clear, keep = True, not judged[doc_id]["base_failed"]
        for m, (low, high) in limits.items():
            slack = (high - low) / 2 * 40 / max(1, base(text)[0]) if quality.FENCES[m][2] else 0.0
            near = 0.12 * max(abs(high), 0.02) + slack * 0.1
            v = measured[doc_id][m]
            clear = clear and abs(v - high - slack) > near and abs(v - low + slack) > near
            keep = keep and low - slack <= v <= high + slack
        rejected += not keep
        if clear:
            assert judged[doc_id]["kept"] == keep, (doc_id, measured[doc_id], limits)
    assert 20 < rejected < 500


def test_quality_quantiles(spark):
    """A quantile read from the sketch is within its accuracy, however the rows are dealt."""
    rng = random.Random(2)
    values = [rng.lognormvariate(0, 2) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(quality.bucket_value(quality.bucket(F.col("v"))).alias("b"), "v")
    assert all(abs(r["b"] - r["v"]) <= quality.ACCURACY * r["v"] * 1.0001 for r in df.collect())


def brute_secrets(text):
    text, out = text or "", []
    assign = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for kind, pattern, least, group in (("assign", assign, 6, 2), ("access", "AKIA[A-Z0-9]+", 20, 0), ("hex", "[0-9a-f]+", 24, 0)):
        out += [(m.start(), ("assign", "access", "hex").index(kind), kind, m.end()) for m in re.finditer(pattern, text) if len(m.group(group)) >= least]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


def test_secrets(spark, docs, rows, empty):
    out = secrets.scan(docs).collect()
    assert len(out) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in out:
        for rule in secrets.RULES:
            own = [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == rule.kind]
            assert own == [m.span() for m in re.finditer(rule.pattern, texts[r["doc_id"]] or "", re.ASCII) if len(m.group(rule.group)) >= rule.least]
        spans = [s for s in r["spans"] if s["kind"] in secrets.BASE_KINDS]
        assert ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans) == brute_secrets(texts[r["doc_id"]])
    assert any(r["spans"] for r in out) and secrets.scan(empty).count() == 0
    keys = ["-----BEGIN RSA PRIVATE KEY-----", "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl", "ghp_" + "a1B2" * 9, "xoxb-12345-abcdefgh", "sk_live_" + "4eC39HqL" * 2]
    more = [(i, f"{'é' * i} here is {k}, and\n{k.lower()} {k[:-1]}") for i, k in enumerate(keys)]
    for r in secrets.scan(spark.createDataFrame(more, "doc_id long, text string")).collect():
        text = more[r["doc_id"]][1]
        for rule in secrets.RULES:
            own = [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == rule.kind]
            assert own == [m.span() for m in re.finditer(rule.pattern, text, re.ASCII) if len(m.group(rule.group)) >= rule.least]
        assert any(s["kind"] == secrets.RULES[3 + r["doc_id"]].kind for s in r["spans"])


def test_trigram_queries():
    assert secrets.mandatory("AKIA[A-Z0-9]+") == [frozenset({"aki", "kia"})]
    assert secrets.mandatory("[0-9a-f]+") is None
    assert set(secrets.mandatory("(?i:api_?key)[0-9]")) == {frozenset({"api", "pik", "ike", "key"}), frozenset({"api", "pi_", "i_k", "_ke", "key"})}
    assert secrets.mandatory("ab|cde") is None
    matcher = secrets.Matcher((secrets.Rule("x", "abc.*def"),))
    postings = matcher.index([b"abc", b"zABC def", b"def", b"abxdef"])
    assert matcher.candidates(postings, matcher.rules[0][2], 4).tolist() == [1]


def test_packing(spark, docs, rows, empty):
    from tokenizers import Tokenizer
    import public_tokenizers

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = packing.pack_documents(docs, capacity=64, cut_at=8).collect()
    ids = {r[0]: [*reference.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in rows}
    crc = lambda x: zlib.crc32(b"".join(i.to_bytes(4, "little") for i in x))
    pieces = collections.defaultdict(list)
    for r in out:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own) and r["ids_crc32"] == crc(own[r["start"] : r["start"] + r["length"]])
        pieces[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sum(r["length"] for r in out) == sum(len(ids[r[0]]) for r in rows)
    for own in pieces.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(n for _, n in own) <= 64
    assert packing.pack_documents(empty).count() == 0


def test_shortest_pack_first():
    rng = random.Random(3)
    histogram = collections.Counter(rng.randint(1, 100) for _ in range(3000))
    patterns = packing.shortest_pack_first(histogram, 100)
    back = collections.Counter()
    for lengths, n in patterns:
        assert sum(lengths) <= 100
        for x in lengths:
            back[x] += n
    assert back == histogram
    assert sum(n for _, n in patterns) <= 1.02 * math.ceil(sum(k * v for k, v in histogram.items()) / 100)


@pytest.mark.parametrize("hot", [0, 900])
def test_cut_pieces_fill_gaps(hot):
    """Each token of each piece has one place, no place is taken twice, and little room is left, also with one frequent length."""
    rng = random.Random(hot)
    histogram = collections.Counter(rng.randint(1, 512) for _ in range(400)) + collections.Counter({210: hot})
    table = packing.slots(packing.shortest_pack_first(histogram, 512), 512, 8)
    parts, used = collections.defaultdict(list), collections.defaultdict(list)
    for length, a, b, at, n, sequence, offset in table:
        assert at % 8 == 0 and n > 0
        for r in range(a, b):
            parts[length, r].append((at, n))
            used[sequence + r - a].append((offset, n))
    assert set(parts) == {(k, r) for k, v in histogram.items() for r in range(v)}
    for whole, own in ((k[0], v) for k, v in parts.items()):
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) == whole
    for own in used.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= 512
    assert sum(k * v for k, v in histogram.items()) / (512 * len(used)) > 0.97


def test_checksums_of_parts():
    raw = bytes(random.Random(1).randrange(256) for _ in range(5000))
    for a, n in ((0, 5000), (128, 256), (4, 4), (1024, 3976)):
        assert packing.crc_of_end(zlib.crc32(raw[:a]), zlib.crc32(raw[: a + n]), n) == zlib.crc32(raw[a : a + n])


def test_scoring(spark, docs, rows, empty):
    low = lambda t: [w.lower() for w in split(t)] + [None]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    count = collections.Counter(w for r in rows if not held(r[0]) for w in low(r[1]))
    n = sum(count.values())
    out = language_model.score(docs).collect()
    assert len(out) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in out:
        own = low(texts[r["doc_id"]])
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(r["doc_id"]), len(own), sum(count[w] > 0 for w in own), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 1) / (n + len(count) + 1)) for w in own))
        assert r["score"] < 0 and math.isfinite(r["score"])
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert language_model.score(empty).count() == 0


def test_scores_do_not_follow_the_partitions(spark, docs):
    """The same scores, bit by bit, however many shuffle partitions there are."""
    key, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    runs = []
    for n in ("2", "7"):
        spark.conf.set(key, n)
        runs.append(sorted((str(r["doc_id"]), r["score"]) for r in language_model.score(docs.repartition(int(n)), 20_000).collect()))
    spark.conf.set(key, before)
    assert runs[0] == runs[1]


def test_probabilities_sum_to_one():
    """Over all words and the unknown one, in every context."""
    import numpy as np

    rng = np.random.default_rng(1)
    words, contexts = 40, 5
    context, word = (x.ravel() for x in np.meshgrid(np.arange(contexts), np.arange(words), indexing="ij"))
    count = rng.poisson(0.7, len(context))
    count[word == 0] = 300
    known = np.bincount(word, count, words) > 0
    tables, parent = language_model.sample_tables(count, context, word, words)
    assert ((tables <= count) & ((tables > 0) == (count > 0))).all()
    word_count = np.bincount(word, count, words).astype(np.int64)
    totals = language_model.Totals(np.array(language_model.Totals.of(count, context, word_count, tables, parent), float))
    customers = np.array([np.bincount(word, t, words) for t in tables])
    p = totals.probability(count.astype(float), context, tables, customers[:, word], parent[:, word])
    zero = np.zeros((language_model.SAMPLES, 1))
    for u in range(contexts):
        unknown = totals.probability(np.zeros(1), np.array([u]), zero, zero, zero)[0]
        assert p[(context == u) & known[word]].sum() + unknown == pytest.approx(1)


def test_digest_of_no_spans():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_sampler_gets_the_totals_of_all_tasks(spark, docs, monkeypatch):
    """Each sweep's totals are the sums over the tasks, which words dealt unevenly aren't in proportion to."""
    import numpy as np

    module, seen = language_model, []
    after = module.Totals.after.__func__
    monkeypatch.setattr(module.Totals, "after", classmethod(lambda cls, totals: (seen.append(list(totals)), after(cls, totals))[1]))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    module.score(docs, total // 4 + 1 + total // 16).count()
    texts = [r["text"] or "" for r in module._blocks(docs, 4).where("not held_out").collect()]
    keys, count = np.unique(module.token_keys([t.encode() for t in texts])[0], return_counts=True)
    context, bucket = (keys & module._CONTEXT_BITS).astype(np.int64), module.bucket_of(keys, 4)
    samplers = []
    for k in range(4):
        words, word = np.unique(keys[bucket == k] >> np.uint64(7), return_inverse=True)
        samplers.append(module.Sampler(count[bucket == k], context[bucket == k], word, len(words), k))
    want = sum(s.totals() for s in samplers)
    assert np.array_equal(seen[0][0], want) and len(seen[0]) == module.BURN_IN + module.SAMPLES + 1
    assert want[0] == count.sum() and want[1] == len(np.unique(keys >> np.uint64(7)))
    assert np.array_equal(want[3 + module.CONTEXTS :], np.bincount(context, minlength=module.CONTEXTS))
    assert max(abs(4 * s.totals()[0] - want[0]) for s in samplers) > 0.1 * want[0]
    assert [t[0] for t in seen[0]] == [want[0]] * len(seen[0])


def test_seatings_agree_with_a_brute_force_sampler(monkeypatch):
    """Mean numbers of tables, against a sampler that takes up and seats one customer after another."""
    import numpy as np

    module = language_model
    count = np.array([[9, 3, 0, 1], [4, 0, 6, 2], [1, 2, 2, 0]])
    contexts, words = count.shape
    (d, strength), (d0, strength0) = module.CONTEXT, module.PARENT
    rng = random.Random(5)
    # Tables of each (context, word) as lists of customers; those of the parent as lists of tables.
    below = {(u, w): [1] * int(count[u, w]) for u in range(contexts) for w in range(words) if count[u, w]}
    above = {w: [1] * sum(len(t) for (u, x), t in below.items() if x == w) for w in range(words)}

    def leave(tables):
        at = rng.choices(range(len(tables)), tables)[0]
        tables[at] -= 1
        if not tables[at]:
            del tables[at]
            return True

    def sit(tables, discount, fresh):
        at = rng.choices(range(len(tables) + 1), [n - discount for n in tables] + [fresh])[0]
        if at == len(tables):
            tables.append(1)
            return True
        tables[at] += 1

    def parent_weight():
        return (strength0 + d0 * sum(map(len, above.values()))) / (words + 1)

    tables_seen, parents_seen = np.zeros(count.shape), np.zeros(words)
    rounds = 3000
    for k in range(-100, rounds):
        for (u, w), tables in below.items():
            for _ in range(int(count[u, w])):
                if leave(tables):
                    leave(above[w])
                here = sum(len(t) for (x, _), t in below.items() if x == u)
                mean = (sum(above[w]) - d0 * len(above[w]) + parent_weight()) / (strength0 + sum(map(sum, above.values())))
                if sit(tables, d, (strength + d * here) * mean):
                    sit(above[w], d0, parent_weight())
        if k >= 0:
            for (u, w), tables in below.items():
                tables_seen[u, w] += len(tables) / rounds
            parents_seen += [len(above[w]) / rounds for w in range(words)]
    monkeypatch.setattr(module, "BURN_IN", 100)
    monkeypatch.setattr(module, "SAMPLES", 3000)
    context, word = (x.ravel() for x in np.indices(count.shape))
    tables, parent = module.sample_tables(count.ravel(), context, word, words)
    assert tables.mean(axis=0).reshape(count.shape) == pytest.approx(tables_seen, rel=0.12, abs=0.12)
    assert parent.mean(axis=0) == pytest.approx(parents_seen, rel=0.12, abs=0.12)


def test_scores_follow_the_word_before(spark):
    """Two words of one class, as their endings are alike, come before different words."""
    held = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 7 == 2][:4]
    train = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 7 != 2]
    rows = [(i, ("firstxyz left " if k % 2 else "otherxyz right ") * 3) for k, i in enumerate(train[:80])]
    rows += list(zip(held, ["firstxyz left", "firstxyz right", "otherxyz right", "otherxyz left"]))
    score = {r["doc_id"]: r["score"] for r in language_model.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    a, b, c, d = (score[i] for i in held)
    assert a > b + 1 and c > d + 1


def test_words_after_each_word_sum_to_one():
    """Over all words and the unknown one, after every word and after an unknown one; seatings fit together on all levels."""
    import numpy as np

    module, rng = language_model, np.random.default_rng(3)
    words = np.unique(rng.integers(1, 1 << 57, 30).astype(np.uint64))
    context = rng.integers(0, 6, len(words)).astype(np.uint64)
    # The last two words are no training words; one stands for all unknown ones after others, one for unknown histories.
    count = rng.poisson(0.6, (len(words), len(words)))
    count[3, :5] = 200
    count[:, -2:] = count[-2:] = 0
    u, w = (x.ravel() for x in np.indices(count.shape))
    keys, before, place = module.distinct_pairs(words[w] << np.uint64(7) | context[u], words[u])
    n = np.bincount(place, count.ravel(), len(keys)).astype(np.int64)
    history = np.searchsorted(words, before)
    klass = module.ranks(keys)
    first = np.flatnonzero(np.diff(klass, prepend=-1))
    word = module.ranks(keys[first] >> np.uint64(7))
    several = module.by_count(n)
    least = np.bincount(klass, n > 0, len(first))
    parts = [np.array([0, n.sum(), len(words)], "<i8"), *(x.astype("<u4") for x in (n[several], klass[several], history[several], np.array([len(words)])))]
    parts += [(keys[first] & module._CONTEXT_BITS).astype("u1"), word.astype("<u4"), least.astype("<u4")]
    packed, totals = [module.squeeze(x) for x in parts], []
    for _ in range(module.BURN_IN + module.SAMPLES):
        seating = module.Seating(0, packed)
        totals.append(seating.totals())
        seating.sweep(totals[-1], np.bincount(history, n > 0, len(words)) + seating.extra(seating.tables)[0])
        packed = seating.pack()
    totals = module.Totals.after([*totals, seating.totals()])
    assert len(seating.kept) == module.SAMPLES
    pairs, customers, restaurants = [n], [], []
    for tables, below, parent in seating.kept:
        assert ((tables >= 1) & (tables <= n[several])).all() and tables.max() > 1
        pairs.append(np.minimum(n, 1))
        pairs[-1][several] = tables
        customers.append(np.bincount(klass, pairs[-1], len(first)))
        assert np.array_equal(customers[-1], seating.customers(tables))
        assert ((below <= customers[-1]) & ((below > 0) == (customers[-1] > 0))).all()
        restaurants.append(np.bincount(history, pairs[-1], len(words)))
        assert (parent <= np.bincount(word, below, len(words))).all()
    classes = [*customers, *[x[1] for x in seating.kept]]
    levels = [count.sum(axis=1), *restaurants, *[np.bincount(word, x[1], len(words)) for x in seating.kept], *[x[2] for x in seating.kept]]
    p = totals.after_words(keys, before, *(np.array(x) for x in (pairs, classes, levels)))
    known = np.flatnonzero((levels[-1] > 0))
    of = np.searchsorted(words, keys >> np.uint64(7))
    for i in range(len(words)):
        assert p[(history == i) & (np.isin(of, known) | (of == len(words) - 1))].sum() == pytest.approx(1)
