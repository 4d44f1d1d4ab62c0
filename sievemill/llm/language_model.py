"""LM scoring by a hierarchical Pitman-Yor model.

Each word that comes before others is a restaurant, and the end token, which comes before a text's first word, is one
too. The parent of a word's restaurant is that of its class, told by its ending; all classes share one parent, the
unigram restaurant, whose base is uniform over the vocabulary and one unknown word. Customers of the words' restaurants
are the training tokens; customers of a parent are its children's tables. Seatings are sampled by Gibbs sweeps: each
sweep seats the customers of every (word before, word) anew by the Chinese restaurant process, given all others, with
Metropolis tests that make up for the process' order; then those of the classes and of the unigram restaurant.
Predictive probabilities are averaged over the sweeps after the burn-in.

Documents lie in blocks of about BLOCK_BYTES of text, and words meet by hash in as many buckets, with all histories they
follow; so scores follow the corpus and not a cluster's settings. A block asks for each distinct (word before, word) it
holds once and gets the counts and tables of all levels back, whole numbers, from which it derives the probability. A
restaurant's words lie in many buckets: the bucket of the restaurant's own word sums its tables before each sweep and
tells those who need them, as do the totals of all tasks for classes and unigrams. A sweep reads the seatings of the one
before and writes its own, which only pairs of several customers need. The totals of the final probabilities are exact
too, so they add up to one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemill.llm.common import _LOWER, Words, as_bytes, chunks, cut, mix, pack, release

CONTEXTS = 128
#: (discount, strength) of the words' restaurants, of the contexts (classes) and of the parent.
HISTORY, CONTEXT, PARENT = (0.9, 1.0), (0.8, 20.0), (0.6, 20.0)
BURN_IN, SAMPLES = 2, 4
EXACT_STEPS = 64
#: Metropolis steps on each seating that is drawn afresh in a sweep.
PARENT_STEPS = 2
SEED = 10
#: Text of a block; a task holds one block, or one bucket of words, at a time.
BLOCK_BYTES = 1 << 24
U = np.uint64
_END = int(mix(np.array([0xE0D], U))[0])
_CONTEXT_BITS = U(CONTEXTS - 1)


def token_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(key of each token, tokens of each text). A key is the word's hash, 57 bits of it, and the context in the rest; each text ends with an end token."""
    keys, counts = [], []
    for a, b in chunks([len(t) for t in texts]):
        w = Words(texts[a:b])
        n = np.diff(w.first)
        size = w.ends - w.starts
        low = [_LOWER[w.raw[np.maximum(w.ends - i, 0)]].astype(U) * (size >= i).astype(U) for i in (1, 2, 3)]
        code = low[0] | low[1] << U(8) | low[2] << U(16) | np.minimum(size, 4).astype(U) << U(24)
        klass = U(1) + mix(code) % U(CONTEXTS - 1)
        total = len(w.hash) + (b - a)
        word, before = np.full(total, _END, U), np.zeros(total, U)
        at = np.arange(len(w.hash)) + w.doc
        word[at] = w.hash
        before[at + 1] = klass  # the next token of the same text, which has its end token at least
        keys.append(word & ~_CONTEXT_BITS | before)
        counts.append(n + 1)
    return (np.concatenate(keys), np.concatenate(counts)) if keys else (np.zeros(0, U), np.zeros(0, np.int64))


def histories(keys: np.ndarray) -> np.ndarray:
    """The word before each token: the token before it, as the end token of the text before opens the next one."""
    return np.concatenate([np.array([_END], U) >> U(7), keys[:-1] >> U(7)])[: len(keys)]


def distinct_pairs(keys: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (key, word before), in order, and the place of each given one among them."""
    order = np.lexsort((before, keys))
    k, b = keys[order], before[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (b[1:] != b[:-1])
    place = np.empty(len(k), np.int64)
    place[order] = np.cumsum(new) - 1
    return k[new], b[new], place


def ranks(x: np.ndarray) -> np.ndarray:
    """Of ascending values: 0 for the smallest, 1 for the next one."""
    return np.cumsum(np.concatenate([[0], x[1:] != x[:-1]])[: len(x)], dtype=np.int64)


def squeeze(x: np.ndarray) -> bytes:
    """Compressed by planes: the lowest byte of each value first, then the next ones, which mostly are zero."""
    raw = np.ascontiguousarray(x).view("u1").reshape(-1, x.dtype.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd").compress(raw, asbytes=True)


def widen(x: bytes, kind: str) -> np.ndarray:
    raw = pa.Codec("zstd").decompress(x[8:], int.from_bytes(x[:8], "little"), asbytes=True)
    planes = np.frombuffer(raw, "u1").reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def bucket_of(keys: np.ndarray, wide: int) -> np.ndarray:
    return ((keys >> U(7)) % U(wide)).astype(np.int64)


def by_count(count: np.ndarray) -> np.ndarray:
    """Places of the counts above one, by falling count."""
    order = np.argsort(-count, kind="stable")
    return order[: np.count_nonzero(count > 1)]


def propose(count: np.ndarray, new: np.ndarray, discount: float, rng: np.random.Generator, rise: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Tables of each dish after its customers (count, falling) sat down one by one, new being the weight of a new
    table, to which each table of the dish adds rise, and the log weight by which the process misses the posterior.
    After EXACT_STEPS customers, up to a sixteenth of those seated sit down at once."""
    tables, weight = np.ones(len(count)), np.zeros(len(count))
    seated = 1
    while len(count) and seated < count[0]:
        m = int(np.searchsorted(-count, -seated, "left"))
        n = np.minimum(1 if seated < EXACT_STEPS else seated // 16, count[:m] - seated)
        fresh = new[:m] if rise is None else new[:m] + rise[:m] * tables[:m]
        total = fresh + seated - discount * tables[:m]
        tables[:m] += rng.random(m) * total < fresh if seated < EXACT_STEPS else rng.binomial(n, np.minimum(1, fresh / total))
        weight[:m] += n * np.log(total)
        seated += 1 if seated < EXACT_STEPS else seated // 16
    return tables, weight


class Sampler:
    """Seatings of contexts and parent for one bucket of words, sweep by sweep."""

    def __init__(self, count: np.ndarray, context: np.ndarray, word: np.ndarray, words: int, seed: int):
        order = np.argsort(-count, kind="stable")
        self.order, self.seed = order[: np.count_nonzero(count)], seed
        self.pairs, self.words = len(count), words
        self.count, self.context, self.word = count[self.order], context[self.order], word[self.order]
        # Pairs of one customer have one table for good; only those before them are seated.
        self.several = int(np.count_nonzero(self.count > 1))
        self.tables, self.logw = np.minimum(self.count, 1).astype(float), None
        self.parent = np.minimum(np.bincount(self.word, minlength=words), 1).astype(float)
        self.vocabulary = int((self.parent > 0).sum())
        self.done, self.kept = 0, []

    def totals(self) -> np.ndarray:
        """Tokens, vocabulary, parent tables, customers of each context, tables of each context; to be summed over all tasks."""
        return np.concatenate([[self.count.sum(), self.vocabulary, self.parent.sum()], np.bincount(self.context, self.count, CONTEXTS), np.bincount(self.context, self.tables, CONTEXTS)])

    def sweep(self, totals: np.ndarray, steps: int = 0) -> None:
        """One Gibbs sweep, given the totals of all tasks before it. steps: Metropolis steps on the contexts' seating."""
        (d, strength), (d0, strength0), words, m = CONTEXT, PARENT, self.words, self.several
        rng, tables = np.random.default_rng((SEED, self.seed, self.done)), totals[3 + CONTEXTS :]
        back_off = (strength0 + d0 * totals[2]) / (max(1, totals[1]) + 1)
        customers = np.bincount(self.word, self.tables, words)
        mean = (customers - d0 * self.parent + back_off) / (strength0 + tables.sum())
        new = (strength + d * tables)[self.context[:m]] * mean[self.word[:m]]
        asked, weight = propose(self.count[:m], new, d, rng)
        for _ in range(steps):
            other, better = propose(self.count[:m], new, d, rng)
            take = np.log(rng.random(m)) < better - weight
            asked, weight = np.where(take, other, asked), np.where(take, better, weight)
        if self.logw is not None:
            take = np.log(rng.random(m)) < weight - self.logw
            asked, weight = np.where(take, asked, self.tables[:m]), np.where(take, weight, self.logw)
        self.tables[:m], self.logw = asked, weight
        self.tables[m:] = 1
        customers = np.bincount(self.word, self.tables, words).astype(np.int64)
        rank = np.argsort(-customers, kind="stable")
        rank = rank[: np.count_nonzero(customers)]
        again = int(np.count_nonzero(customers > 1))
        asked, weight = propose(customers[rank], np.full(len(rank), back_off), d0, rng)
        # The customers changed with the sweep, so the parent starts from a seating drawn afresh.
        for _ in range(PARENT_STEPS):
            other, better = propose(customers[rank[:again]], np.full(again, back_off), d0, rng)
            take = np.log(rng.random(again)) < better - weight[:again]
            asked[:again], weight[:again] = np.where(take, other, asked[:again]), np.where(take, better, weight[:again])
        self.parent = np.zeros(words)
        self.parent[rank] = asked
        self.kept = (self.kept if self.done > BURN_IN else []) + [(self.tables[:m].copy(), self.parent)]
        self.done += 1

    def samples(self) -> tuple[np.ndarray, np.ndarray]:
        """Tables (SAMPLES, pairs) and parent tables (SAMPLES, words), after all sweeps."""
        out = np.zeros((SAMPLES, self.pairs))
        out[:, self.order] = np.minimum(self.count, 1)
        for row, (tables, _) in zip(out, self.kept):
            row[self.order[: self.several]] = tables
        return out, np.array([p for _, p in self.kept]).reshape(SAMPLES, -1)


def sample_tables(count: np.ndarray, context: np.ndarray, word: np.ndarray, words: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Tables (SAMPLES, pairs) and parent tables (SAMPLES, words) where one bucket holds all words."""
    sampler = Sampler(count, context, word, words, seed)
    for _ in range(BURN_IN + SAMPLES):
        sampler.sweep(sampler.totals())
    return sampler.samples()


class Seating:
    """All levels of one bucket: pairs (word before, word) of several customers, by falling count, above them pairs
    (class, word) with n of the former each, and words. packed: as pack() gave it. kept: seatings (tables of the pairs of
    several customers, of the pairs of class and word, of words) of the last sweep or of those after the burn-in."""

    KINDS = ("<i8", "<u4", "<u4", "<u4", "<u4", "u1", "<u4", "<u4")

    def __init__(self, bucket: int, packed: list[bytes]):
        first = [widen(x, k).astype(np.int64) for x, k in zip(packed, self.KINDS)]
        (self.done, self.tokens, self.words), self.count, self.klass, self.wanted, self.sizes, self.context, self.word, self.n = first
        self.bucket, self.static = bucket, packed[1 : len(first)]
        flat = [widen(x, "<u4").astype(float) for x in packed[len(first) :]]
        self.kept = [tuple(flat[i : i + 3]) for i in range(0, len(flat), 3)]
        known = np.minimum(np.bincount(self.word, self.n, self.words), 1)
        # At first each customer of a word's restaurant has a table.
        self.tables, self.below, self.parent = self.kept[-1] if self.kept else (self.count.astype(float), np.minimum(self.n, 1.0), known)

    def pack(self) -> list[bytes]:
        head = squeeze(np.array([self.done, self.tokens, self.words], "<i8"))
        return [head, *self.static, *[squeeze(x.astype("<u4")) for seating in self.kept for x in seating]]

    def customers(self, tables: np.ndarray) -> np.ndarray:
        """Of the pairs of class and word: tables of the pairs below."""
        return self.n + np.bincount(self.klass, tables - 1, len(self.n))

    def totals(self) -> np.ndarray:
        """As the Sampler's."""
        customers = np.bincount(self.context, self.customers(self.tables), CONTEXTS)
        return np.concatenate([[self.tokens, (self.parent > 0).sum(), self.parent.sum()], customers, np.bincount(self.context, self.below, CONTEXTS)])

    def extra(self, tables: np.ndarray) -> list[np.ndarray]:
        """Tables beyond one a pair of the restaurants with pairs of several customers, by their words' bucket."""
        return np.split(np.bincount(self.wanted, tables - 1, self.sizes.sum()).astype("<u4"), np.cumsum(self.sizes)[:-1])

    def sweep(self, totals: np.ndarray, restaurants: np.ndarray) -> None:
        """One Gibbs sweep, given the totals of all tasks and the tables of the wanted restaurants before it."""
        (d1, strength1), (d, strength), (d0, strength0) = HISTORY, CONTEXT, PARENT
        customers, tables = totals[3 : 3 + CONTEXTS], totals[3 + CONTEXTS :]
        back_off = (strength0 + d0 * totals[2]) / (max(1, totals[1]) + 1)
        mean0 = (np.bincount(self.word, self.below, self.words) - d0 * self.parent + back_off) / (strength0 + tables.sum())
        mean = self.customers(self.tables) - d * self.below + (strength + d * tables)[self.context] * mean0[self.word]
        mean /= (strength + customers)[self.context]
        rng = np.random.default_rng((SEED, self.bucket, self.done, 1))
        # A word's restaurant may hold little else, so a pair's own tables count as they stand and not as they were.
        rise = d1 * mean[self.klass]
        new = (strength1 + d1 * (restaurants[self.wanted] - self.tables)) * mean[self.klass]
        asked, weight = propose(self.count, new, d1, rng, rise)
        for _ in range(PARENT_STEPS):
            other, better = propose(self.count, new, d1, rng, rise)
            take = np.log(rng.random(len(asked))) < better - weight
            asked, weight = np.where(take, other, asked), np.where(take, better, weight)
        # The classes' customers changed, so their seating starts afresh, too.
        above = Sampler(self.customers(asked).astype(np.int64), self.context, self.word, self.words, self.bucket)
        above.done, above.parent, above.tables = self.done, self.parent, self.below[above.order]
        above.sweep(totals, PARENT_STEPS)
        below = np.zeros(len(self.n))
        below[above.order] = above.tables
        self.tables, self.below, self.parent = asked, below, above.parent
        self.kept = (self.kept if self.done > BURN_IN else []) + [(self.tables, self.below, self.parent)]
        self.done += 1


class Totals:
    """Exact sums over all tasks: tokens, vocabulary, customers of each context, tables of each context, parent customers and tables by sample."""

    SIZE = 2 + CONTEXTS + SAMPLES * (CONTEXTS + 2)

    def __init__(self, flat: np.ndarray):
        self.tokens, self.vocabulary = int(flat[0]), int(flat[1])
        self.customers = np.tile(flat[2 : 2 + CONTEXTS], (SAMPLES, 1))
        rest = flat[2 + CONTEXTS :].reshape(SAMPLES, CONTEXTS + 2)
        self.tables, self.parent_customers, self.parent_tables = rest[:, :CONTEXTS], rest[:, CONTEXTS], rest[:, CONTEXTS + 1]

    @staticmethod
    def of(count: np.ndarray, context: np.ndarray, word_count: np.ndarray, tables: np.ndarray, parent: np.ndarray) -> list[int]:
        out = [count.sum(), (word_count > 0).sum(), *np.bincount(context, count, CONTEXTS)]
        for t, p in zip(tables, parent):
            out += [*np.bincount(context, t, CONTEXTS), t.sum(), p.sum()]
        return [int(x) for x in out]

    @classmethod
    def after(cls, totals: list[np.ndarray]) -> Totals:
        """From the totals before and after each sweep."""
        first, samples = totals[0], [(t[3 + CONTEXTS :], t[2]) for t in totals[1 + BURN_IN :]]
        out = cls(np.concatenate([first[:2], first[3 : 3 + CONTEXTS], *[np.append(t, [t.sum(), p]) for t, p in samples]]))
        out.customers = np.array([t[3 : 3 + CONTEXTS] for t in totals[1 + BURN_IN :]])
        return out

    def one(self, s, count, context, tables, customers, parent) -> np.ndarray:
        """Predictive probability in sample s of words in classes."""
        (d, strength), (d0, strength0) = CONTEXT, PARENT
        mean = (customers - d0 * parent + (strength0 + d0 * self.parent_tables[s]) / (self.vocabulary + 1)) / (strength0 + self.parent_customers[s])
        return (count - d * tables + (strength + d * self.tables[s][context]) * mean) / (strength + self.customers[s][context])

    def probability(self, count, context, tables, customers, parent) -> np.ndarray:
        """The same averaged over the samples; tables, customers and parent are (SAMPLES, n)."""
        return sum(self.one(s, count, context, tables[s], customers[s], parent[s]) for s in range(SAMPLES)) / SAMPLES

    def after_words(self, keys: np.ndarray, before: np.ndarray, pairs: np.ndarray, classes: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Predictive probability, averaged over the samples, of distinct pairs (key, word before) in order, each word
        before being among the words. pairs: count and tables by sample; classes: customers by sample, then tables;
        words: count, tables of its restaurant by sample, tables in the classes, tables in the parent."""
        d1, strength1 = HISTORY
        klass = ranks(keys)
        distinct = keys[np.flatnonzero(np.diff(klass, prepend=-1))]
        word, context = ranks(distinct >> U(7)), (distinct & _CONTEXT_BITS).astype(np.int64)
        history = np.searchsorted(np.unique(keys >> U(7)), before)
        total = 0
        for s in range(SAMPLES):
            restaurant, customers, parent = (words[1 + s + SAMPLES * i] for i in range(3))
            mean = self.one(s, classes[s], context, classes[SAMPLES + s], customers[word], parent[word])
            total = total + (pairs[0] - d1 * pairs[1 + s] + (strength1 + d1 * restaurant)[history] * mean[klass]) / (strength1 + words[0])[history]
        return total / SAMPLES


def _blocks(docs: DataFrame, wide: int) -> DataFrame:
    """(block, doc_id, held_out, text) dealt so that a block is a partition."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    block = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(wide)).cast("int")
    return docs.select(block.alias("block"), F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")


#: kind: what parts are (below). sender: the bucket or block they come from.
MESSAGE = "bucket int, kind int, sender int, parts array<binary>"
#: Seating, packed. Answers: blocks and places of their pairs, counts of all pairs, new classes, new words, counts of words.
#: Words before: hashes, numbers of pairs, whether their tables are needed. Owner: numbers of pairs of its restaurants and
#: for each bucket those it needs. Extra: tables beyond one a pair. Tables: of the restaurants needed. Own: of all of a bucket.
SEATING, ANSWERS, BEFORE, OWNER, EXTRA, TABLES, OWN = range(7)


def _messages(rows: list[tuple[int, int, int, list[bytes]]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.binary()))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["bucket", "kind", "sender", "parts"])


def _received(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[tuple[int, list[bytes]]]]]]:
    """Each bucket with its messages by kind, by sender."""
    found: dict[int, dict[int, list[tuple[int, list[bytes]]]]] = {}
    for batch in batches:
        for bucket, kind, sender, parts in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "sender", "parts"))):
            found.setdefault(bucket, {}).setdefault(kind, []).append((sender, parts))
    for bucket in sorted(found):
        own = found.pop(bucket)
        for x in own.values():
            x.sort(key=lambda m: m[0])
        yield bucket, own


ANSWER = "block int, kind int, doc_id long, held_out boolean, text string, bucket int, p binary"


def score(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row of docs (doc_id, text).

    Null text is empty: an end token alone. A null doc_id belongs to training. Repeated rows are scored alike and each
    counts in training. Without training documents all words are unknown. Other columns are not read; an empty table
    gives an empty table. Reruns agree, on any number of partitions. Texts of any length are taken whole.
    """
    total_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wide = 1 + total_bytes // block_bytes
    blocks = _blocks(docs, wide)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[tuple[np.ndarray, ...]]] = {}
        for batch in batches:
            block, held, texts = batch.column(0).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False), as_bytes(batch.column(3))
            for k in np.unique(block):
                for train in (True, False):
                    own = np.flatnonzero((block == k) & (held != train))
                    tokens = token_keys([texts[i] for i in own])[0]
                    keys, before, place = distinct_pairs(tokens, histories(tokens))
                    found.setdefault(int(k), []).append((keys, before, np.bincount(place, minlength=len(keys)) * train))
        for k, parts in found.items():
            keys, before, place = distinct_pairs(*(np.concatenate([p[i] for p in parts]) for i in (0, 1)))
            n = np.bincount(place, np.concatenate([p[2] for p in parts]), len(keys)).astype("<u4")
            rows = []
            for bucket, (own, word, count) in pack(bucket_of(keys, wide), keys, before, n):
                rows.append((bucket, ANSWERS, k, [squeeze(np.frombuffer(own, U)), squeeze(np.frombuffer(word, U)), squeeze(np.frombuffer(count, "<u4"))]))
            yield _messages(rows)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, messages in _received(batches):
            asked = messages[ANSWERS]
            parts = [(widen(k, "<u8"), widen(b, "<u8"), widen(n, "<u4")) for _, (k, b, n) in asked]
            keys, before, place = distinct_pairs(*(np.concatenate([p[i] for p in parts]) for i in (0, 1)))
            count = np.bincount(place, np.concatenate([p[2] for p in parts]), len(keys)).astype(np.int64)
            places = np.split(place, np.cumsum([len(p[0]) for p in parts])[:-1])
            klass = ranks(keys)
            first = np.flatnonzero(np.diff(klass, prepend=-1))
            word = ranks(keys[first] >> U(7))
            words = int(word[-1]) + 1
            word_count = np.bincount(word[klass], count, words)
            fixed = [np.array([k for k, _ in asked], "<i4"), count.astype("<u4"), np.diff(klass, prepend=-1).astype("u1"), np.diff(word, prepend=-1).astype("u1"), word_count.astype("<u4")]
            yield _messages([(bucket, ANSWERS, bucket, [squeeze(x) for x in fixed] + [squeeze(np.diff(p, prepend=0).astype("<u4")) for p in places])])
            trained = count > 0
            rest, at = np.unique(before[trained], return_inverse=True)
            needed = np.bincount(at, count[trained] > 1, len(rest)) > 0
            owner = (rest % U(wide)).astype(np.int64)
            order = np.argsort(owner, kind="stable")
            rank = np.zeros(len(rest), np.int64)
            rank[order[needed[order]]] = np.arange(needed.sum())
            every = np.zeros(len(keys), np.int64)
            every[trained] = rank[at]
            several = by_count(count)
            n = np.bincount(klass, trained, len(first))
            sizes = np.bincount(owner[needed], minlength=wide)
            seating = [np.array([0, count.sum(), words], "<i8"), *(x.astype("<u4") for x in (count[several], klass[several], every[several], sizes)), (keys[first] & _CONTEXT_BITS).astype("u1"), word.astype("<u4"), n.astype("<u4")]
            rows = [(bucket, SEATING, bucket, [squeeze(x) for x in seating])]
            for k, (own, pairs, need) in pack(owner, rest, np.bincount(at, minlength=len(rest)).astype("<u4"), needed.astype("u1")):
                rows.append((k, BEFORE, bucket, [squeeze(np.frombuffer(own, U)), squeeze(np.frombuffer(pairs, "<u4")), squeeze(np.frombuffer(need, "u1"))]))
            yield _messages(rows)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, messages in _received(batches):
            parts = [(widen(w, "<u8"), widen(n, "<u4"), widen(need, "u1") > 0) for _, (w, n, need) in messages[BEFORE]]
            rest, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            pairs = np.bincount(at, np.concatenate([p[1] for p in parts]), len(rest))
            places = [x[p[2]] for x, p in zip(np.split(at, np.cumsum([len(p[0]) for p in parts])[:-1]), parts)]
            senders = np.array([k for k, _ in messages[BEFORE]], "<i4")
            yield _messages([(bucket, OWNER, bucket, [squeeze(senders), squeeze(pairs.astype("<u4")), *[squeeze(np.diff(p, prepend=0).astype("<u4")) for p in places]])])

    def tell(last: bool):
        """Extra tables of the present seating, or of all samples, to the owners."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bucket, messages in _received(batches):
                seating = Seating(bucket, messages[SEATING][0][1])
                extra = [seating.extra(x) for x in ([k[0] for k in seating.kept] if last else [seating.tables])]
                yield _messages([(k, EXTRA, bucket, [squeeze(x) for x in parts]) for k, parts in enumerate(zip(*extra)) if len(parts[0])])

        return run

    def add(last: bool):
        """Tables of the restaurants, to those who need them, or of all samples, to the bucket of their words."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bucket, messages in _received(batches):
                senders, pairs, *places = messages[OWNER][0][1]
                place = dict(zip(widen(senders, "<i4").tolist(), (np.cumsum(widen(p, "<u4"), dtype=np.int64) for p in places)))
                pairs = widen(pairs, "<u4").astype(np.int64)
                tables = np.tile(pairs, (SAMPLES if last else 1, 1))
                for k, extra in messages.get(EXTRA, []):
                    for t, x in zip(tables, extra):
                        t[place[k]] += widen(x, "<u4")
                if last:
                    yield _messages([(bucket, OWN, bucket, [squeeze(t.astype("<u4")) for t in tables])])
                else:
                    yield _messages([(k, TABLES, bucket, [squeeze(tables[0][p].astype("<u4"))]) for k, p in place.items() if len(p)])

        return run

    def meet(*tables: DataFrame) -> DataFrame:
        out = tables[0]
        for x in tables[1:]:
            out = out.union(x)
        return out.repartitionById(wide, F.col("bucket"))

    asked = blocks.repartitionById(wide, F.col("block")).mapInArrow(ask, MESSAGE)
    made = cut(meet(asked).mapInArrow(gather, MESSAGE))
    of = lambda kind: made.where(F.col("kind") == kind)
    owners = cut(meet(of(BEFORE)).mapInArrow(own, MESSAGE))

    def total(seated: DataFrame) -> np.ndarray:
        """Sums of all tasks; they are whole numbers, so their order doesn't matter."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(3 + 2 * CONTEXTS)
            for bucket, messages in _received(batches):
                sums += Seating(bucket, messages[SEATING][0][1]).totals()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums)], ["place", "sum"])

        out = np.zeros(3 + 2 * CONTEXTS)
        for place, x in seated.mapInArrow(run, "place long, sum double").groupBy("place").agg(F.sum("sum")).collect():
            out[place] = x
        return out

    def sweep(seated: DataFrame, known: np.ndarray) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bucket, messages in _received(batches):
                seating = Seating(bucket, messages[SEATING][0][1])
                tables = [widen(x[0], "<u4") for _, x in messages.get(TABLES, [])]
                seating.sweep(known, np.concatenate(tables) if tables else np.zeros(0))
                yield _messages([(bucket, SEATING, bucket, seating.pack())])

        told = meet(owners, seated.mapInArrow(tell(False), MESSAGE)).mapInArrow(add(False), MESSAGE)
        return cut(meet(seated, told).mapInArrow(run, MESSAGE))

    seated = of(SEATING)
    before = [total(seated)]
    for _ in range(BURN_IN + SAMPLES):
        after = sweep(seated, before[-1])
        before.append(total(after))
        release(seated)
        seated = after
    totals = Totals.after(before)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, messages in _received(batches):
            seating = Seating(bucket, messages[SEATING][0][1])
            asking, count, klass, word, word_count, *places = messages[ANSWERS][0][1]
            count, word_count = widen(count, "<u4"), widen(word_count, "<u4")
            klass, word = (np.cumsum(widen(x, "u1"), dtype=np.int64) - 1 for x in (klass, word))
            several, pairs, classes, words = by_count(count.astype(np.int64)), [count], [], [word_count]
            for tables, _, _ in seating.kept:
                pairs.append(np.minimum(count, 1))
                pairs[-1][several] = tables
                classes.append(seating.customers(tables).astype("<u4"))
            classes += [x.astype("<u4") for _, x, _ in seating.kept]
            restaurants = np.zeros((SAMPLES, len(word_count)), "<u4")
            for _, parts in messages.get(OWN, []):
                # Each word of the training texts comes before another token there.
                restaurants[:, word_count > 0] = [widen(x, "<u4") for x in parts]
            words += [*restaurants, *[np.bincount(word, x, len(word_count)).astype("<u4") for _, x, _ in seating.kept], *[x.astype("<u4") for _, _, x in seating.kept]]
            for block, place in zip(widen(asking, "<i4").tolist(), places):
                at = np.cumsum(widen(place, "<u4"), dtype=np.int64)
                own = klass[at]
                own = own[np.flatnonzero(np.diff(own, prepend=-1))]
                of_words = word[own]
                of_words = of_words[np.flatnonzero(np.diff(of_words, prepend=-1))]
                flat = np.concatenate([x[i] for xs, i in ((pairs, at), (classes, own), (words, of_words)) for x in xs])
                yield pa.RecordBatch.from_pylist([{"block": block, "kind": 1, "bucket": bucket, "p": squeeze(flat)}], schema=_ARROW)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers: dict[int, list[tuple[int, bytes]]] = {}
        rows: dict[int, list[tuple[int | None, bool, bytes]]] = {}
        for batch in batches:
            block, kind = batch.column("block").to_pylist(), batch.column("kind").to_pylist()
            if 0 in kind:
                texts = as_bytes(batch.column("text"))
                for k, is_answer, doc_id, held, text in zip(block, kind, batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), texts):
                    if not is_answer:
                        rows.setdefault(k, []).append((doc_id, held, text))
            if 1 in kind:
                for k, is_answer, bucket, p in zip(block, kind, *(batch.column(x).to_pylist() for x in ("bucket", "p"))):
                    if is_answer:
                        answers.setdefault(k, []).append((bucket, p))
        for k, own in rows.items():
            tokens, counts = token_keys([r[2] for r in own])
            keys, before, at = distinct_pairs(tokens, histories(tokens))
            klass = ranks(keys)
            distinct = keys[np.flatnonzero(np.diff(klass, prepend=-1))]
            known = np.unique(distinct >> U(7))
            levels = [(x, bucket_of(x, wide)) for x in (keys, distinct, known << U(7))]
            pairs, classes, words = (np.empty((n, len(x)), "<u4") for n, (x, _) in zip((1 + SAMPLES, 2 * SAMPLES, 1 + 3 * SAMPLES), levels))
            places = [np.split(np.argsort(b, kind="stable"), np.cumsum(np.bincount(b, minlength=wide))[:-1]) for _, b in levels]
            for bucket, packed in answers.pop(k):
                flat = widen(packed, "<u4")
                for table, place in zip((pairs, classes, words), places):
                    table[:, place[bucket]], flat = flat[: len(table) * len(place[bucket])].reshape(len(table), -1), flat[len(table) * len(place[bucket]) :]
            p = totals.after_words(keys, before, pairs, classes, words)
            c = words[0].astype(np.int64)[ranks(distinct >> U(7))[klass]]
            text = np.repeat(np.arange(len(own)), counts)
            base = np.log10((c + 1) / (totals.tokens + totals.vocabulary + 1))
            columns = [counts, np.bincount(text, (c > 0)[at], len(own)).astype(np.int64), np.full(len(own), totals.tokens), np.bincount(text, base[at], len(own)), np.bincount(text, np.log10(p)[at], len(own))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in own], pa.int64()), pa.array([r[1] for r in own], pa.bool_()), *map(pa.array, columns)], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    texts = blocks.selectExpr("block", "0 as kind", "doc_id", "held_out", "text", "cast(null as int) as bucket", "cast(null as binary) as p")
    told = meet(owners, seated.mapInArrow(tell(True), MESSAGE)).mapInArrow(add(True), MESSAGE)
    both = texts.union(meet(of(ANSWERS), seated, told).mapInArrow(answer, ANSWER))
    return both.repartitionById(wide, F.col("block")).mapInArrow(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


_ARROW = pa.schema([("block", pa.int32()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("text", pa.string()), ("bucket", pa.int32()), ("p", pa.binary())])


def op10_language_model(spark, sf_dir):
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
