"""N-gram Jaccard join by PartEnum signatures.

A document's set is its distinct word shingles. Two sets with Jaccard similarity of at least the threshold differ in
at most k elements, k fixed by their sizes. Sizes fall into bands that grow by 1 / threshold; a set signs for its own
band and for the next one, so any two sets that may link share a band's layout. A layout cuts the domain of shingle
hashes into n1 partitions of CELLS cells: k differences leave a partition with SPARED of them at most, and then the
cells of some subset of CELLS - SPARED are equal. Each subset's content, hashed, is a signature; equal sets aside,
linked sets share one.

Equal sets are one node. Where many nodes share a signature, they aren't compared pair by pair: each is compared with
a pivot, and only nodes that stay in different components are compared further, until none is left. Candidates are
ruled out by fingerprints, small enough to be written for each row; those left are checked on whole sets, made anew
from the texts, and no link that joins two components is lost. Neither sets nor signatures of all nodes are written.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemill.llm.common import Words, as_bytes, chunks, cut, dealt, gram_hashes, mix, pack, partitions, release

#: Cells of a partition, and how many of them a subset leaves out.
CELLS, SPARED = 3, 1
#: Nodes of a signature, by rank, that are compared with all others in other components, round by round; the last round leaves none.
ROUNDS = ((0, 1), (1, 8), (8, 1 << 40))
#: Signatures that meet in one task of these rounds, on average. A fingerprint goes to each task that has any of its
#: node's signatures, so more tasks mean more copies, while a task's memory follows the fingerprints.
SIGNATURES_A_TASK = 1 << 18
#: Nodes that are compared with one pivot in one task, on average.
STAR = 256
#: Signatures that a task holds before it sends them on.
FLUSH = 1 << 19
U = np.uint64


class Similarity:
    """Jaccard similarity of percent / 100 at least, its bands and layouts."""

    def __init__(self, percent: int):
        self.percent = percent

    @functools.cache
    def bands(self) -> np.ndarray:
        """Smallest size of each band."""
        out = [1]
        while out[-1] < 1 << 40:
            out.append(out[-1] * 100 // self.percent + 1)
        return np.array(out)

    def differences(self, band: int) -> int:
        largest = int(self.bands()[band + 1]) - 1
        return 2 * largest * (100 - self.percent) // (100 + self.percent)

    @functools.cache
    def layout(self, band: int) -> tuple[int, int, int, np.ndarray, np.ndarray, list[tuple[int, ...]]] | None:
        """(partitions, cells of each, spare partitions, edges of the cells, salts, subsets of cells); None: only equal sets link.

        spare: so many partitions may have an empty subset without harm, since one more stays free of differences."""
        k = self.differences(band)
        if k == 0:
            return None
        n2, k2 = CELLS, SPARED
        least = k // (k2 + 1) + 1
        spare = 0 if least < 8 else 2 + least // 24
        n1 = least + spare
        subsets = list(itertools.combinations(range(n2), n2 - k2))
        edges = np.array([(i << 64) // (n1 * n2) for i in range(1, n1 * n2)], U)
        salts = mix(mix(np.arange(n1 * len(subsets), dtype=U) + U(1)) + U(band + 1))
        return n1, n2, spare, edges, salts.reshape(n1, -1), subsets

    def signatures(self, s: np.ndarray) -> np.ndarray:
        """Of a sorted set of hashes."""
        own = int(np.searchsorted(self.bands(), len(s), "right")) - 1
        sums = np.zeros(len(s) + 1, U)
        np.cumsum(mix(s + U(0x632BE59BD9B4E019)), out=sums[1:])
        out = []
        for band in (own, own + 1):
            if (found := self.layout(band)) is None:
                continue
            n1, n2, spare, edges, salts, subsets = found
            at = np.concatenate([[0], np.searchsorted(s, edges), [len(s)]])
            cells = (sums[at[1:]] - sums[at[:-1]]).reshape(n1, n2)
            sizes = np.diff(at).reshape(n1, n2)
            value = np.stack([cells[:, list(x)].sum(axis=1) for x in subsets], axis=1)
            full = np.stack([sizes[:, list(x)].sum(axis=1) for x in subsets], axis=1) > 0
            signed = mix(value + salts)
            out.append(signed[full] if (~full).any(axis=1).sum() <= spare else signed.ravel())
        return np.concatenate(out) if out else np.zeros(0, U)

    def may_link(self, apart: int, a: int, b: int) -> bool:
        """Whether sets of these sizes may differ in so many elements."""
        return apart * (100 + self.percent) <= (a + b) * (100 - self.percent)

    def links(self, shared: int, a: int, b: int) -> bool:
        return 100 * shared >= self.percent * (a + b - shared)


@functools.cache
def similarity(percent: int) -> Similarity:
    return Similarity(percent)


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text's distinct n-word shingles; with fewer words the whole sequence is one."""
    out: list[np.ndarray] = []
    for a, b in chunks([len(t) for t in texts]):
        w = Words(texts[a:b])
        counts = np.diff(w.first)
        grams = gram_hashes(w.hash, n)
        keep = w.doc[: len(grams)] == w.doc[n - 1 :] if len(grams) else np.zeros(0, bool)
        grams, doc = grams[keep], w.doc[: len(keep)][keep]
        order = np.lexsort((grams, doc))
        grams, doc = grams[order], doc[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
        grams, doc = grams[new], doc[new]
        edges = np.searchsorted(doc, np.arange(b - a + 1))
        for i in range(b - a):
            if 0 < counts[i] < n:
                m = int(counts[i])
                out.append(mix(gram_hashes(w.hash[w.first[i] : w.first[i] + m], m) + U(m)))
            else:
                out.append(grams[edges[i] : edges[i + 1]])
    return out


def identity(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set, of different sums."""
    total = np.array([mix(s ^ U(0x2545F4914F6CDD1D)).sum(dtype=U), mix(s + U(0x9E3779B97F4A7C15)).sum(dtype=U)])
    mixed = mix(total + U(len(s)))
    both = mix(mixed * U(3) + mixed[::-1]).view(np.int64)
    return int(both[0]), int(both[1])


class Naming:
    """Names sets by 64 bits of their 128-bit identities; where two different ones have these in common (collided), by the other 64."""

    def __init__(self, bits: int = 64, collided: frozenset[int] = frozenset()):
        self.bits, self.collided = bits, collided

    def first(self, s: np.ndarray) -> tuple[int, int]:
        a, b = identity(s)
        return a >> (64 - self.bits), b

    def node(self, s: np.ndarray) -> int:
        a, b = self.first(s)
        return b if a in self.collided else a


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs that repeat with each signature they share, a spanning forest of those that share most, with how many they share."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    code, count = np.unique(at[: len(a)] * len(nodes) + at[len(a) :], return_counts=True)
    order = np.argsort(-count, kind="stable")
    code, count = code[order], count[order]
    root, kept = list(range(len(nodes))), []
    for k, (i, j) in enumerate(zip((code // max(1, len(nodes))).tolist(), (code % max(1, len(nodes))).tolist())):
        while root[i] != i:
            root[i] = i = root[root[i]]
        while root[j] != j:
            root[j] = j = root[root[j]]
        if i != j:
            root[j] = i
            kept.append(k)
    kept = np.array(kept, np.int64)
    return nodes[code[kept] // max(1, len(nodes))], nodes[code[kept] % max(1, len(nodes))], count[kept].astype(np.int64)


def _star(signature: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each signature with its smallest node, and a weighted forest that joins all nodes of each signature.

    A forest will do: where two nodes of one signature stay in different components, some pair on the path between
    them has its ends in different components, so both components are among those that such pairs touch, and these
    are looked at again."""
    order = np.lexsort((node, signature))
    signature, node = signature[order], node[order]
    first = np.ones(len(node), bool)
    first[1:] = signature[1:] != signature[:-1]
    pivot = node[np.maximum.accumulate(np.where(first, np.arange(len(node)), 0))]
    other = pivot != node
    return signature[first], node[first], *forest(pivot[other], node[other])


def fingerprint(s: np.ndarray) -> np.ndarray:
    """Four bits for each of half as many cells as the set has elements, or up to as many: the sum of its elements'
    hashes. Two cells add up to the one cell of half as many. Two cells a byte, two cells at least."""
    bits = max(1, int(len(s) - 1).bit_length() - 1)
    total = np.bincount((s >> U(64 - bits)).astype(np.int64), (mix(s) & U(15)).astype(float), 1 << bits).astype(np.int64)
    return ((total[::2] & 15) | (total[1::2] & 15) << 4).astype(np.uint8)


PACKED = "bucket int, kind int, a binary, b binary, c binary"


def _packed(rows: list[tuple[int, int, bytes, bytes, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["bucket", "kind", "a", "b", "c"])


def _by_node(signature: np.ndarray, at: np.ndarray, names: np.ndarray, wide: int, kind: str) -> Iterator[tuple[int, int, bytes, bytes, bytes]]:
    """A row for each bucket of signatures: names (any fixed-size values) of the nodes that have any there, how many
    each has, and these, as the upper bytes that kind holds. at: each signature's node."""
    shift = U(64 - 8 * np.dtype(kind).itemsize)
    order = np.argsort(at, kind="stable")
    for k, (own, place) in pack((signature[order] % U(wide)).astype(np.int64), (signature[order] >> shift).astype(kind), at[order]):
        place = np.frombuffer(place, np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        yield k, 0, names[place[first]].tobytes(), np.diff(np.append(first, len(place))).astype("<u4").tobytes(), own


def candidate_pairs(docs: DataFrame, percent: int, n: int, naming: Naming) -> DataFrame:
    """(a, b, weight) of nodes: a tree over the nodes of each signature. A task sends on one node of a signature, so no
    signature has more rows in one task than there are tasks before it. Signatures meet by their bucket and upper four
    bytes; an accidental meeting makes one more candidate."""
    wide = partitions(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sim, held, nodes, seen, total = similarity(percent), [], [], set(), 0

        def flush():
            names = np.array(nodes, np.int64)
            signature, at, a, b, weight = _star(np.concatenate(held), np.repeat(np.arange(len(names)), [len(x) for x in held]))
            rows = list(_by_node(signature, at, names, wide, "<u4"))
            rows += [(k, 1, *x) for k, x in pack(names[a] % wide, names[a], names[b], weight)]
            held.clear(), nodes.clear(), seen.clear()
            return _packed(rows)

        for batch in batches:
            for s in shingle_sets(as_bytes(batch.column(0)), n):
                if len(s) and (node := naming.node(s)) not in seen:
                    seen.add(node)
                    nodes.append(node)
                    held.append(sim.signatures(s))
                    total += len(held[-1])
                    if total > FLUSH:
                        yield flush()
                        total = 0
        if nodes:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: dict[int, list[tuple[bytes, bytes, bytes]]] = {0: [], 1: []}
        for batch in batches:
            for kind, *x in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
                sides[kind].append(x)
        column = lambda k, i, t: np.frombuffer(b"".join(x[i] for x in sides[k]), t)
        own = _star(column(0, 2, "<u4"), np.repeat(column(0, 0, np.int64), column(0, 1, "<u4")))[2:]
        a, b, weight = (np.concatenate([x, column(1, i, np.int64)]) for i, x in enumerate(own))
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(weight)], ["a", "b", "weight"])

    signed = docs.select("text").mapInArrow(sign, PACKED)
    found = signed.repartitionById(wide, F.col("bucket")).mapInArrow(meet, "a long, b long, weight long")
    return found.groupBy("a", "b").agg(F.sum("weight").alias("weight"))


MEMBER = "doc_id long, n_shingles long, node long, check long, print binary"


def members(docs: DataFrame, n: int, naming: Naming) -> DataFrame:
    """(doc_id, n_shingles, node, check: the other half of the identity, print: the fingerprint) of each row; an empty
    set has none of the last three."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(as_bytes(batch.column(1)), n)
            rows = [(len(s), naming.node(s), naming.first(s)[1], fingerprint(s).tobytes()) if len(s) else (0, None, None, None) for s in sets]
            made = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["doc_id", "n_shingles", "node", "check", "print"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, MEMBER)


def nodes_of(rows: DataFrame) -> DataFrame:
    """(node, least: its smallest doc_id, low, high: of its checks)."""
    numbers = [F.min("doc_id").alias("least"), F.min("check").alias("low"), F.max("check").alias("high")]
    return rows.where(F.col("node").isNotNull()).groupBy("node").agg(*numbers)


def prints_of(rows: DataFrame) -> DataFrame:
    """(node, size, print), apart from the nodes, which most joins need without it."""
    return rows.where(F.col("node").isNotNull()).groupBy("node").agg(F.max("n_shingles").alias("size"), F.first("print").alias("print"))


def _key(doc_id) -> F.Column:
    """Never null, so that a join on it can leave dealt texts where they lie."""
    return F.coalesce(doc_id, F.lit(0).cast("long")).alias("_key")


def keyed(docs: DataFrame) -> DataFrame:
    """(_key, text) of docs."""
    return docs.select(_key(F.col("doc_id").cast("long")), "text")


def texts_of(texts: DataFrame, wanted: DataFrame, *columns: str) -> DataFrame:
    """columns of wanted (node, least and others) with their texts (keyed), and some of other rows that have the same
    key. wanted is written first: a small table goes to where the texts lie, for its known size, and a large one is
    dealt as the texts are."""
    found = texts.join(cut(wanted.select(_key(F.col("least")), *columns)), "_key")
    return found.select(*columns, "text")


def near(pairs: DataFrame, prints: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and fingerprints don't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sim = similarity(percent)
        for batch in batches:
            a, b = (batch.column(c).to_numpy() for c in ("size_a", "size_b"))
            table = Prints([x.as_buffer() for c in ("print_a", "print_b") for x in batch.column(c)])
            apart = np.maximum(np.abs(a - b), table.apart(np.arange(len(a)), np.arange(len(a)) + len(a)))
            yield batch.select(["a", "b"]).filter(pa.array(sim.may_link(apart, a, b)))

    side = lambda end: prints.select(F.col("node").alias(end), F.col("size").alias(f"size_{end}"), F.col("print").alias(f"print_{end}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "size_a", "size_b", "print_a", "print_b").mapInArrow(run, "a long, b long")


def linked(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int, n: int, naming: Naming) -> DataFrame:
    """Those of the distinct pairs (a, b) whose whole sets link. docs: (doc_id, text), or their texts, keyed.

    The end with more pairs is the pivot; its text goes once to each group of about STAR of the others."""
    degree = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
    of = lambda end: degree.select(F.col("node").alias(end), F.col("degree").alias(f"of_{end}"))
    turned = F.when(F.col("of_a") >= F.col("of_b"), F.struct(F.col("a").alias("star"), F.col("b").alias("node"), F.col("of_a").alias("degree")))
    turned = turned.otherwise(F.struct(F.col("b").alias("star"), F.col("a").alias("node"), F.col("of_b").alias("degree")))
    stars = pairs.join(of("a"), "a").join(of("b"), "b").select(turned.alias("x")).select("x.*").withColumn("parts", F.ceil(F.col("degree") / STAR).cast("int"))
    leaves = stars.select("star", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "node", F.lit(False).alias("pivot"))
    pivots = stars.select("star", "parts").distinct().select("star", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("star").alias("node"), F.lit(True).alias("pivot"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sim, at, pivot = similarity(percent), None, None
        for batch in batches:
            texts, a, b = as_bytes(batch.column(4)), [], []
            for lo, hi in chunks([len(t) for t in texts]):
                part = batch.slice(lo, hi - lo)
                for star, k, node, is_pivot, s in zip(*(part.column(i).to_pylist() for i in range(4)), shingle_sets(texts[lo:hi], n)):
                    if not len(s) or naming.node(s) != node:
                        continue
                    if is_pivot:
                        at, pivot = (star, k), s
                    elif at == (star, k):
                        both = np.sort(np.concatenate([pivot, s]))
                        if sim.links(int(np.count_nonzero(both[1:] == both[:-1])), len(pivot), len(s)):
                            a.append(min(star, node))
                            b.append(max(star, node))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    wanted = leaves.unionByName(pivots).join(nodes.select("node", "least"), "node")
    texts = texts_of(docs if "_key" in docs.columns else keyed(docs), wanted, "star", "part", "node", "pivot")
    dealt = texts.repartition(partitions(docs.sparkSession), "star", "part").sortWithinPartitions("star", "part", F.desc("pivot"))
    return dealt.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component: its smallest node, was) of the nodes in edges (a, b), by smallest labels and pointer jumps, a
    written table each round."""
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).toDF("node", "other"))
    labels = cut(both.groupBy("node").agg(F.least("node", F.min("other")).alias("component")))
    while True:
        seen = both.join(labels.select(F.col("node").alias("other"), "component"), "other").groupBy("node").agg(F.min("component").alias("near"))
        least = labels.join(seen, "node").select("node", F.least("component", "near").alias("component"), F.col("component").alias("was"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("up"))
        after = cut(least.join(jump, "component", "left").select("node", F.least("component", F.coalesce("up", "component")).alias("component"), "was"))
        release(labels)
        labels = after
        if labels.where("component <> was").isEmpty():
            release(both)
            return labels


class Prints:
    """Fingerprints in one matrix for each width."""

    def __init__(self, packed: list[bytes]):
        width = np.array([len(x) * 2 for x in packed], np.int64)
        self.width, self.row, self.matrix = width, np.zeros(len(packed), np.int64), {}
        for w in np.unique(width).tolist():
            own = np.flatnonzero(width == w)
            flat = np.frombuffer(b"".join(packed[i] for i in own), np.uint8).reshape(len(own), -1)
            self.matrix[w] = np.stack([flat & 15, flat >> 4], axis=2).reshape(len(own), -1)
            self.row[own] = np.arange(len(own))

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Cells in which the prints of each pair differ: no more than the elements in which the sets differ."""
        out = np.zeros(len(a), np.int64)
        widths = np.stack([self.width[a], self.width[b]], axis=1)
        for u, v in np.unique(widths, axis=0).tolist():
            pairs = np.flatnonzero((widths[:, 0] == u) & (widths[:, 1] == v))
            step = max(1, (1 << 22) // max(u, v))
            for lo in range(0, len(pairs), step):
                own = pairs[lo : lo + step]
                p, q = self.matrix[u][self.row[a[own]]], self.matrix[v][self.row[b[own]]]
                while p.shape[1] > q.shape[1]:
                    p = (p[:, ::2] + p[:, 1::2]) & 15
                while q.shape[1] > p.shape[1]:
                    q = (q[:, ::2] + q[:, 1::2]) & 15
                out[own] = np.count_nonzero(p != q, axis=1)
        return out


NODE = np.dtype([("node", "<i8"), ("component", "<i8"), ("size", "<i8")])


MIXED = np.dtype([("node", "<i8"), ("component", "<i8")])


def mixed_signatures(texts: DataFrame, percent: int, n: int, naming: Naming) -> DataFrame:
    """Of texts (node, component, text): (node, signatures) with those signatures that nodes of several components have;
    signatures[k] holds those whose nodes have all been compared after round k."""
    wide = partitions(texts.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sim = similarity(percent)
        for batch in batches:
            texts = as_bytes(batch.column(2))
            for lo, hi in chunks([len(t) for t in texts]):
                sets, node = shingle_sets(texts[lo:hi], n), batch.column(0)[lo:hi].to_pylist()
                own = [i for i, s in enumerate(sets) if len(s) and naming.node(s) == node[i]]
                if own:
                    found, names = [sim.signatures(sets[i]) for i in own], np.zeros(len(own), MIXED)
                    names["node"], names["component"] = (batch.column(i).to_numpy()[lo:hi][own] for i in (0, 1))
                    yield _packed(list(_by_node(np.concatenate(found), np.repeat(np.arange(len(own)), [len(x) for x in found]), names, wide, "<u8")))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [x for batch in batches for x in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
        of, times, signature = (np.frombuffer(b"".join(x[i] for x in parts), t) for i, t in enumerate((MIXED, "<u4", U)))
        if not len(signature):
            return
        order = np.argsort(signature, kind="stable")
        signature, of = signature[order], np.repeat(of, times)[order]
        node, component = of["node"], of["component"]
        edges = np.concatenate([[0], np.flatnonzero(np.diff(signature)) + 1])
        mixed, sizes = np.minimum.reduceat(component, edges) != np.maximum.reduceat(component, edges), np.diff(np.append(edges, len(signature)))
        last = np.repeat(np.searchsorted([first + 2 for first, _ in ROUNDS[1:]], sizes, "right"), sizes)
        own = np.flatnonzero(np.repeat(mixed, sizes))
        own = own[np.lexsort((last[own], node[own]))]
        if len(own):
            at = np.concatenate([[0], np.flatnonzero(np.diff(node[own]) | np.diff(last[own])) + 1, [len(own)]])
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(signature[own].view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(node[own][at[:-1]]), pa.array(last[own][at[:-1]]), lists], ["node", "last", "signatures"])

    met = texts.mapInArrow(sign, PACKED).repartitionById(wide, F.col("bucket")).mapInArrow(meet, "node long, last long, signatures array<long>")
    of = [F.flatten(F.collect_list(F.when(F.col("last") == k, F.col("signatures")))) for k in range(len(ROUNDS))]
    return met.groupBy("node").agg(F.array(*of).alias("signatures"))


def unresolved_pairs(sets: DataFrame, percent: int, first: int, end: int, wide: int) -> DataFrame:
    """Of sets (node, component, size, print, signatures): distinct pairs (a, b) of different components that share a
    signature, a being of rank first to end among its nodes, and that sizes and fingerprints don't rule out.

    Fingerprints travel with the signatures, once for each of wide tasks that has any of a node, and rule pairs out
    where signatures meet: large groups of nodes that are alike but don't link give no rows."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(3).to_pylist()
            node = np.zeros(len(prints), NODE)
            node["node"], node["component"], node["size"] = (batch.column(i) for i in range(3))
            rows = []
            if len(prints):
                lists = batch.column(4)
                signature = lists.flatten().to_numpy().view(U)
                for k, (x, own) in pack((signature % U(wide)).astype(np.int64), signature, np.repeat(np.arange(len(prints)), lists.value_lengths().to_numpy())):
                    used, place = np.unique(np.frombuffer(own, np.int64), return_inverse=True)
                    rows.append((k, x, place.astype("<u4").tobytes(), node[used].tobytes(), [prints[i] for i in used]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.binary())))], ["bucket", "signatures", "places", "nodes", "prints"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sim = similarity(percent)
        signatures, places, nodes, prints, base = [], [], [], [], 0
        for batch in batches:
            for x, place, node, p in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
                signatures.append(np.frombuffer(x, U))
                places.append(np.frombuffer(place, "<u4").astype(np.int64) + base)
                nodes.append(np.frombuffer(node, NODE))
                prints += p
                base += len(p)
        if not nodes:
            return
        signature, node = np.concatenate(signatures), np.concatenate(nodes)
        _, index, inverse = np.unique(node["node"], return_index=True, return_inverse=True)
        node, at = node[index], inverse[np.concatenate(places)]
        table = Prints([prints[i] for i in index])
        order = np.lexsort((at, signature))
        signature, at = signature[order], at[order]
        component = node["component"][at]
        edges = np.concatenate([[0], np.flatnonzero(np.diff(signature)) + 1, [len(signature)]])
        size = node["size"]

        def tested(codes: list[np.ndarray]) -> np.ndarray:
            code = np.unique(np.concatenate(codes))
            a, b = code // len(node), code % len(node)
            may = lambda apart: apart * (100 + sim.percent) <= (size[a] + size[b]) * (100 - sim.percent)
            keep = may(np.abs(size[a] - size[b]))
            a, b = a[keep], b[keep]
            return code[keep][may(table.apart(a, b))]

        waiting, total, out = [], 0, []
        mixed = np.flatnonzero(np.minimum.reduceat(component, edges[:-1]) != np.maximum.reduceat(component, edges[:-1]))
        for lo, hi in zip(edges[mixed].tolist(), edges[mixed + 1].tolist()):
            for i in range(lo + first, min(lo + end, hi)):
                other = at[i + 1 : hi][component[i + 1 : hi] != component[i]]
                waiting.append(at[i] * len(node) + other)
                total += len(other)
                if total > 1 << 18:
                    out.append(tested(waiting))
                    waiting, total = [], 0
        if waiting:
            out.append(tested(waiting))
        if out:
            code = np.unique(np.concatenate(out))
            for lo in range(0, len(code), 1 << 15):
                part = code[lo : lo + (1 << 15)]
                yield pa.RecordBatch.from_arrays([pa.array(node["node"][part // len(node)]), pa.array(node["node"][part % len(node)])], ["a", "b"])

    packed = sets.select("node", "component", "size", "print", "signatures").mapInArrow(sign, "bucket int, signatures binary, places binary, nodes binary, prints array<binary>")
    return packed.repartitionById(wide, F.col("bucket")).mapInArrow(meet, "a long, b long").distinct()


def join(docs: DataFrame, percent: int = 85, n: int = 4, identity_bits: int = 64) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of docs (doc_id, text).

    Null or empty text, or one without words: an empty set, linked with nothing; component_id is the own doc_id.
    Repeated rows and equal texts share a component. A null doc_id never is a component_id where the component has
    others. Other columns are not read. An empty table gives an empty table. Texts of any length are taken whole, one at
    a time. docs is read once a step: write it first where it is dear to make.
    """
    naming = Naming(identity_bits)
    rows = cut(members(docs, n, naming))
    nodes = cut(nodes_of(rows))
    # Different sets with one name: about n * n / 2^65 of n sets.
    collided = frozenset(r[0] for r in nodes.where("low <> high").select("node").collect())
    if collided:
        release(rows, nodes)
        naming = Naming(identity_bits, collided)
        rows = cut(members(docs, n, naming))
        nodes = cut(nodes_of(rows))
    prints = cut(prints_of(rows))
    pairs = cut(candidate_pairs(docs, percent, n, naming))
    # Texts meet the nodes that are wanted once a step: they are dealt once for all these joins.
    texts = dealt(keyed(docs), "_key")
    edges = cut(linked(cut(near(heaviest(pairs), prints, percent)), nodes, texts, percent, n, naming))
    labels = components(edges)
    # Joined with the fingerprints once, so that a round needs the labels only.
    mixed = cut(mixed_signatures(texts_of(texts, apart(pairs, nodes, labels), "node", "component"), percent, n, naming).join(prints, "node"))
    release(pairs, prints)
    for k, (first, end) in enumerate(ROUNDS):
        # Signatures whose nodes an earlier round has all compared don't travel again.
        open_ = mixed.withColumn("signatures", F.flatten(F.slice("signatures", k + 1, len(ROUNDS)))).where(F.size("signatures") > 0)
        total = open_.agg(F.sum(F.size("signatures"))).first()[0] or 0
        if not total:
            break
        wide = min(partitions(docs.sparkSession), 1 + total // SIGNATURES_A_TASK)
        more = cut(unresolved_pairs(placed(open_, labels), percent, first, end, wide))
        if more.isEmpty():
            continue
        found = cut(linked(more, nodes, texts, percent, n, naming))
        release(more)
        if not found.isEmpty():
            edges = edges.unionByName(found)
            release(labels)
            labels = components(edges)
    release(mixed, texts)
    named = placed(nodes, labels)
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("node", "component_id")
    full = rows.where(F.col("node").isNotNull()).join(named, "node").select("doc_id", "n_shingles", "component_id")
    return full.union(rows.where(F.col("node").isNull()).select("doc_id", "n_shingles", "doc_id"))


def heaviest(pairs: DataFrame) -> DataFrame:
    """Each node's pair (a, b) that shares most signatures: it mostly links, and few pairs are left between components."""
    ends = [F.struct(F.col(x).alias("node"), F.col(y).alias("other"), "weight") for x, y in ("ab", "ba")]
    best = pairs.select(F.explode(F.array(*ends)).alias("x")).select("x.*").groupBy("node").agg(F.max_by("other", F.struct("weight", "other")).alias("other"))
    return best.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def placed(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """nodes with component, their own where no label names one."""
    return nodes.join(labels.select("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))


def apart(pairs: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """nodes, with component, of the components between which there are pairs."""
    at = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    named = pairs.join(at("a"), "a", "left").join(at("b"), "b", "left").select(F.coalesce("of_a", "a").alias("of_a"), F.coalesce("of_b", "b").alias("of_b"))
    open_ = named.where("of_a <> of_b").select(F.explode(F.array("of_a", "of_b")).alias("component")).distinct()
    return placed(nodes, labels).join(open_, "component", "left_semi")


def keep_one(docs: DataFrame, percent: int = 80, n: int = 5) -> DataFrame:
    """docs without the near copies: of each component the row with the smallest doc_id stays, all others go.

    Rows without words (null or empty text) or without doc_id stay, and so do repeated rows of the doc_id that stays.
    Other columns may have any names. An empty table gives an empty table."""
    joined = join(docs, percent, n)
    gone = cut(joined.where((F.col("component_id") != F.col("doc_id")) & (F.col("n_shingles") > 0)).select(F.col("doc_id").alias("_gone")).distinct())
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_ngram_join(spark, sf_dir):
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
