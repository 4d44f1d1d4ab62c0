"""Ranked lexical search by sort-based accumulation.

The items' terms are the inverted side: they come in blocks of at most BLOCK_TERMS pairs of item and term, so that what
goes to all tasks is bounded, and every block of items meets all documents. A task takes the terms of some documents that
items have, and concatenates for each the items and the term's impact in the document. Packed keys of item and document
are put in order by radix passes, impacts of equal keys are summed by reduceat, and a heap for each item keeps the best.
Tasks send their heaps' contents, which are merged in ranges of task and item first, then by item.

Two passes over the texts are needed, as impacts depend on counts over all documents.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from sievemill.llm.common import as_bytes, chunks, cut, documents, release

#: Results an item gets.
TOP = 10
#: Pairs of item and term in a block of items, some 40 MB in a task; one item's terms stay together.
BLOCK_TERMS = 1 << 18
#: Places of the hash that deals items to blocks.
PLACES = 1 << 30
#: Ranges of tasks whose results are merged first.
RANGES = 64
#: Fixed values of the score.
UNIT, DAMPED, SHARE = 1_000_000_000, 8, 90

#: Bytes of a text as they count in terms: letters A-Z are lower-cased, other ASCII but digits and letters parts terms.
_AS_TERM = bytes(c if c >= 128 or chr(c).isalnum() and not chr(c).isupper() else c + 32 if chr(c).isupper() else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8, in order."""
    return text.translate(_AS_TERM).split()


def term_pairs(items: DataFrame, identity: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term binary): each item's terms once. Rows with the same id, or without one, are one item."""
    kind_of = dict(items.dtypes)[identity]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(t))) for t in as_bytes(batch.column(1))]
            rows = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array([t for x in found for t in x], pa.binary())], ["item", "term"])

    return items.select(identity, text).mapInArrow(run, f"item {kind_of}, term binary").distinct()


def blocks(pairs: DataFrame, most: int = BLOCK_TERMS) -> Iterator[list[tuple[object, list[bytes]]]]:
    """The items with their terms, in blocks of at most most pairs: ranges of a hash of the item, split until they fit.

    Only an item with more terms of its own is a larger block, alone but for items of the same hash."""
    placed = cut(pairs.withColumn("place", F.pmod(F.xxhash64("item"), F.lit(PLACES))).sort("place"))
    inside = lambda low, high: placed.where((F.col("place") >= low) & (F.col("place") < high))

    def split(low: int, high: int) -> Iterator[tuple[int, int]]:
        step = max(1, (high - low) // 1024)
        sizes = dict(inside(low, high).groupBy(F.floor((F.col("place") - low) / step).alias("k")).count().collect())
        start, held = low, 0
        for k in sorted(sizes):
            a, b = low + k * step, min(high, low + (k + 1) * step)
            if held and held + sizes[k] > most:
                yield start, a
                start, held = a, 0
            if sizes[k] > most and step > 1:
                yield from split(a, b)
                start = b
            else:
                held += sizes[k]
        if held:
            yield start, high

    for low, high in split(0, PLACES):
        rows = inside(low, high).groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms")).collect()
        yield [(r.item, [bytes(t) for t in r.terms]) for r in rows]
    release(placed)


def counted(docs: DataFrame, vocabulary: list[bytes]) -> tuple[int, int, dict[bytes, int]]:
    """(documents with a term, terms of all documents, documents that hold each term of the vocabulary), in one pass.

    Tasks send a count for each term of the vocabulary that they saw, and their totals under no term."""
    known = frozenset(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding: Counter[bytes] = Counter()
        held = total = 0
        for batch in batches:
            for text in as_bytes(batch.column(1)):
                found = terms(text)
                held, total = held + bool(found), total + len(found)
                holding.update(known.intersection(found))
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *holding], pa.binary()), pa.array([held, *holding.values()], pa.int64()), pa.array([total, *[0] * len(holding)], pa.int64())],
            ["term", "n", "total"],
        )

    rows = docs.mapInArrow(run, "term binary, n long, total long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    found = {None if r.term is None else bytes(r.term): (r.n, r.total) for r in rows}
    held, total = found.pop(None, (0, 0))
    return held, total, {t: n for t, (n, _) in found.items()}


def radix_order(keys: np.ndarray) -> np.ndarray:
    """Stable order of non-negative keys, by passes over 16 bits each; numpy sorts these by radix."""
    order = np.argsort((keys & 0xFFFF).astype(np.uint16), kind="stable")
    top, shift = int(keys.max(initial=0)), 16
    while top >> shift:
        digit = ((keys[order] >> shift) & 0xFFFF).astype(np.uint16)
        order = order[np.argsort(digit, kind="stable")]
        shift += 16
    return order


class Accumulator:
    """Best documents of a block of items, over the documents of a task.

    weights: of each term that a document holds. mean: terms of all documents, and of how many."""

    def __init__(self, items: list[list[bytes]], weights: dict[bytes, int], held: int, total: int, top: int = TOP):
        self.held, self.total, self.top = held, total, top
        holders: dict[bytes, list[int]] = {}
        for number, own in enumerate(items):
            for t in own:
                if t in weights:
                    holders.setdefault(t, []).append(number)
        self.number = {t: k for k, t in enumerate(holders)}
        self.weight = np.array([weights[t] for t in holders], np.int64)
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in holders.values()], dtype=np.int64)])
        self.holder = np.array([i for x in holders.values() for i in x], np.int64)
        self.heaps: list[list[tuple[int, tuple, int | None]]] = [[] for _ in items]
        self.floor = np.ones(len(items), np.int64)  # the least score that can still enter

    def add(self, ids: list[int | None], texts: list[bytes]) -> None:
        known = self.number.keys()
        doc, term, times, size = [], [], [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            found = terms(text)
            size[k] = len(found)
            counts = Counter(found)
            own = known & counts.keys()
            doc += [k] * len(own)
            term += map(self.number.__getitem__, own)
            times += map(counts.__getitem__, own)
        if not doc:
            return
        doc, term, times = (np.array(x, np.int64) for x in (doc, term, times))
        damp = 100 - SHARE + SHARE * size * self.held // self.total
        impact = self.weight[term] * (UNIT * times // (1000 * times + DAMPED * damp[doc]))
        # Each match once for each item that has its term.
        n = np.diff(self.first)[term]
        match = np.repeat(np.arange(len(term)), n)
        item = self.holder[np.arange(len(match)) - np.repeat(np.cumsum(n) - n, n) + self.first[term][match]]
        key = item * len(texts) + doc[match]
        order = radix_order(key)
        key = key[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        score = np.add.reduceat(impact[match][order], starts)
        item, doc = np.divmod(key[starts], len(texts))
        near = np.flatnonzero(score >= self.floor[item])
        for i, k, s in zip(item[near].tolist(), doc[near].tolist(), score[near].tolist()):
            self.push(i, s, ids[k])

    def push(self, item: int, score: int, doc_id: int | None) -> None:
        """Larger scores are better, then smaller ids; rows without an id come last."""
        heap, entry = self.heaps[item], (score, (doc_id is not None, -(doc_id or 0)), doc_id)
        if len(heap) < self.top:
            heapq.heappush(heap, entry)
        elif entry[:2] > heap[0][:2]:
            heapq.heapreplace(heap, entry)
        if len(heap) == self.top:
            self.floor[item] = heap[0][0]


def weight(held: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * held + 2) / (2 * holding + 1)))


def best(found: DataFrame, by: list[str], top: int) -> DataFrame:
    """The first top rows of each group, ranked."""
    window = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, most: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank from 1, doc_id long, score long): each item's best documents with a score above 0.

    docs: (doc_id, text); items: (item_id, text), in blocks of most pairs of item and term, for each of which the texts are
    read twice. Null and empty texts have no terms, so documents without any are never found and items without any find
    nothing. Each row of docs is a document by itself, repeated rows and rows without an id too; equal scores come by
    doc_id, rows without one last. Rows of items with the same id are one item. Other columns aren't read, whatever their
    names. Empty tables give an empty table. A task holds 1 MB of texts at once, or one longer text, and the block."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    kind = items.schema["item_id"].dataType
    parts = []
    for block in blocks(term_pairs(items), most):
        names, own = [i for i, _ in block], [t for _, t in block]
        held, total, holding = counted(docs, sorted({t for x in own for t in x}))
        if not held:
            continue
        weights = {t: weight(held, n) for t, n in holding.items()}
        parts.append(_scored(docs, names, kind, own, weights, held, total, top))
    if not parts:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionAll(p)
    merged = best(found.withColumn("range", F.pmod(F.spark_partition_id(), F.lit(RANGES))), ["item_id", "range"], top)
    return best(merged.drop("rank", "range"), ["item_id"], top).select("item_id", "rank", "doc_id", "score")


def _scored(
    docs: DataFrame, names: list, kind: DataType, own: list[list[bytes]], weights: dict[bytes, int], held: int, total: int, top: int
) -> DataFrame:
    """(item_id, doc_id, score): the best of each task for each item of a block."""
    item_type = to_arrow_type(kind)
    sent = docs.sparkSession.sparkContext.broadcast((names, own, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, own, weights = sent.value
        accumulator = Accumulator(own, weights, held, total, top)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), as_bytes(batch.column(1))
            for a, b in chunks([len(t) for t in texts]):
                accumulator.add(ids[a:b], texts[a:b])
        rows = [(names[k], doc_id, score) for k, heap in enumerate(accumulator.heaps) for score, _, doc_id in heap]
        columns = list(zip(*rows)) if rows else [[]] * 3
        kinds = (item_type, pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["item_id", "doc_id", "score"])

    return docs.mapInArrow(run, f"item_id {kind.simpleString()}, doc_id long, score long")


def op13_lexical_search(spark, sf_dir):
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: The same by joins of terms.
OP13_SQL = r"""
with words as (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) term from documents),
tf as (select doc_id, term, count(*) tf from words group by all),
size as (select doc_id, sum(tf)::bigint n from tf group by doc_id),
every as (select count(*) held, sum(n)::bigint total from size),
wanted as (select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) term from benchmark),
weighed as (select term, floor(1000 * ln((2 * any_value(held) + 2) / (2 * count(*) + 1)))::bigint w from tf, every group by term),
damped as (select doc_id, 10 + (90 * n * held) // total m from size, every),
scored as (select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint score
    from wanted join weighed using (term) join tf using (term) join damped using (doc_id) group by item_id, doc_id)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int rank, doc_id, score
from scored where score > 0 qualify rank <= 10"""
