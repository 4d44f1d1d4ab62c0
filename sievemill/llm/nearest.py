"""Approximate nearest neighbours by cross-polytope hashing.

Each table applies a fast pseudo-rotation (sign flips and a Hadamard transform, three times) to the unit vectors and
assigns each to the nearest signed axis. A query probes the axes nearest to it in every table; all vectors found there
are reranked by the exact measure. For the largest inner product, vectors are grouped by their norms' powers of two, and
each query looks in all groups. Where a group's norms differ, its vectors get one more coordinate, sqrt(M^2 - |x|^2) with
M the group's largest norm, and queries a zero there, which makes the order of inner products that of angles.

A group that fits a bucket is one. For a larger one, the neighbours of a sample of queries, found among all vectors, show
which share of them the tables find; where that is under LEAST_RECALL, the group is searched whole.

Equal vectors are one class, searched once and expanded at the end by their smallest ids, so copies never meet in a
bucket. A bucket of more than SPLIT classes is split; its queries go to each part. No bucket has a cap.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievemill.llm.common import cut, mix, partitions

#: Up to this many classes a table uses one axis as its bucket; beyond it, two, with more tables.
ONE_AXIS = 1_000_000
#: axes per bucket: (tables, axes probed per rotation, of each 128 signed ones). To search all vectors costs no more than
#: wider plans would.
PLANS = {1: (32, 4), 2: (64, 12)}
SPLIT = 1024
#: Queries of each vector length whose neighbours are sought among all vectors, and the share of these that tables must find.
SAMPLE, LEAST_RECALL = 64, 0.95
#: Powers of two of norms, below the largest, that are groups of their own; all smaller norms join the last.
BANDS = 8
SEED = 20


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotations(x: np.ndarray, number: int) -> np.ndarray:
    """Pseudo-rotation by number of each row, padded to a power of two."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    y = np.zeros((len(x), width))
    y[:, : x.shape[1]] = x
    signs = np.random.default_rng((SEED, number, width)).choice([-1.0, 1.0], (3, width))
    for s in signs:
        y = hadamard(y * s)
    return y


def axes(y: np.ndarray, probes: int) -> np.ndarray:
    """The signed axes nearest to each row, nearest first: 2 * axis, plus 1 where negative."""
    signed = np.stack([y, -y], axis=2).reshape(len(y), -1)
    if probes == 1:
        return signed.argmax(axis=1)[:, None]
    probes = min(probes, signed.shape[1])
    near = np.argpartition(-signed, probes - 1, axis=1)[:, :probes]
    return np.take_along_axis(near, np.argsort(-np.take_along_axis(signed, near, 1), axis=1), 1)


def buckets(unit: np.ndarray, per_bucket: int, tables: int, probes: int) -> np.ndarray:
    """(rows, tables, probes ** per_bucket) bucket numbers; a bucket's number holds its table."""
    out = []
    for t in range(tables):
        total = np.full((len(unit), 1), t, np.int64)
        for k in range(per_bucket):
            near = axes(rotations(unit, t * per_bucket + k), probes)
            total = (total[:, :, None] * (1 << 16) + near[:, None, :]).reshape(len(unit), -1)
        out.append(total)
    return np.stack(out, axis=1)


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).astype(np.float64)


class Group(NamedTuple):
    """Vectors of one length and power of two of the norm; all of them lie in one bucket where tables is 0."""

    number: int
    size: int
    band: float
    n: int
    most: float
    even: bool
    per_bucket: int = 1
    tables: int = 0
    probes: int = 0

    def vectors(self, x: np.ndarray) -> np.ndarray:
        if self.even:
            return x / np.linalg.norm(x, axis=1, keepdims=True)
        return np.hstack([x, np.sqrt(np.maximum(0, self.most**2 - (x * x).sum(1)))[:, None]]) / self.most

    def queries(self, x: np.ndarray) -> np.ndarray:
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        return x if self.even else np.hstack([x, np.zeros((len(x), 1))])

    def buckets(self, unit: np.ndarray, probes: int) -> np.ndarray:
        """(rows, buckets) of vectors (with one probe) or queries; a bucket's number holds its group."""
        own = buckets(unit, self.per_bucket, self.tables, probes).reshape(len(unit), -1) if self.tables else np.zeros((len(unit), 1), np.int64)
        return own + (self.number << 40)

    def planned(self, per_bucket: int | None, tables: int | None = None, probes: int | None = None) -> Group:
        per_bucket = per_bucket or (1 if self.n <= ONE_AXIS else 2)
        signed = 2 << max(0, self.size - self.even).bit_length()
        return self._replace(per_bucket=per_bucket, tables=tables or PLANS[per_bucket][0], probes=min(signed, probes or max(PLANS[per_bucket][1], PLANS[per_bucket][1] * signed // 128)))

    def recall(self, queries: np.ndarray, near: np.ndarray) -> float:
        """Share of near, row by row a query's neighbours in this group, that its buckets hold."""
        if not len(near):
            return 1.0
        q, x, found = self.queries(queries), self.vectors(near), np.zeros(len(near), bool)
        for t in range(self.tables):
            hit = np.ones(len(near), bool)
            for k in range(self.per_bucket):
                number = t * self.per_bucket + k
                hit &= (axes(rotations(q, number), self.probes) == axes(rotations(x, number), 1)).any(axis=1)
            found |= hit
        return float(found.mean())


def _band(x: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.linalg.norm(x, axis=1)) + 0.5)


def _group_of(x: np.ndarray, groups: list[Group]) -> np.ndarray:
    """Index in groups (of one length, by band) of each row."""
    return np.maximum(0, np.searchsorted([g.band for g in groups], _band(x), "right") - 1)


def _by_length(batch: pa.RecordBatch, kind: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of one vector length at a time."""
    sizes = np.array([len(v) for v in batch.column("vec").to_pylist()])
    for n in np.unique(sizes):
        part = batch.filter(pa.array(sizes == n))
        yield part, _matrix(part.column("vec"), kind)


def classes(vectors: DataFrame, k: int, every: int) -> tuple[DataFrame, str]:
    """(vec, ids: the k + 1 smallest ids, class_id: the smallest, queried: whether an id is divisible by every).

    Vectors that are null, zero or hold null or non-finite components take no part, nor do null ids."""
    kind = "<f4" if "float" in dict(vectors.dtypes)["embedding"] else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, list[int]] = defaultdict(list)
        queried = set()
        for batch in batches:
            for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                if vec_id is None or not v.is_valid or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(kind)
                if np.isfinite(x).all() and x.any():
                    key = (x + 0.0).astype(kind).tobytes()  # -0.0 becomes 0.0
                    ids = found[key]
                    ids.append(vec_id)
                    if vec_id % every == 0:
                        queried.add(key)
                    if len(ids) > 8 * (k + 1):
                        ids[:] = sorted(ids)[: k + 1]
        keys = list(found)
        for a in range(0, len(keys), 4096):
            part = keys[a : a + 4096]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([sorted(found[x])[: k + 1] for x in part], pa.list_(pa.int64())), pa.array([x in queried for x in part])], ["vec", "ids", "queried"])

    local = vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(run, "vec binary, ids array<long>, queried boolean")
    merged = local.groupBy("vec").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids"), F.max("queried").alias("queried"))
    return merged.withColumn("class_id", F.col("ids")[0]), kind


def _groups(bands: list[tuple[int, float, int, float, float]]) -> dict[int, list[Group]]:
    """Groups of each vector length, by norm, from (size, band, n, least, most)."""
    out: dict[int, list[Group]] = {}
    number = 0
    for size in sorted({b[0] for b in bands}):
        own = sorted(tuple(b) for b in bands if b[0] == size)
        low = [b for b in own if b[1] <= own[-1][1] - BANDS]
        merged = [(size, low[-1][1], sum(b[2] for b in low), low[0][3], low[-1][4])] if low else []
        out[size] = []
        for _, band, n, least, most in merged + own[len(low) :]:
            out[size].append(Group(number, size, band, n, most, most - least < 1e-6 * most))
            number += 1
    return out


def _measured(found: DataFrame, kind: str, k: int, groups: dict[int, list[Group]]) -> dict[int, list[Group]]:
    """groups, those without tables whose tables find less than LEAST_RECALL of the sampled queries' neighbours there."""
    hashed = {size for size, own in groups.items() if any(g.tables for g in own)}
    if not hashed:
        return groups
    schema = "size long, query long, class_id long, score double, vec binary"

    def sample(batches):
        """Of each length, the queries of this task that come first by a hash."""
        kept: dict[int, list[tuple[int, int, bytes]]] = defaultdict(list)
        for batch in batches:
            for part, x in _by_length(batch, kind):
                if x.shape[1] in hashed:
                    ids = part.column("class_id").to_numpy()
                    hashes = mix(ids.astype(np.uint64))
                    own, vec = kept[x.shape[1]], part.column("vec")
                    own += [(int(hashes[i]), int(ids[i]), vec[int(i)].as_py()) for i in np.argsort(hashes)[:SAMPLE]]
                    own[:] = sorted(own)[:SAMPLE]
        rows = [(size, i, i, float(h), v) for size, own in kept.items() for h, i, v in own]
        yield from [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["size", "query", "class_id", "score", "vec"])] if rows else []

    asked: dict[int, list] = defaultdict(list)
    for r in found.where("queried").select("class_id", "vec").mapInArrow(sample, schema).collect():  # SAMPLE a task and length
        asked[r["size"]].append((r["score"], r["query"], bytes(r["vec"])))
    asked = {size: sorted(own)[:SAMPLE] for size, own in asked.items()}
    vectors = {size: np.frombuffer(b"".join(r[2] for r in own), kind).reshape(len(own), -1).astype(np.float64) for size, own in asked.items()}

    def nearest(batches):
        """The k best classes of this task for each sampled query."""
        best: dict[tuple[int, int], list[tuple[float, int, bytes]]] = defaultdict(list)
        for batch in batches:
            for part, x in _by_length(batch, kind):
                if x.shape[1] in vectors:
                    ids, vec, top = part.column("class_id").to_numpy(), part.column("vec"), min(k + 1, len(x))
                    scores = vectors[x.shape[1]] @ x.T
                    for (_, q, _), s, near in zip(asked[x.shape[1]], scores, np.argpartition(-scores, top - 1, axis=1)[:, :top]):
                        own = best[x.shape[1], q]
                        own += [(-float(s[i]), int(ids[i]), vec[int(i)].as_py()) for i in near if ids[i] != q]
                        own[:] = sorted(own)[:k]
        rows = [(size, q, i, -s, v) for (size, q), own in best.items() for s, i, v in own]
        yield from [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["size", "query", "class_id", "score", "vec"])] if rows else []

    ranked = found.select("class_id", "vec").mapInArrow(nearest, schema).withColumn("_n", F.row_number().over(Window.partitionBy("size", "query").orderBy(F.desc("score"), "class_id")))
    pairs: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
    for r in ranked.where(F.col("_n") <= k).collect():  # SAMPLE * k a length
        pairs[r["size"]].append((r["query"], bytes(r["vec"])))
    out = dict(groups)
    for size in hashed:
        # Where no query of this length was sampled, there is none.
        near = np.frombuffer(b"".join(v for _, v in pairs[size]), kind).reshape(-1, size).astype(np.float64)
        place = {r[1]: i for i, r in enumerate(asked.get(size, []))}
        of = np.array([place[q] for q, _ in pairs[size]], int)
        at = _group_of(near, groups[size])
        out[size] = [g._replace(tables=0, probes=0) if g.tables and g.recall(vectors[size][of[at == i]] if len(of) else near, near[at == i]) < LEAST_RECALL else g for i, g in enumerate(groups[size])]
    return out


def _first(q: np.ndarray, x: np.ndarray, ids: np.ndarray, most: int) -> Iterator[tuple[int, list[int], list[float]]]:
    """(place in q, ids and exact scores of the first most rows of x by score, then id) of each query.

    A matrix product finds who may be among them: its last bits depend on the shape, so all within a bound of its error of
    the last place stay, ties among them. These are scored one by one."""
    product = q @ x.T
    most = min(most, len(x))
    last = np.partition(product, len(x) - most, axis=1)[:, len(x) - most]
    error = 4 * x.shape[1] * np.finfo(float).eps * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()
    row, col = np.nonzero(product >= (last - error)[:, None])
    exact = np.concatenate([(q[row[a : a + 65536]] * x[col[a : a + 65536]]).sum(axis=1) for a in range(0, len(row), 65536)])
    order = np.lexsort((ids[col], -exact, row))
    col, exact, first = col[order], exact[order], np.searchsorted(row, np.arange(len(q)))
    for i, a in enumerate(first.tolist()):
        b = min(a + most, int(first[i + 1]) if i + 1 < len(first) else len(row))
        yield i, ids[col[a:b]].tolist(), exact[a:b].tolist()


def _look(found: DataFrame, kind: str, k: int, groups: dict[int, list[Group]]) -> DataFrame:
    """(query_class, class_id, score) of each queried class' best classes, k + 1 a task, in the buckets of groups."""

    def counted(batches):
        for batch in batches:
            for _, x in _by_length(batch, kind):
                own = groups[x.shape[1]]
                at = _group_of(x, own)
                for i in np.unique(at):
                    b, c = np.unique(own[i].buckets(own[i].vectors(x[at == i]), 1), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(b), pa.array(c)], ["bucket", "n"])

    # One entry for each bucket that is split: at most tables * n / SPLIT.
    split = {r[0]: -(-r[1] // SPLIT) for r in found.select("vec").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") > SPLIT).collect()}

    def deal(batches):
        """Each class to its bucket in every table, each queried class to all buckets that it probes."""
        for batch in batches:
            for part, x in _by_length(batch, kind):
                ids, vec, own = part.column("class_id").to_numpy(), part.column("vec"), groups[x.shape[1]]
                queried = np.flatnonzero(part.column("queried").to_numpy(zero_copy_only=False))
                at = _group_of(x, own)
                dealt = [(False, np.flatnonzero(at == i), g) for i, g in enumerate(own)] + [(True, queried, g) for g in own]
                for query, rows, g in dealt:
                    if not len(rows):
                        continue
                    b = g.buckets(g.queries(x[rows]), g.probes) if query else g.buckets(g.vectors(x[rows]), 1)
                    row, bucket = np.repeat(rows, b.shape[1]), b.ravel()
                    parts = np.array([split.get(v, 1) for v in bucket.tolist()])
                    if query:
                        row, bucket = np.repeat(row, parts), np.repeat(bucket, parts)
                        salt = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                    else:
                        salt = ids[row] % parts
                    for a in range(0, len(row), 8192):
                        s = slice(a, a + 8192)
                        yield pa.RecordBatch.from_arrays([pa.array(bucket[s]), pa.array(salt[s].astype(np.int64)), pa.array(np.full(len(row[s]), query)), pa.array(ids[row[s]]), vec.take(pa.array(row[s]))], ["bucket", "salt", "query", "class_id", "vec"])

    def rerank(batches):
        """Of each query, the k + 1 best classes among the buckets of this task."""
        whole = [b for b in batches if len(b)]
        if not whole:
            return
        table = pa.Table.from_batches(whole)
        bucket, salt, query, ids = (table.column(c).to_numpy() for c in ("bucket", "salt", "query", "class_id"))
        vec = table.column("vec").to_pylist()
        size = np.array([len(v) for v in vec])
        order = np.lexsort((query, size, salt, bucket))
        same = (np.diff(bucket[order]) == 0) & (np.diff(salt[order]) == 0) & (np.diff(size[order]) == 0)
        edges = np.concatenate([[0], np.flatnonzero(~same) + 1, [len(order)]])
        best: dict[int, dict[int, float]] = defaultdict(dict)
        for a, b in zip(edges[:-1], edges[1:]):
            rows = order[a:b]
            asks, has = rows[query[rows]], rows[~query[rows]]
            if not len(asks) or not len(has):
                continue
            q, x = (np.frombuffer(b"".join(vec[i] for i in r), kind).reshape(len(r), -1).astype(np.float64) for r in (asks, has))
            for lo in range(0, len(asks), 256):
                for at, near, scores in _first(q[lo : lo + 256], x, ids[has], k + 1):
                    own = best[int(ids[asks[lo + at]])]
                    own.update(zip(near, scores))
                    if len(own) > 8 * (k + 1):
                        kept = sorted(own.items(), key=lambda p: (-p[1], p[0]))[: k + 1]
                        own.clear()
                        own.update(kept)
        rows = [(q, j, s) for q, own in best.items() for j, s in sorted(own.items(), key=lambda p: (-p[1], p[0]))[: k + 1]]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.float64()))], ["query_class", "class_id", "score"])

    dealt = found.select("vec", "class_id", "queried").mapInArrow(deal, "bucket long, salt long, query boolean, class_id long, vec binary").repartition(partitions(found.sparkSession), "bucket", "salt")
    return dealt.mapInArrow(rerank, "query_class long, class_id long, score double")


def search(vectors: DataFrame, k: int = 20, every: int = 20, per_bucket: int | None = None, tables: int | None = None, probes: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose vec_id is divisible by every, by the
    largest inner product in double precision; ties go to the smaller vec_id. Repeated rows with one id count once
    where their vectors are equal. An empty table gives an empty table. Only vectors of equal length are compared."""
    spark = vectors.sparkSession
    found, kind = classes(vectors, k, every)
    found = cut(found)

    def norms(batches):
        for batch in batches:
            for _, x in _by_length(batch, kind):
                n, band = np.linalg.norm(x, axis=1), _band(x)
                rows = [(x.shape[1], b, int((band == b).sum()), n[band == b].min(), n[band == b].max()) for b in np.unique(band)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["size", "band", "n", "least", "most"])

    bands = found.select("vec").mapInArrow(norms, "size long, band double, n long, least double, most double").groupBy("size", "band").agg(F.sum("n"), F.min("least"), F.max("most"))
    groups = _groups(bands.collect())  # a row a length and power of two
    if tables or probes:
        groups = {size: [g.planned(per_bucket, tables, probes) for g in own] for size, own in groups.items()}
    else:
        groups = _measured(found, kind, k, {size: [g.planned(per_bucket) if g.n > SPLIT else g for g in own] for size, own in groups.items()})

    # A query's own class, whose copies are its neighbours, may lie in none of the buckets that it probes.
    def itself(batches):
        for batch in batches:
            for part, x in _by_length(batch, kind):
                yield pa.RecordBatch.from_arrays([part.column("class_id"), part.column("class_id"), pa.array((x * x).sum(axis=1))], ["query_class", "class_id", "score"])

    own = found.where("queried").select("class_id", "vec").mapInArrow(itself, "query_class long, class_id long, score double")

    def best(scored):
        scored = scored.groupBy("query_class", "class_id").agg(F.max("score").alias("score"))
        return scored.withColumn("_n", F.row_number().over(Window.partitionBy("query_class").orderBy(F.desc("score"), "class_id"))).where(F.col("_n") <= k + 1).drop("_n")

    top = best(_look(found, kind, k, groups).union(own))
    if any(g.tables for of in groups.values() for g in of):
        # Queries whose buckets hold fewer vectors than are asked for, or than there are, look at all vectors of their length.
        top = cut(top)
        room = {r[0]: r[1] for r in found.groupBy(F.length("vec")).agg(F.sum(F.size("ids"))).where(F.col("sum(size(ids))") <= k).collect()}
        enough = F.coalesce(*[F.when(F.length("vec") == size, F.lit(n)) for size, n in room.items()], F.lit(k + 1))
        held = top.join(found.select("class_id", F.size("ids").alias("n")), "class_id").groupBy(F.col("query_class").alias("class_id")).agg(F.sum("n").alias("n"))
        short = cut(found.where("queried").select("class_id", enough.alias("enough")).join(held, "class_id").where("n < enough").select("class_id", F.lit(True).alias("short")))
        if not short.isEmpty():
            asking = found.drop("queried").join(short, "class_id", "left").select("vec", "ids", F.coalesce("short", F.lit(False)).alias("queried"), "class_id")
            whole = {size: [g._replace(tables=0, probes=0) for g in of] for size, of in groups.items()}
            top = best(top.union(_look(asking, kind, k, whole)))
    members = top.join(found.select("class_id", "ids"), "class_id").select("query_class", "score", F.explode("ids").alias("vec_id"))
    near = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id")))
    lists = members.withColumn("_n", F.row_number().over(Window.partitionBy("query_class").orderBy(F.desc("score"), "vec_id"))).where(F.col("_n") <= k + 1).groupBy("query_class").agg(near.alias("near"))
    queries = vectors.where(F.col("vec_id") % every == 0).select(F.col("vec_id").cast("long").alias("query_id"), "embedding")

    def keyed(batches):
        for batch in batches:
            rows = [(i, (v.values.to_numpy(zero_copy_only=False).astype(kind) + 0.0).astype(kind).tobytes()) for i, v in zip(batch.column(0).to_pylist(), batch.column(1)) if v.is_valid and not v.values.null_count]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["query_id", "vec"])

    asked = queries.mapInArrow(keyed, "query_id long, vec binary").distinct().join(found.where("queried").select("vec", F.col("class_id").alias("query_class")), "vec").select("query_id", "query_class")
    out = asked.join(lists, "query_class").select("query_id", F.posexplode(F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.vec_id").alias("vec_id"), (-F.col("col.minus")).alias("score"))


def op3_nearest(spark, sf_dir):
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
