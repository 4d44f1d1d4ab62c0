"""Suffix-array dedup: every byte covered by a LENGTH-byte string that also starts earlier is removed.

The suffix array is sparse and spread over tasks. Each LENGTH-byte string has one anchor, the position of the least
hash among its SEED-byte substrings: equal strings have equal anchors at equal offsets, so suffixes are compared only
where their anchors agree, and an anchor that occurs once in the corpus leaves the search. Around each repeated
anchor lies a context: all strings that have it as theirs. Contexts, and then the suffixes of contexts that differ,
are told apart in the two steps of deep-shallow sorting, for all groups at once. To a shallow depth they are sorted by
8-byte words, in place of a multikey quicksort's bytes; then groups that still agree branch as blind tries do, at the
first byte in which a member differs from the group's first one, and every byte counts. Removal asks which suffixes are
equal and which comes first in the corpus, so no order of the suffixes within a group is kept.

Tasks sort what they hold before they send it on and send the earliest of equal contexts alone, so copies don't pile
up; an anchor that is too frequent even so is dealt by whole suffixes instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemill.llm.common import as_bytes, chunks, cut, mix, pack, partitions

LENGTH = 100
SEED = 32
#: Bytes sorted by multikey quicksort before blind tries take over.
SHALLOW = 16
#: An anchor with so many occurrences may be dealt by suffixes.
FREQUENT = 1000
FLUSH = 1 << 20
#: Hashes of a block of texts whose places are told by 28 bits.
PLACES = 1 << 27
NO_ID = (1 << 63) - 1
U = np.uint64
ENTRY = np.dtype([("anchor", "<u4"), ("doc", "<i8"), ("text", "<i8"), ("at", "<i8"), ("before", "u1"), ("size", "u1")])


def equal_classes(rows: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Labels that rows (n, width) share where group and all bytes are equal: deep-shallow sorting, all groups at once."""
    n, width = rows.shape
    label = np.unique(group, return_inverse=True)[1].astype(np.int64)
    fresh = n
    active = np.arange(n)

    def split(active: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Members of a label part by key; those that stay with others."""
        nonlocal fresh
        order = np.lexsort((key, label[active]))
        rows_, key, own = active[order], key[order], label[active][order]
        new = np.ones(len(order), bool)
        new[1:] = (own[1:] != own[:-1]) | (key[1:] != key[:-1])
        part = np.cumsum(new) - 1
        label[rows_] = fresh + part
        fresh += len(order)
        return rows_[np.bincount(part)[part] > 1] if len(order) else rows_

    for at in range(0, min(SHALLOW, width - 7), 8):
        words = np.ascontiguousarray(rows[active, at : at + 8]).view(">u8").ravel()
        active = split(active, words)
    while len(active):
        active = active[np.argsort(label[active], kind="stable")]
        own = label[active]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        sizes = np.diff(np.append(first, len(active)))
        differs = rows[active] != rows[np.repeat(active[first], sizes)]
        depth = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
        branch = np.repeat(np.minimum.reduceat(depth, first), sizes)
        inner = branch < width
        active, branch = active[inner], branch[inner]
        active = split(active, rows[active, branch]) if len(active) else active
    return label


def earliest(rows: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Of rows in order of their place in the corpus: whether each is the first of its equals."""
    out = np.zeros(len(rows), bool)
    step = 1 << 17
    order = np.argsort(group, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(group[order]) != 0, [True]])) if len(order) else np.zeros(1, int)
    a = 0
    while a < len(order):
        b = int(edges[max(np.searchsorted(edges, a + step, "right") - 1, np.searchsorted(edges, a, "right"))])
        own = order[a:b]
        _, first = np.unique(equal_classes(rows[own], group[own]), return_index=True)
        out[own[first]] = True  # own is in order within a group, and labels don't cross groups
        a = b
    return out


def in_order(entry: np.ndarray) -> np.ndarray:
    """Indices of entries by their place in the corpus; one of those that repeated rows bring twice."""
    order = np.lexsort((entry["anchor"], entry["at"], entry["text"], entry["doc"]))
    own = entry[order]
    new = np.ones(len(own), bool)
    new[1:] = np.logical_or.reduce([own[c][1:] != own[c][:-1] for c in ("doc", "text", "at", "anchor")])
    return order[new]


def least_places(h: np.ndarray) -> np.ndarray:
    """Of each run of LENGTH - SEED + 1 neighbours, the place of the least, the first of equals; by the upper 36 bits.

    The lower 28 bits carry places, so hashes are taken in blocks of PLACES, each with the run that begins at its end."""
    window, found = LENGTH - SEED + 1, []
    for at in range(0, len(h) - window + 1, PLACES):
        part = h[at : at + PLACES + window - 1]
        least, have = (part >> U(28) << U(28)) | np.arange(len(part), dtype=U), 1
        while have * 2 <= window:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        least = np.minimum(least[: len(least) - (window - have)], least[window - have :])
        found.append((least & U((1 << 28) - 1)).astype(np.int64) + at)
    return np.concatenate(found)


class Anchors:
    """Of joined texts: raw, and for each anchor its position, the first and last start of the strings it stands for, the text's index and the hash."""

    def __init__(self, texts: list[bytes]):
        self.raw = raw = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        n = len(raw)
        if n < LENGTH:
            self.position = self.first = self.last = self.text = np.zeros(0, np.int64)
            self.hash = np.zeros(0, U)
            return
        h = raw.astype(U) + U(1)
        width, factor = 1, 0x9E3779B97F4A7C15
        while width < SEED:
            h = h[:-width] * U(factor) + h[width:]
            factor = factor * factor % (1 << 64) | 1
            width *= 2
        h = mix(h)
        argument = least_places(h)
        inside = np.zeros(n + 1, np.int8)
        long = sizes >= LENGTH
        np.add.at(inside, self.offsets[:-1][long], 1)
        np.add.at(inside, self.offsets[1:][long] - LENGTH + 1, -1)
        start = np.flatnonzero(np.cumsum(inside, dtype=np.int8)[: len(argument)])
        argument = argument[start]
        new = np.flatnonzero(np.concatenate([[True], argument[1:] != argument[:-1]])) if len(start) else np.zeros(0, int)
        self.position = argument[new]
        self.first = start[new]
        self.last = start[np.append(new[1:], len(start)) - 1] if len(new) else self.first
        self.text = np.searchsorted(self.offsets, self.position, "right") - 1
        self.hash = h[self.position]


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """(doc, at: an anchor's position in the text, frequent: null, or for a frequent anchor its occurrences, with doc
    and at its bucket and hash) of anchors that occur twice or more."""
    spark = docs.sparkSession
    wide = partitions(spark) * 4

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush():
            h, doc, at = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.argsort(h, kind="stable")
            h, doc, at = h[order], doc[order], at[order]
            new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, int)
            count = np.diff(np.append(new, len(h)))
            again = np.repeat(count > 1, count)
            rows = [(k, 0, x) for k, x in pack((h[new] % U(wide)).astype(np.int64), (h[new] >> U(32)).astype("<u4"), doc[new], at[new].astype("<u4"), count.astype("<u4"))]
            rows += [(k, 1, x) for k, x in pack(doc[again] % wide, doc[again], at[again].astype("<u4"))]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.list_(pa.binary()))], ["bucket", "kind", "columns"])

        total = 0
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), as_bytes(batch.column(2))
            for a, b in chunks([len(t) for t in texts]):
                found = Anchors(texts[a:b])
                held.append((found.hash, ids[a:b][found.text], found.position - found.offsets[found.text]))
                total += len(found.hash)
                if total > FLUSH:
                    yield flush()
                    total = 0
        if held:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[int, int, list[bytes]]] = []
        for batch in batches:
            parts += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist())
        doc, at, counts = [], [], []
        for bucket in {p[0] for p in parts}:
            one = [c for k, kind, c in parts if k == bucket and kind == 0]
            h, d, p, n = (np.frombuffer(b"".join(c[i] for c in one), t) for i, t in enumerate(("<u4", "<i8", "<u4", "<u4")))
            order = np.argsort(h, kind="stable")
            new = np.flatnonzero(np.concatenate([[True], np.diff(h[order].astype(np.int64)) != 0])) if len(h) else np.zeros(0, int)
            total = np.add.reduceat(n[order].astype(np.int64), new) if len(h) else np.zeros(0, np.int64)
            sizes = np.diff(np.append(new, len(h)))
            pick = order[np.repeat(total > 1, sizes)]
            pick = pick[n[pick] == 1]  # the others were sent as repeated by their task
            doc.append(d[pick])
            at.append(p[pick].astype(np.int64))
            often = total >= FREQUENT
            counts += [(bucket, int(x), int(c)) for x, c in zip(h[order][new][often], total[often])]
        doc += [np.frombuffer(c[0], "<i8") for _, kind, c in parts if kind == 1]
        at += [np.frombuffer(c[1], "<u4").astype(np.int64) for _, kind, c in parts if kind == 1]
        if doc:
            d, p = np.concatenate(doc), np.concatenate(at)
            for a in range(0, len(d), 1 << 16):
                s = slice(a, a + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(d[s]), pa.array(p[s]), pa.nulls(len(d[s]), pa.int64())], ["doc", "at", "frequent"])
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*counts)], ["doc", "at", "frequent"])

    packed = docs.mapInArrow(find, "bucket int, kind int, columns array<binary>").repartition(partitions(spark), "bucket")
    return packed.mapInArrow(meet, "doc long, at long, frequent long")


def _contexts(raw: np.ndarray, first: np.ndarray, size: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Contexts as rows of equal width: bytes padded with 0, then the place of the anchor and the size."""
    width = 2 * LENGTH - SEED
    at = np.arange(width)
    rows = raw[np.minimum(first[:, None] + at, len(raw) - 1)] * (at < size[:, None]).astype(np.uint8)
    return np.hstack([rows, before[:, None].astype(np.uint8), size[:, None].astype(np.uint8)])


def covered_starts(placed: DataFrame, frequent: set[tuple[int, int]]) -> DataFrame:
    """placed (doc, text_key, text, anchors: repeated positions) -> (doc, text_key, first, last): ranges of starts of strings that start earlier too."""
    spark = placed.sparkSession
    wide = partitions(spark) * 4

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, keys, texts, wanted = batch.column(0).to_numpy(), batch.column(1).to_numpy(), as_bytes(batch.column(2)), batch.column(3)
            held, done = [], []
            for a, b in chunks([len(t) for t in texts]):
                found = Anchors(texts[a:b])
                base = found.offsets[:-1]
                marks = np.concatenate([np.unique(x.values.to_numpy()) + o for x, o in zip(wanted[a:b], base)]) if b > a else np.zeros(0, np.int64)
                pick = np.flatnonzero(np.isin(found.position, marks))
                p, first, last, text, h = (x[pick] for x in (found.position, found.first, found.last, found.text, found.hash))
                bucket, anchor = (h % U(wide)).astype(np.int64), (h >> U(32)).astype("<u4")
                if frequent:
                    often = np.array([x in frequent for x in zip(bucket.tolist(), anchor.tolist())], bool)
                    n = np.where(often, last - first + 1, 1)
                    row = np.repeat(np.arange(len(p)), n)
                    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                    single = often[row]
                    p, text, bucket, anchor = p[row], text[row], bucket[row], anchor[row]
                    first, last = first[row] + step, np.where(single, first[row] + step, last[row])
                    for i in np.flatnonzero(single):
                        x = xxhash.xxh64_intdigest(found.raw[first[i] : first[i] + LENGTH].tobytes())
                        bucket[i], anchor[i], p[i] = x % wide, x >> 32, first[i]
                entry = np.zeros(len(p), ENTRY)
                entry["anchor"], entry["doc"], entry["text"] = anchor, docs[a:b][text], keys[a:b][text]
                entry["at"], entry["before"], entry["size"] = p - base[text], p - first, last - first + LENGTH
                held.append((bucket, entry, _contexts(found.raw, first, last - first + LENGTH, p - first)))
            bucket, entry, rows = (np.concatenate(x) for x in zip(*held))
            order = in_order(entry)
            bucket, entry, rows = bucket[order], entry[order], rows[order]
            stays = earliest(rows, bucket << 32 | entry["anchor"])
            gone = entry[~stays]
            done = [(k, 1, x + [b""]) for k, x in pack(gone["doc"] % wide, gone)]
            for k, (own,) in pack(bucket[stays], np.flatnonzero(stays)):
                own = np.frombuffer(own, np.int64)
                done.append((k, 0, [entry[own].tobytes(), b"".join(r[:s].tobytes() for r, s in zip(rows[own], entry["size"][own]))]))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in done], pa.int32()), pa.array([r[1] for r in done], pa.int32()), pa.array([r[2][0] for r in done], pa.binary()), pa.array([r[2][1] for r in done], pa.binary())], ["bucket", "kind", "entries", "contexts"])

    def ranges(entry: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = entry["at"] - entry["before"]
        for a in range(0, len(entry), 1 << 16):
            s = slice(a, a + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(entry["doc"][s]), pa.array(entry["text"][s]), pa.array(first[s]), pa.array(first[s] + entry["size"][s] - LENGTH)], ["doc", "text_key", "first", "last"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[tuple[bytes, bytes]]] = {}
        for batch in batches:
            for k, kind, entries, contexts in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if kind == 1:
                    yield from ranges(np.frombuffer(entries, ENTRY))
                else:
                    parts.setdefault(k, []).append((entries, contexts))
        for found in parts.values():
            entry, raw = np.frombuffer(b"".join(x[0] for x in found), ENTRY), np.frombuffer(b"".join(x[1] for x in found), np.uint8)
            size = entry["size"].astype(np.int64)
            begin = np.cumsum(size) - size
            order = in_order(entry)
            entry, begin, size = entry[order], begin[order], size[order]
            group = entry["anchor"].astype(np.int64)
            stays = earliest(_contexts(raw, begin, size, entry["before"].astype(np.int64)), group)
            yield from ranges(entry[~stays])
            entry, begin, size, group = entry[stays], begin[stays], size[stays], group[stays]
            # Contexts of one anchor that differ: their suffixes, by the anchor's offset.
            _, inverse, count = np.unique(group, return_inverse=True, return_counts=True)
            own = np.flatnonzero(count[inverse] > 1)
            own = own[np.argsort(inverse[own], kind="stable")]
            edges = np.flatnonzero(np.concatenate([[True], np.diff(inverse[own]) != 0, [True]])) if len(own) else np.zeros(1, int)
            a = 0
            while a < len(own):  # some groups at a time
                b = int(edges[max(np.searchsorted(edges, a + 4096, "right") - 1, np.searchsorted(edges, a, "right"))])
                some = own[a:b]
                n = size[some] - LENGTH + 1
                row = np.repeat(some, n)
                step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                suffixes = raw[(begin[row] + step)[:, None] + np.arange(LENGTH)]
                gone = np.flatnonzero(~earliest(suffixes, group[row] << 8 | (entry["before"][row] - step)))
                if len(gone):
                    cut_ = np.flatnonzero(np.concatenate([[True], (np.diff(row[gone]) != 0) | (np.diff(step[gone]) != 1)]))
                    e = entry[row[gone[cut_]]].copy()
                    lo = step[gone[cut_]]
                    hi = step[gone[np.append(cut_[1:], len(gone)) - 1]]
                    e["at"], e["before"], e["size"] = e["at"] - e["before"] + lo, 0, hi - lo + LENGTH
                    yield from ranges(e)
                a = b

    packed = placed.select("doc", "text_key", "text", "anchors").mapInArrow(gather, "bucket int, kind int, entries binary, contexts binary")
    return packed.repartition(partitions(spark), "bucket").mapInArrow(settle, "doc long, text_key long, first long, last long")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept: the bytes left) of each row of docs (doc_id, text).

    Null text is empty. Rows with one doc_id count in the order of their texts' hashes; rows that are equal throughout
    are one document, so neither removes the other. A null doc_id comes after all others. Texts may have up to 256 MB.
    Other columns are not read; an empty table gives an empty table.
    """
    # Both joins take these columns and no others, so that the texts are dealt once and the exchange is used again.
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("text_key"), "text")
    found = cut(repeated_anchors(keyed.select("doc", "text_key", "text")))
    # The most frequent anchors, a few for each partition: only such can be more than a fair share of one task.
    often = found.where(F.col("frequent").isNotNull()).orderBy(F.desc("frequent"), "doc", "at").limit(4 * partitions(docs.sparkSession)).collect()
    marks = found.where(F.col("frequent").isNull()).groupBy("doc").agg(F.collect_list("at").alias("anchors"))
    placed = keyed.join(marks, "doc")
    total = sum(r["frequent"] for r in often)
    fair = total / (4 * partitions(docs.sparkSession)) if often else 0
    hot = {(r["doc"], r["at"]) for r in often if r["frequent"] > max(16 * FREQUENT, fair)}
    spans = covered_starts(placed, hot).groupBy("doc").agg(F.collect_list(F.struct("text_key", "first", "last")).alias("spans"))

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys, out = as_bytes(batch.column(2)), batch.column(1).to_pylist(), []
            for text, key, spans in zip(texts, keys, batch.column(3)):
                kept, n, removed = text, 0, 0
                if spans.is_valid:
                    own, first, last = (x.to_numpy() for x in spans.values.flatten())
                    mine = own == key
                    edge = np.zeros(len(text) + 1, np.int32)
                    np.add.at(edge, first[mine], 1)
                    np.add.at(edge, last[mine] + LENGTH, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    removed = int(gone.sum())
                    n = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                out.append((len(text), removed, n, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return keyed.join(spans, "doc", "left").select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "text_key", "text", "spans").mapInArrow(cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op4_substrings(spark, sf_dir):
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept")
