"""Packing: shortest-pack-first over the length histogram.

Documents become token pieces of at most CAPACITY. The histogram of piece lengths (CAPACITY entries at most, whatever
the input) is packed on the driver, longest lengths first, each into the pack with the most room left, by counts of
packing patterns. Pieces then join their patterns by rank within their length. The join's table has an entry for each
slot of each pattern: a placement step adds one pattern at most, so it is bounded by CAPACITY alone and is broadcast.

Where many documents share a length, packs may stay half empty for want of short pieces. The emptiest packs are then
dissolved and their pieces cut, at multiples of CUT tokens, into the gaps of the others. The checksum of a part follows
from those of the piece's beginnings, which are kept for every CUT tokens, so no text is encoded twice.
"""

from __future__ import annotations

import base64
import functools
import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievemill.llm.common import cut

CAPACITY = 2048
END_ID = 1
RANK_BUCKETS = 256
CUT = 32
VOCABULARY = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, marks binary"


def encoder(path: str | None = None):
    """The byte-level BPE of byte_bpe_50k.json; its ranks file gives the same ids four times as fast (tests compare)."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def token_ids(encoding, text: str | None) -> np.ndarray:
    """The text's ids, then END_ID."""
    ids = encoding.encode_to_numpy(text or "", allowed_special="all").astype("<u4")
    return np.append(ids, np.uint32(END_ID)).astype("<u4")


@functools.cache
def _zeros(power: int) -> list[int]:
    """What 2 ** power zero bytes do to each bit of a CRC-32."""
    if power == 0:
        one = [0xEDB88320, *(1 << i for i in range(31))]  # a zero bit
        for _ in range(3):
            one = [_through(one, x) for x in one]
        return one
    half = _zeros(power - 1)
    return [_through(half, x) for x in half]


def _through(matrix: list[int], crc: int) -> int:
    out = 0
    for i in range(32):
        if crc >> i & 1:
            out ^= matrix[i]
    return out


def crc_of_end(before: int, whole: int, n: int) -> int:
    """CRC-32 of the last n bytes, from that of what stands before them and that of the whole."""
    power = 0
    while n >> power:
        if n >> power & 1:
            before = _through(_zeros(power), before)
        power += 1
    return before ^ whole


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, cut_at: int = CUT) -> DataFrame:
    """(doc_id, text) -> PIECES; marks: CRCs of a piece's beginnings of cut_at tokens, twice as many and so on, 4 bytes
    each. Null text is empty: a document of END_ID alone. Null doc_id stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(vocabulary)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = token_ids(encoding, text.as_py())
                for a in range(0, len(ids), capacity):
                    part = ids[a : a + capacity]
                    raw, crc, marks = part.tobytes(), 0, []
                    for b in range(0, len(raw), 4 * cut_at):
                        marks.append(crc)
                        crc = zlib.crc32(raw[b : b + 4 * cut_at], crc)
                    rows.append((doc_id, a, len(part), crc, len(ids), np.array(marks[1:], "<u4").tobytes()))
            columns = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i < 5 else pa.binary()) for i, c in enumerate(columns)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "marks"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def shortest_pack_first(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a pattern, number of sequences packed so); every piece is placed once."""
    open_packs: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)  # by room left
    room = 0  # no open pack has more
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while room and not open_packs[room]:
                room -= 1
            if room >= length:
                pattern, count = open_packs[room].pop()
                used = min(count, left)
                if count > used:
                    open_packs[room].append((pattern, count - used))
                open_packs[room - length].append((pattern + (length,), used))
            else:
                used = left
                open_packs[capacity - length].append(((length,), used))
                room = max(room, capacity - length)
            left -= used
    return [x for packs in open_packs.values() for x in packs]


def donors(patterns: list[tuple[tuple[int, ...], int]], capacity: int = CAPACITY, cut_at: int = CUT) -> tuple[list[tuple[tuple[int, ...], int]], list[tuple[tuple[int, ...], int]]]:
    """(packs that stay, packs to dissolve): as many of the emptiest as the gaps of the others hold, in units of cut_at."""
    units = lambda n: -(-n // cut_at)
    gap = lambda lengths: (capacity - sum(lengths)) // cut_at
    room, held, kept, gone = sum(gap(p) * n for p, n in patterns), 0, [], []
    for p, n in sorted(patterns, key=lambda x: (sum(x[0]), x[0])):
        need = sum(map(units, p))
        take = max(0, min(n, (room - held) // (need + gap(p)))) if not kept else 0
        if take:
            gone.append((p, take))
            held, room = held + take * need, room - take * gap(p)
        if n > take:
            kept.append((p, n - take))
    return kept, gone


SLOT = "length long, first_rank long, end_rank long, piece_from long, part_length long, first_sequence long, offset long"


def slots(patterns: list[tuple[tuple[int, ...], int]], capacity: int = CAPACITY, cut_at: int = CUT) -> list[tuple[int, ...]]:
    """Rows of SLOT: for pieces of a length and a range of ranks, the part that starts at piece_from goes to the sequence
    that is as far from first_sequence as the rank from first_rank, at offset."""
    kept, gone = donors(patterns, capacity, cut_at)
    out, ranks, sequence, gaps = [], defaultdict(int), 0, []
    for lengths, count in kept:
        offset = 0
        for n in lengths:
            out.append((n, ranks[n], ranks[n] + count, 0, n, sequence, offset))
            ranks[n] += count
            offset += n
        if room := (capacity - offset) // cut_at:
            heapq.heappush(gaps, (-room, sequence, count, offset))
        sequence += count
    todo = []
    for lengths, count in gone:
        for n in lengths:
            todo.append((n, ranks[n], ranks[n] + count, 0))
            ranks[n] += count
    while todo:
        length, first, end, at = todo.pop()
        room, start, count, offset = heapq.heappop(gaps)
        n, part = min(end - first, count), min(length - at, -room * cut_at)
        out.append((length, first, first + n, at, part, start, offset))
        if count > n:
            heapq.heappush(gaps, (room, start + n, count - n, offset))
        if left := -room - -(-part // cut_at):
            heapq.heappush(gaps, (-left, start, n, offset + part))
        if end - first > n:
            todo.append((length, first + n, end, at))
        if at + part < length:
            todo.append((length, first, first + n, at + part))
    return out


PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(found: DataFrame, capacity: int = CAPACITY, cut_at: int = CUT) -> DataFrame:
    """found (PIECES; read several times) -> PLACED, a row for each piece as it is cut in the end."""
    spark = found.sparkSession
    # At most capacity rows come to the driver.
    histogram = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = spark.createDataFrame(slots(shortest_pack_first(histogram, capacity), capacity, cut_at), SLOT)
    dealt = found.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(RANK_BUCKETS)).cast("int"))
    before = dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    ranked = dealt.join(before, ["length", "_bucket"]).withColumn("_rank", F.col("_before") + F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("doc_id", "start", "ids_crc32")) - 1)
    placed = ranked.join(F.broadcast(table), "length").where((F.col("_rank") >= F.col("first_rank")) & (F.col("_rank") < F.col("end_rank")))

    def cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, crc, at, part = (batch.column(c).to_numpy().copy() for c in ("length", "ids_crc32", "piece_from", "part_length"))
            for i in np.flatnonzero(part < length):
                marks = [0, *np.frombuffer(batch.column("marks")[int(i)].as_buffer(), "<u4").tolist()]
                end = int(at[i] + part[i])
                crc[i] = crc_of_end(marks[int(at[i]) // cut_at], int(crc[i]) if end == length[i] else marks[end // cut_at], 4 * int(part[i]))
            start = batch.column("start").to_numpy() + at
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(start), pa.array(part), pa.array(crc), batch.column("doc_tokens"), batch.column("sequence_id"), batch.column("offset")], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "marks", "piece_from", "part_length", (F.col("first_sequence") + F.col("_rank") - F.col("first_rank")).alias("sequence_id"), "offset"]
    return placed.select(*columns).mapInArrow(cut_pieces, PLACED)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, cut_at: int = CUT) -> DataFrame:
    """A row for each piece of each row of docs. Repeated rows give repeated pieces, each with a place of its own. An
    empty table gives an empty table; other columns are not read."""
    return pack(cut(pieces(docs, capacity, vocabulary, cut_at)), capacity, cut_at)


def op9_packing(spark, sf_dir):
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
