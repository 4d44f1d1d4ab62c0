"""Periodic runs of words: stretches that repeat with a period and that no neighbour extends.

The words of some texts become numbers that no two texts share, so nothing matches across texts. Prefix doubling names
all stretches of 1, 2, 4, ... words and ends in the suffix array; texts of which no stretch of LEAST_REPEAT words (rounded
down to a power of two) occurs twice leave after the first rounds, as a run's words but for its first period repeat what
stands a period before. Names give the longest common prefix of two suffixes, and the longest common suffix of two
prefixes, in a step for each length.

Suffix array and common prefixes of neighbours give each position's longest previous factor and where that is. From them
follow the blocks of the LZ factorisation, each the longest stretch seen before or a new word. With s, e and q a run's
start, end and period:

- Runs that touch a block's start b, or the text's end, are found there by extending the match of b and a position one
  period away. If e - b is at least q, the positions are b and b + q, and where the run ends in this block, q is at most
  the block's length.
  Otherwise b - s exceeds 3 q, as a run has 4 q words at least, and the positions are b - q and b. Then s + q is in the
  block before or after its start, as that block would go on otherwise: q is less than half of that block's length.
- All other runs lie inside a block and touch neither end. They are copies of runs of the stretch that the block copies,
  whose neighbours are copied too. Blocks from left to right copy what starts in the buckets of that stretch, runs copied
  before among them.

A run spans LEAST_REPEAT words or more after its first period. These lie in the block that holds s + q and the next one,
which reaches the run's end, so borders between blocks of one or two words needn't be looked at: see bounds.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sievemill.llm.common import as_bytes, chunks

#: A run has so many words at least, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: So many words of a run at least repeat those a period before: LEAST_WORDS - 1 with a period of one word, more with others.
LEAST_REPEAT = 5
Run = tuple[int, int, int]  # start, length, period


class Names:
    """Names of the stretches of 1, 2, 4, ... words from each position on, and the suffix array.

    numbers: the words of all texts; texts share none. first: each text's first position, and the total at the end.
    Stretches that a text's end cuts short are named apart from all others."""

    def __init__(self, numbers: np.ndarray, first: np.ndarray, rounds: int = 64):
        n = len(numbers)
        last = np.repeat(first[1:], np.diff(first))
        order = np.argsort(numbers, kind="stable")
        rank = self._ranks(np.zeros(n, np.int64), order, numbers[order])
        self.levels, self.open = [rank], self._shared(rank)
        width = 1
        while len(self.open) and len(self.levels) < rounds:
            at = self.open
            ahead = at + width
            inside = ahead < last[at]
            follow = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
            order = np.lexsort((follow, rank[at]))
            at, follow = at[order], follow[order]
            head = rank[at]
            new = np.ones(len(at), bool)
            new[1:] = (head[1:] != head[:-1]) | (follow[1:] != follow[:-1])
            group = np.ones(len(at), bool)
            group[1:] = head[1:] != head[:-1]
            place = np.arange(len(at))
            within = place - np.maximum.accumulate(np.where(group, place, 0))
            rank = rank.copy()
            rank[at] = head + np.maximum.accumulate(np.where(new, place, 0)) - (place - within)
            width *= 2
            self.levels.append(rank)
            self.open = self._shared(rank)
        self.rank = rank

    @staticmethod
    def _ranks(rank: np.ndarray, order: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Each position's number of positions with smaller keys."""
        if len(order):
            new = np.ones(len(order), bool)
            new[1:] = keys[1:] != keys[:-1]
            rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        return rank

    @staticmethod
    def _shared(rank: np.ndarray) -> np.ndarray:
        """Positions whose rank others have too."""
        return np.flatnonzero(np.bincount(rank, minlength=len(rank))[rank] > 1)

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes at a and b have in common at their start; a and b differ."""
        n, a, b = len(self.rank), a.copy(), b.copy()
        total = np.zeros(len(a), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            names = self.levels[level]
            equal = (a < n) & (b < n)
            equal &= names[np.minimum(a, n - 1)] == names[np.minimum(b, n - 1)]
            step = equal.astype(np.int64) << level
            a, b, total = a + step, b + step, total + step
        return total

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the stretches ending before a and b have in common at their end; a and b differ."""
        a, b = a.copy(), b.copy()
        total = np.zeros(len(a), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            names, width = self.levels[level], 1 << level
            equal = (a >= width) & (b >= width)
            equal &= names[np.maximum(a - width, 0)] == names[np.maximum(b - width, 0)]
            step = equal.astype(np.int64) << level
            a, b, total = a - step, b - step, total + step
        return total


def previous_factors(order: list[int], common: list[int]) -> tuple[list[int], list[int]]:
    """Of each position, the length of the longest factor from there on that starts earlier too, and where.

    order: the suffix array; common: of each of its entries, the words in common with the entry before."""
    n = len(order)
    place = [0] * n
    for k, at in enumerate(order):
        place[at] = k
    above, below = list(range(-1, n - 1)), list(range(1, n + 1))
    common = [*common, 0]
    length, source = [0] * n, [0] * n
    for at in range(n - 1, -1, -1):  # suffixes leave from the last on, so those that remain start earlier
        k = place[at]
        i, j = above[k], below[k]
        x, y = common[k], common[j]
        if x >= y:
            length[at], source[at] = x, order[i] if x else 0
            common[j] = y
        else:
            length[at], source[at] = y, order[j]
            common[j] = x
        if i >= 0:
            below[i] = j
        if j < n:
            above[j] = i
    return length, source


def blocks(length: list[int]) -> list[int]:
    """Starts of the blocks of the LZ factorisation, and the end."""
    starts, at = [0], 0
    while at < len(length):
        at += length[at] or 1
        starts.append(at)
    return starts


def bounds(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest periods to try from each block's start to its right and to its left.

    Where a run's end e is in or at the end of the block that starts at b, e - b is at most its size. If that is 2 or
    less, LEAST_WORDS and LEAST_PERIODS leave 4 words or more between s + q and b, all in the block before."""
    before = np.concatenate([[0], size[:-1]])
    worth = (size >= 3) | (before >= 4)
    return np.where(worth, size, 0), np.where(worth, before // 2, 0)


def touching(names: Names, base: int, n: int, starts: np.ndarray) -> set[Run]:
    """Runs that touch the start of a block or the end; a stretch found with several periods is given with each."""
    right, left = bounds(np.append(np.diff(starts), 0))
    found: set[Run] = set()
    for reach, way in ((right, 1), (left, -1)):
        at = np.repeat(starts, reach)
        period = np.arange(len(at)) - np.repeat(np.cumsum(reach) - reach, reach) + 1
        other = at + way * period
        inside = (other >= 0) & (other <= n)
        low, period = np.minimum(at, other)[inside], period[inside]
        x, y = low + base, low + base + period
        ahead, behind = names.ahead(x, y), names.behind(x, y)
        start, size = low - behind, ahead + behind + period
        good = size >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
        found.update(zip(start[good].tolist(), size[good].tolist(), period[good].tolist()))
    return found


def all_runs(names: Names, base: int, n: int, order: list[int], common: list[int]) -> list[Run]:
    """Runs of the text whose n words start at base, by start and period."""
    length, source = previous_factors(order, common)
    starts = blocks(length)
    least: dict[tuple[int, int], int] = {}
    for start, size, period in touching(names, base, n, np.array(starts)):
        if period < least.get((start, size), n + 1):  # a multiple of the smallest period gives the same stretch
            least[start, size] = period
    buckets: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for (start, size), period in least.items():
        buckets[start].append((size, period))
    if buckets:
        for b, e in zip(starts[:-1], starts[1:]):
            if e - b < LEAST_WORDS + 2:
                continue
            shift = b - source[b]
            for at in range(source[b] + 1, source[b] + e - b):
                for size, period in buckets.get(at, ()):
                    if at + size + shift < e:
                        buckets[at + shift].append((size, period))
    return sorted(((s, size, q) for s, x in buckets.items() for size, q in x), key=lambda r: (r[0], r[2]))


def runs_of(texts: list[list[bytes]]) -> list[list[Run]]:
    """Runs (start, length, period) of each text's words, by start and period."""
    found: list[list[Run]] = [[] for _ in texts]

    def named(which: list[int], rounds: int) -> tuple[Names, np.ndarray]:
        numbers, first, total = [], [0], 0
        for i in which:
            number = {w: total + k for k, w in enumerate(dict.fromkeys(texts[i]))}
            total += len(number)
            numbers.append(np.fromiter(map(number.__getitem__, texts[i]), np.int64, len(texts[i])))
            first.append(first[-1] + len(texts[i]))
        first = np.array(first)
        return Names(np.concatenate(numbers) if numbers else np.zeros(0, np.int64), first, rounds), first

    which = [i for i, words in enumerate(texts) if len(words) >= LEAST_WORDS]
    names, first = named(which, LEAST_REPEAT.bit_length())
    which = [which[k] for k in np.unique(np.searchsorted(first, names.open, side="right") - 1).tolist()]
    names, first = named(which, 64)
    order = np.argsort(names.rank, kind="stable")
    common = np.zeros(len(order), np.int64)
    common[1:] = names.ahead(order[:-1], order[1:])
    for i, a, b in zip(which, first[:-1].tolist(), first[1:].tolist()):
        found[i] = all_runs(names, a, b - a, (order[a:b] - a).tolist(), common[a:b].tolist())
    return found


def best(runs: list[Run]) -> Run | None:
    """The run with most periods, exactly; the first, then that with the smallest period, among equals."""
    top = None
    for start, length, period in runs:
        if top is None or length * top[2] > top[1] * period:
            top = start, length, period
    return top


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """Words that no run contains after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def tail_repeated(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's words: in a tenth of the documents, told by the id, the words from a place on repeat with a period."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


RUN = "struct<start: long, length: long, period: long>"


def find_runs(df: DataFrame, identity: str = "doc_id", text: str = "text", prepare=None) -> DataFrame:
    """(identity, runs array<struct<start, length, period>> by start and period, best: the run with most periods or null,
    collapsed: the words that no run contains after its first period, joined by one space), a row for each row of df.

    Words are parted by ASCII white space. prepare(identity, words) may give other words. Null and empty texts have no runs
    and collapse to the empty text. Repeated rows are treated alike, whatever their ids; other columns aren't read; an empty
    table gives an empty table. A task holds the words of about 1 MB of text, or of one longer text, with some 20 numbers
    a word; time is n log n."""
    kind_of = dict(df.dtypes)[identity]
    run_type = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
    struct = lambda r: r and {"start": r[0], "length": r[1], "period": r[2]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for a, b in chunks([len(t) for t in texts]):
                ids = batch.column(0).slice(a, b - a)
                words = [t.split() for t in texts[a:b]]
                if prepare:
                    words = [prepare(i, w) for i, w in zip(ids.to_pylist(), words)]
                found = runs_of(words)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array([[struct(r) for r in x] for x in found], pa.list_(run_type)),
                        pa.array([struct(best(x)) for x in found], run_type),
                        pa.array([b" ".join(collapsed(w, x)) for w, x in zip(words, found)], pa.binary()).cast(pa.string()),
                    ],
                    [identity, "runs", "best", "collapsed"],
                )

    return df.select(identity, text).mapInArrow(run, f"`{identity}` {kind_of}, runs array<{RUN}>, best {RUN}, collapsed string")


def op12_runs(spark, sf_dir):
    from pyspark.sql import functions as F

    found = find_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), prepare=tail_repeated)
    line = lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(F.expr("1000 * best.length div best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
