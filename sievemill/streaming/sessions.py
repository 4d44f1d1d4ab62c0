"""Sessions on a stream, kept as state with a timer each."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sievemill.streaming.resume import timed

MILLI = 1000


class SessionProcessor(StatefulProcessor):
    """A key's open sessions as (first, last, n), in microseconds; a timer tells a session once the watermark passes its end."""

    def __init__(self, gap_ms: int):
        self.gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "first long, last long, n long")

    def ends(self, last: int) -> int:
        """The first millisecond at which no row can join any more."""
        return last // MILLI + self.gap_ms + 1

    def keep(self, sessions: list[tuple[int, int, int]]) -> None:
        if sessions:
            self.open.put(sessions)
        else:
            self.open.clear()

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = [tuple(r) for r in self.open.get()]
        were = {self.ends(last) for _, last, _ in held}
        merged: list[tuple[int, int, int]] = []
        for first, last, n in sorted([*held, *((r["_t"], r["_t"], 1) for r in rows)]):
            if merged and first <= merged[-1][1] + self.gap_ms * MILLI:
                a, b, k = merged[-1]
                merged[-1] = (a, max(b, last), k + n)
            else:
                merged.append((first, last, n))
        now = {self.ends(last) for _, last, _ in merged}
        for at in were - now:
            self.handle.deleteTimer(at)
        for at in now - were:
            self.handle.registerTimer(at)
        self.keep(merged)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        held = [tuple(r) for r in self.open.get()]
        self.keep([s for s in held if self.ends(s[1]) > due])
        for first, last, n in held:
            if self.ends(last) <= due:
                yield Row(_k=key[0], first=first, last=last + self.gap_ms * MILLI, n=n)

    def close(self) -> None:
        pass


def stateful_sessions(stream: DataFrame, key: str, time: str, delay: str, gap_ms: int) -> DataFrame:
    """(key, start, end, n) of each session of rows at most gap_ms apart, told once the watermark has passed its end.

    The same sessions as timeline.sessions gives for a table. Rows later than delay are dropped. State holds a key's open
    sessions, three numbers each; it needs the RocksDB state store."""
    kind = dict(stream.dtypes)[key]
    rows = timed(stream.where(F.col(time).isNotNull()), time, delay).select(F.col(key).alias("_k"), time, F.unix_micros(time).alias("_t"))
    told = rows.groupBy("_k").transformWithState(SessionProcessor(gap_ms), f"_k {kind}, first long, last long, n long", "append", "eventTime")
    return told.select(F.col("_k").alias(key), F.timestamp_micros("first").alias("start"), F.timestamp_micros("last").alias("end"), "n")
