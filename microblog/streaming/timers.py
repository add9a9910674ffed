"""Sliding windows as keyed state with event-time timers.

Both operators take final panes (a tumbling count per key, which collapses hot
keys before anything is keyed by them) and keep every pane once, not once
per window. Timers fire once the watermark has passed, so what a window
loses is told without later rows of its key. State and timers live in the state
store of the query's checkpoint (RocksDB, which ``state_store`` selects): a
restart resumes them, and a query whose state is gone fails.
"""

from __future__ import annotations

import heapq
from collections import Counter, deque
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import takewhile
from math import gcd

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators.windows import INVERSES, WIDTH

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Fixed value: state groups among which the keys of a ranking are dealt; each
# holds the panes of its keys and hands on its k largest.
SALTS = 32


@contextmanager
def state_store(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which timers need;
    the session's own setting comes back afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS_DB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def final_panes(rows: DataFrame, key: str, delay: str, seconds: int = 1) -> DataFrame:
    """at (event time), key, sec, c: counts of ``seconds``-second panes, emitted
    once final."""
    panes = (rows.withWatermark("created_at", delay).groupBy(F.window("created_at", f"{seconds} seconds"), key)
             .agg(F.count(F.lit(1)).alias("c")))
    return panes.select(F.window_time("window").alias("at"), key, F.unix_seconds(F.col("window.start")).alias("sec"), "c")


# Most panes that an input batch of one key holds in memory before they go to
# the state.
HELD_PANES = 100_000


class _ChangePoints(StatefulProcessor):
    """Of one key: the panes that have not left the window, in blocks of a window
    width, the count, the last second that was told and a timer for the next
    second at which a pane enters or leaves. One timer tells every change that
    the watermark has passed, in the order of time, so the state is asked once
    for a block and not for every pane. Blocks are read as they are reached, and
    no more than two are held."""

    def __init__(self, key: str, width: int, sign: int, keep_zero: bool):
        self.key, self.width, self.sign, self.keep_zero = key, width, sign, keep_zero

    def init(self, handle) -> None:
        self.handle = handle
        self.blocks = handle.getMapState("blocks", "block bigint", "secs array<bigint>, counts array<bigint>")
        self.count = handle.getValueState("count", "n bigint")
        self.told = handle.getValueState("told", "sec bigint")

    def _keep(self, new: dict[int, tuple[list, list]]) -> None:
        for block, (secs, counts) in new.items():
            if self.blocks.containsKey((block,)):
                old = self.blocks.getValue((block,))
                secs, counts = [*old[0], *secs], [*old[1], *counts]
            self.blocks.updateValue((block,), (secs, counts))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new: dict[int, tuple[list, list]] = {}
        first, held = None, 0
        for r in rows:  # a final pane comes once
            secs, counts = new.setdefault(r.sec // self.width, ([], []))
            secs.append(r.sec)
            counts.append(r.c)
            first, held = r.sec if first is None else min(first, r.sec), held + 1
            if held == HELD_PANES:
                self._keep(new)
                new, held = {}, 0
        self._keep(new)
        if first is not None:
            self.handle.registerTimer((first + 1) * 1000)
        return iter(())

    def _panes(self, blocks: list[int]) -> Iterator[tuple[int, int]]:
        for block in blocks:
            yield from sorted(zip(*self.blocks.getValue((block,))))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        upto = timerValues.getCurrentWatermarkInMs() // 1000 - 1
        told = self.told.get()[0] if self.told.exists() else None
        if told is not None and told >= upto:
            return  # an earlier timer of this micro-batch has told it
        blocks = sorted(b[0] for b in self.blocks.keys())
        entering = ((s, c) for s, c in self._panes(blocks) if told is None or s > told)
        leaving = ((s + self.width, c) for s, c in self._panes(blocks) if told is None or s + self.width > told)
        n = self.count.get()[0] if self.count.exists() else 0
        come, go = next(entering, None), next(leaving, None)
        while go is not None:  # a pane leaves after it came
            sec = min(come[0], go[0]) if come is not None else go[0]
            if sec > upto:
                break
            if come is not None and come[0] == sec:
                n, come = n + come[1], next(entering, None)
            if go[0] == sec:
                n, go = n + self.sign * go[1], next(leaving, None)
            if n or self.keep_zero:
                yield Row(**{self.key: key[0], "sec": sec, "n": n})
        if n:
            self.count.update((n,))
        else:
            self.count.clear()
        for block in blocks:
            if (block + 2) * self.width - 1 <= upto:  # its last pane has left
                self.blocks.removeKey((block,))
        self.told.update((upto,))
        if go is not None:
            self.handle.registerTimer(((min(come[0], go[0]) if come is not None else go[0]) + 1) * 1000)


def change_points(rows: DataFrame, key: str, delay: str, width: int = WIDTH, inverse: str = "subtract", keep_zero: bool = True) -> DataFrame:
    """key, sec, n: live sliding counts of ``width`` seconds in change-point
    form, the streaming twin of ``windows.sliding_count``. A change point at
    second s is emitted once the watermark has passed s + 1."""
    if inverse not in INVERSES:
        raise ValueError(f"inverse must be one of {INVERSES}")
    kind = rows.schema[key].dataType.simpleString()
    processor = _ChangePoints(key, width, -1 if inverse == "subtract" else 1, keep_zero)
    return final_panes(rows, key, delay).groupBy(key).transformWithState(processor, f"`{key}` {kind}, sec bigint, n bigint", "Append", "EventTime")


class _Tops(StatefulProcessor):
    """Of one salt: the counts of its keys by pane, the last window end that was
    told, and a timer for the next one. What a window yields is a bounded heap.
    Timers that are set while timers fire wait for the next micro-batch, so one
    timer tells every window that the watermark has passed."""

    def __init__(self, key: str, pane: int, width: int, slide: int, k: int):
        self.key, self.pane, self.width, self.slide, self.k = key, pane, width, slide, k

    def init(self, handle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "sec bigint", "keys array<string>, counts array<bigint>")
        self.told = handle.getValueState("told", "window_end bigint")

    def _last_end(self, sec: int) -> int:
        """The last window end up to a second; windows start at multiples of
        the slide."""
        shift = self.width % self.slide
        return (sec - shift) // self.slide * self.slide + shift

    def _first_end(self, sec: int) -> int:
        return self._last_end(sec) + self.slide

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new: dict[int, tuple[list, list]] = {}
        for r in rows:
            keys, counts = new.setdefault(r.sec, ([], []))
            keys.append(r[self.key])
            counts.append(r.c)
        for sec, (keys, counts) in new.items():
            if self.panes.containsKey((sec,)):
                old = self.panes.getValue((sec,))
                keys, counts = [*old[0], *keys], [*old[1], *counts]
            self.panes.updateValue((sec,), (keys, counts))
            self.handle.registerTimer(self._first_end(sec) * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        upto = self._last_end(timerValues.getCurrentWatermarkInMs() // 1000)
        end = self.told.get()[0] + self.slide if self.told.exists() else None
        if end is not None and end > upto:
            return  # an earlier timer of this micro-batch has told it
        left = deque(sorted(s[0] for s in self.panes.keys()))
        held: dict[int, tuple] = {}
        end = self._first_end(left[0]) if left and end is None else end
        while left and end <= upto:
            while left and left[0] < end - self.width:
                held.pop(left[0], None)
                self.panes.removeKey((left.popleft(),))
            if left and left[0] + self.pane > end:  # nothing happens up to this pane
                end = self._first_end(left[0])
                continue
            inside = Counter()
            for sec in takewhile(lambda s: s + self.pane <= end, left):
                if sec not in held:
                    held[sec] = self.panes.getValue((sec,))
                for x, c in zip(*held[sec]):
                    inside[x] += c
            for x, n in heapq.nsmallest(self.k, inside.items(), key=lambda i: (-i[1], i[0])):
                yield Row(**{"window_end": end, self.key: x, "n": n})
            end += self.slide
        self.told.update((upto,))
        if left and left[0] < upto + self.slide:  # later panes have timers of their own
            self.handle.registerTimer((upto + self.slide) * 1000)


def salted_tops(rows: DataFrame, key: str, delay: str, width: int, slide: int, k: int = 10, salts: int = SALTS) -> DataFrame:
    """window_end, key, n: of every window the ``k`` largest counts of every
    salt, ties by key. The k largest of a window are among them, and a micro-
    batch holds all rows of a window or none; ``windows.top_per_window`` ranks
    them. Null keys are left out."""
    pane = gcd(width, slide)
    panes = final_panes(rows.where(F.col(key).isNotNull()), key, delay, pane).withColumn("salt", F.pmod(F.xxhash64(key), F.lit(salts)))
    return panes.groupBy("salt").transformWithState(_Tops(key, pane, width, slide, k), f"window_end bigint, `{key}` string, n bigint", "Append", "EventTime")
