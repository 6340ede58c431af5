"""First-wins by event time as a stateful stream processor."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.dedup import dedup_first


class _EarliestWins(StatefulProcessor):
    """State of a key: the earliest row so far until the watermark passes it, then the time until which it is remembered."""

    def __init__(self, schema: T.StructType, key: Sequence[str], order: Sequence[str], remember_ms: int):
        self.schema, self.key, self.order, self.remember_ms = schema, list(key), list(order), remember_ms
        self.held = T.StructType([f for f in schema if f.name not in self.key])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", self.held)
        self.until = handle.getValueState("until", "ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        until = self.until.get()[0] if self.until.exists() else None
        known = self.best.get() if self.best.exists() else None
        names, best = self.held.names, known
        for frame in rows:
            if until is not None:  # copies within the time the key is remembered
                frame = frame[frame[self.order[0]].map(_millis) > until]
            if len(frame):
                row = tuple(_plain(v) for v in frame.sort_values(self.order)[names].iloc[0])
                if best is None or self._place(row) < self._place(best):
                    best = row
        if best is not known:
            if known is not None:
                self.handle.deleteTimer(_millis(known[names.index(self.order[0])]))
            elif until is not None:
                self.until.clear()
                self.handle.deleteTimer(until)
            self.best.update(best)
            self.handle.registerTimer(_millis(best[names.index(self.order[0])]))
        yield from ()

    def _place(self, row: tuple) -> tuple:
        return tuple(row[self.held.names.index(c)] for c in self.order)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.best.exists():
            row = self.best.get()
            self.best.clear()
            until = expiredTimerInfo.getExpiryTimeInMs() + self.remember_ms
            self.until.update((until,))
            self.handle.registerTimer(until)
            made = {**dict(zip(self.key, key, strict=True)), **dict(zip(self.held.names, row, strict=True))}
            yield pd.DataFrame({n: [made[n]] for n in self.schema.names})
        else:
            self.until.clear()

    def close(self) -> None:
        pass


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    return value.to_pydatetime() if isinstance(value, pd.Timestamp) else value.item() if hasattr(value, "item") else value


def _millis(moment) -> int:
    return int(pd.Timestamp(moment).value // 1_000_000)


def stream_earliest_wins(stream: DataFrame, key: Sequence[str], ts: str, tiebreak: Sequence[str], delay: str,
                         remember_seconds: int) -> DataFrame:
    """The row of each key with the earliest event time, whatever the micro-batch it comes in.

    A row is held until the watermark (``delay`` behind the latest time) passes it, since an earlier one may still come;
    then it is emitted, once. Copies are dropped for ``remember_seconds`` of event time after it, however late
    they arrive; a later row counts as new, unless it comes while the first one is still held. Rows behind the watermark
    of the batch before are dropped, as by any stateful operator, so ``delay`` must cover the disorder of the input. State is one row or one
    number per remembered key, in RocksDB. Key, time and tiebreak must not be NULL. Session time zone: UTC.
    """
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in stream.schema])
    processor = _EarliestWins(schema, key, [ts, *tiebreak], remember_seconds * 1000)
    return (stream.withWatermark(ts, delay).groupBy(*key)
            .transformWithStateInPandas(processor, schema, outputMode="append", timeMode="eventTime"))


def with_held_rows(emitted: DataFrame, rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """All first rows with a flag ``closed``: those emitted, and of keys that are still held their first so far."""
    waiting = dedup_first(rows.join(emitted.select(*key), list(key), "left_anti"), list(key), list(order))
    return emitted.withColumn("closed", F.lit(True)).unionByName(waiting.withColumn("closed", F.lit(False)))
