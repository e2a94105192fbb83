"""Batches that are bounded by a size and by a wait, as state with timers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class Batcher(StatefulProcessor):
    """Holds a key's rows until there are ``size`` of them or the first has waited ``wait_ms``, then gives them numbered as one batch.

    Rows wait in list state, the batch's number and the timer's time in value state; a key that stays silent for
    ``ttl_ms`` after its last batch forgets its number. State may start from rows that a batch table holds.
    """

    def __init__(self, rows: T.StructType, size: int, wait_ms: int, ttl_ms: int | None = None):
        self.rows, self.size, self.wait, self.ttl = rows, size, wait_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.rows)
        self.due = handle.getValueState("due", T.StructType([T.StructField("at", T.LongType())]))
        self.number = handle.getValueState("number", T.StructType([T.StructField("n", T.LongType())]), self.ttl)

    def _held(self) -> list[tuple]:
        return list(self.waiting.get())

    def _batch(self, rows: list[tuple]) -> pd.DataFrame:
        n = self.number.get()[0] if self.number.exists() else 0
        self.number.update((n + 1,))
        out = pd.DataFrame(rows, columns=self.rows.names)
        out["batch"] = n
        return out

    def _settle(self, rows: list[tuple], now: int) -> None:
        """Rows that go on waiting, with a timer for the first of them."""
        if rows:
            self.waiting.put(rows)
            if not self.due.exists():
                self.due.update((now + self.wait,))
                self.handle.registerTimer(now + self.wait)
            return
        self.waiting.clear()
        if self.due.exists():
            self.handle.deleteTimer(self.due.get()[0])
            self.due.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self._held()
        for part in rows:
            held += list(part[self.rows.names].itertuples(index=False, name=None))
        full = len(held) // self.size * self.size
        for k in range(0, full, self.size):
            yield self._batch(held[k : k + self.size])
        if full:  # what is left has only just begun to wait
            self._settle([], 0)
        self._settle(held[full:], timerValues.getCurrentProcessingTimeInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._held()
        self.waiting.clear()
        self.due.clear()
        if held:
            yield self._batch(held)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._settle(list(initialState[self.rows.names].itertuples(index=False, name=None)), timerValues.getCurrentProcessingTimeInMs())

    def close(self) -> None:
        pass


def batched(stream: DataFrame, key: str, size: int, wait_ms: int, initial: DataFrame | None = None, ttl_ms: int | None = None) -> DataFrame:
    """``stream`` with a column batch: each key's rows in batches of ``size``, or fewer once the first has waited ``wait_ms``.

    ``initial`` holds rows that wait from before. Spread one key over several, by a salt, where it has too many rows
    for one task. Needs the RocksDB state store.
    """
    rows = stream.schema
    out = T.StructType([*rows.fields, T.StructField("batch", T.LongType())])
    start = None if initial is None else initial.select(*rows.names).groupBy(key)
    return stream.groupBy(key).transformWithStateInPandas(Batcher(rows, size, wait_ms, ttl_ms), out, "Append", "ProcessingTime", start)
