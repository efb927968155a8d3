"""Idle windows as a stream: event-time timers raise a silent key's windows without an event of it.

A watched key holds the number of its first undecided window and which of the later ones have had an event. When the watermark
passes the end of the undecided window, the key's timer fires, emits the windows that stayed empty, and is set for the next one.
State is bounded by the watched keys and by the windows that the watermark holds open; events of other keys leave before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class IdleProcessor(StatefulProcessor):
    """Emits (keys, window_start) of each window of the range (epoch seconds) that ends without an event of the key."""

    def __init__(self, keys: list[str], seconds: int, first: int, last: int) -> None:
        self.keys, self.seconds, self.first = keys, seconds, first
        self.slots = (last - first) // seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "slot long")
        self.busy = handle.getMapState("busy", "slot long", "seen boolean")

    def _watch(self, slot: int) -> None:
        self.open.update((slot,))
        if slot < self.slots:
            self.handle.registerTimer((self.first + (slot + 1) * self.seconds) * 1000)

    def _rows(self, key: Any, slots: list[int]) -> pd.DataFrame:
        out = {k: pd.Series([v] * len(slots), dtype=object) for k, v in zip(self.keys, key)}
        return pd.DataFrame(out | {"window_start": pd.to_datetime([self.first + s * self.seconds for s in slots], unit="s").astype("datetime64[us]")})

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        self._watch(0)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        if not self.open.exists():  # a key that is watched since this batch
            self._watch(0)
        start = int(self.open.get()[0])
        for part in rows:
            for slot in part["slot"].unique().tolist():
                if start <= slot < self.slots:
                    self.busy.updateValue((int(slot),), (True,))
        yield self._rows(key, [])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() // 1000
        start = int(self.open.get()[0])
        stop = max(start, min(self.slots, (passed - self.first) // self.seconds))
        idle = []
        for slot in range(start, stop):
            if self.busy.containsKey((slot,)):
                self.busy.removeKey((slot,))
            else:
                idle.append(slot)
        self._watch(stop)
        yield self._rows(key, idle)

    def close(self) -> None:
        pass


def idle_stream(events: DataFrame, seconds: int, keys: list[str], start: str, end: str, watched: DataFrame, delay: str) -> DataFrame:
    """Streaming (keys, window_start): windows of [start, end) without an event of a watched key, once the watermark has passed them.

    `events` is a stream with the keys and `ts`, watermarked here by `delay`; `watched` is a table of keys, which start with the
    query, so that a key without any event has its timer too. Windows beyond the watermark are undecided until a later event,
    of whatever key, moves it on. The session needs the RocksDB state store (`with_state_store`).
    """
    spark = events.sparkSession
    first, last = (int(x) for x in spark.range(1).select(*[F.unix_seconds(F.lit(x).cast("timestamp")) for x in (start, end)]).first())
    watch = watched.select(*keys).distinct()
    rows = events.select(*keys, F.col("ts").cast("timestamp").alias("ts")).withWatermark("ts", delay).join(watch, keys, "left_semi")
    slot = F.floor((F.unix_seconds("ts") - first) / seconds).cast("long")
    schema = T.StructType([*[events.schema[k] for k in keys], T.StructField("window_start", T.TimestampType())])
    return rows.withColumn("slot", slot).groupBy(*keys).transformWithStateInPandas(
        IdleProcessor(keys, seconds, first, last), outputStructType=schema, outputMode="append", timeMode="EventTime", initialState=watch.groupBy(*keys))
