"""Keyed state with a bounded trail that is dropped after a time without events."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .blocks import BLOCKS, block_of

TRAIL_POINTS = 40
TRAIL_TTL_SECONDS = 600
TRACK = "key string, status string, lat double, lon double, ts_ms bigint, points int, trail_ms array<bigint>"
_STATE = "key array<string>, points array<int>, lat array<double>, lon array<double>, ts_ms array<bigint>"
_POINT = {"lat": np.float64, "lon": np.float64, "ts_ms": np.int64}


class TrailProcessor(StatefulProcessor):
    """Last ``limit`` points of every key of a block, in time order; one event-time timer per block ends the tracks that are due."""

    def __init__(self, limit: int = TRAIL_POINTS, ttl_seconds: int = TRAIL_TTL_SECONDS):
        self.limit = limit
        self.ttl_ms = ttl_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.trails = handle.getValueState("trails", _STATE)

    def _load(self) -> pd.DataFrame:
        """The points, those of a key together and in time order."""
        keys, sizes, *columns = self.trails.get() if self.trails.exists() else ([],) * (2 + len(_POINT))
        points = {name: np.array(values, dtype) for (name, dtype), values in zip(_POINT.items(), columns)}
        return pd.DataFrame({"key": np.repeat(np.array(keys, object), np.array(sizes, np.int64)), **points})

    def _save(self, points: pd.DataFrame, due: int | None) -> None:
        sizes = points.groupby("key", sort=False).size()
        self.trails.update((sizes.index.tolist(), sizes.tolist(), *[points[name].tolist() for name in _POINT]))
        ends = self._due(points)
        if due != ends:
            if due is not None:
                self.handle.deleteTimer(due)
            if ends is not None:
                self.handle.registerTimer(ends)

    def _due(self, points: pd.DataFrame) -> int | None:
        """The end of the first track to end: the one timer that a block has."""
        return int(points.groupby("key")["ts_ms"].max().min()) + self.ttl_ms if len(points) else None

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        points, met = self._load(), set()
        due = self._due(points)
        for frame in rows:
            met.update(frame["key"])
            # memory stays at one Arrow batch plus the trails, however many rows a key has
            points = pd.concat([points, frame[["key", *_POINT]]], ignore_index=True) if len(points) else frame[["key", *_POINT]]
            points = points.sort_values(["key", "ts_ms", "lat", "lon"]).groupby("key", sort=False).tail(self.limit)
        self._save(points, due)
        yield self._rows("active", points[points["key"].isin(met)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        points = self._load()
        if len(points):
            over = points.groupby("key", sort=False)["ts_ms"].transform("max") + self.ttl_ms < timerValues.getCurrentWatermarkInMs()
            self._save(points[~over], None)
            if over.any():
                yield self._rows("gone", points[over])

    def close(self) -> None:
        pass

    @staticmethod
    def _rows(status: str, points: pd.DataFrame) -> pd.DataFrame:
        grouped = points.groupby("key", sort=False)
        last = grouped.tail(1)
        return pd.DataFrame({"key": last["key"].to_numpy(), "status": status, "lat": last["lat"].to_numpy(), "lon": last["lon"].to_numpy(),
                             "ts_ms": last["ts_ms"].to_numpy(), "points": grouped.size().to_numpy("int32"),
                             "trail_ms": grouped["ts_ms"].agg(list).to_numpy()})


def newest_of_batch(batch: pa.RecordBatch, limit: int) -> pa.RecordBatch:
    """The newest ``limit`` rows of each key (first column) of an Arrow batch, in the order of ts_ms, lat, lon."""
    key = batch.column(0).dictionary_encode().indices.to_numpy()
    place = [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("lon", "lat", "ts_ms")]
    order = np.lexsort((*place, key))
    last = np.searchsorted(key[order], key[order], side="right")
    return batch.take(pa.array(order[last - np.arange(len(order)) <= limit]))


def track(positions: DataFrame, key: str, time: str, delay: str = "1 minute", limit: int = TRAIL_POINTS,
          ttl_seconds: int = TRAIL_TTL_SECONDS, blocks: int = BLOCKS) -> DataFrame:
    """Updated track per key and batch, and one ``gone`` row when a key falls silent.

    ``positions`` carries lat, lon, ts_ms; ``time`` is its timestamp column. Before they move to the state, the rows of every Arrow
    batch are cut to the newest ``limit`` per key, which takes most rows of a hot key away in the map tasks. Keys share the state of one of ``blocks``.
    """
    known = positions.filter(f"lat IS NOT NULL AND lon IS NOT NULL AND ts_ms IS NOT NULL AND {key} IS NOT NULL")
    slim = known.selectExpr(f"CAST({key} AS string) AS key", "CAST(lat AS double) AS lat", "CAST(lon AS double) AS lon", "ts_ms", time)
    cut = slim.mapInArrow(lambda batches: (newest_of_batch(b, limit) for b in batches if b.num_rows), slim.schema)
    dealt = cut.withColumn("block", block_of("key", blocks))
    return dealt.withWatermark(time, delay).groupBy("block").transformWithStateInPandas(
        TrailProcessor(limit, ttl_seconds), outputStructType=TRACK, outputMode="append", timeMode="EventTime")
