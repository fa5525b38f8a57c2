"""Stream-table join whose table lives in the state store: change messages and facts meet per key in one stateful stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.changes import json_field
from .blocks import BLOCKS, block_of

TABLE_ROW = "table_row"
_STATE = "key array<string>, partition array<int>, offset array<bigint>, body array<string>"
_ROW = {"key": object, "partition": "int64", "offset": "int64", "body": object}
_MET = f"key string, fact string, {TABLE_ROW} string"
_CHANGE, _FACT = 0, 1
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class TableBlock(StatefulProcessor):
    """The newest change message of each key of a block; facts leave with their key's row as it stands after the batch's changes.

    A removed row stays as an empty body with its position, so that older messages that come late cannot revive it. The
    facts of one block and batch are held until its changes are applied: bound them by the trigger, and a hot key by salts.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getValueState("rows", _STATE)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._apply([initialState])

    def _table(self) -> pd.DataFrame:
        stored = self.rows.get() if self.rows.exists() else ([],) * len(_ROW)
        return pd.DataFrame({name: pd.Series(values, dtype=kind) for (name, kind), values in zip(_ROW.items(), stored)})

    def _apply(self, changes: list[pd.DataFrame]) -> None:
        known = pd.concat([self._table(), *[frame[list(_ROW)] for frame in changes]], ignore_index=True)
        # of messages at one place the one that came last counts
        newest = known.sort_values(["partition", "offset"], kind="stable").drop_duplicates("key", keep="last")
        bodies = [body if isinstance(body, str) else None for body in newest["body"]]
        self.rows.update((newest["key"].tolist(), newest["partition"].tolist(), newest["offset"].tolist(), bodies))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        changes, facts = [], []
        for frame in rows:
            is_fact = frame["kind"] == _FACT
            for part, held in ((frame[~is_fact], changes), (frame.loc[is_fact, ["key", "body"]], facts)):
                if len(part):
                    held.append(part)
        if changes:
            self._apply(changes)
        if facts:
            table = self._table()
            bodies = dict(zip(table["key"], table["body"]))
            for frame in facts:
                held = pd.Series([bodies.get(k) for k in frame["key"]], dtype=object, index=frame.index)
                yield pd.DataFrame({"key": frame["key"], "fact": frame["body"], TABLE_ROW: held})

    def close(self) -> None:
        pass


def keyed_changes(messages: DataFrame, key_field: str) -> DataFrame:
    """(key, partition, offset, body) of change messages; the body of a removal is null. Text that is no JSON object is dropped.

    The key is taken from a JSON key, a raw text key, or the value itself, in that order.
    """
    is_object = F.json_object_keys("value").isNotNull()
    text_key = F.when(F.json_object_keys("key").isNotNull(), json_field("key", key_field)).otherwise(F.col("key"))
    rows = messages.filter(F.col("value").isNull() | (F.col("value") == "") | is_object)
    rows = rows.select(F.coalesce(text_key, json_field("value", key_field)).alias("key"), F.col("partition").cast("int"),
                       F.col("offset").cast("bigint"), F.when(is_object, F.col("value")).alias("body"))
    return rows.filter(F.col("key").isNotNull())


def join_table(facts: DataFrame, key: str, changes: DataFrame, base: DataFrame | None = None, salts: int = 1,
               blocks: int = BLOCKS) -> DataFrame:
    """Stream (key, fact, table_row): every fact with the body of its key's newest change, null where the table lacks the key.

    The changes of a batch come before its facts. ``base`` (like ``keyed_changes``) is the table before the first batch. With
    ``salts`` each table row is kept that many times and the facts of a key are dealt over the copies, so that no task
    meets a whole hot key. Facts without a key never enter the state. Keys share the state of one of ``blocks``.
    """
    body = F.to_json(F.struct(*[F.col(c) for c in facts.columns]), _TIMES)
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    block = block_of("key", blocks).alias("block")
    shared = ("block", "salt", "key", "kind", "partition", "offset", "body")

    def spread(rows: DataFrame) -> DataFrame:
        return rows.select("key", block, copies.alias("salt"), F.lit(_CHANGE).alias("kind"), "partition", "offset", "body")

    named = facts.select(F.col(key).cast("string").alias("key"), body.alias("body"))
    dealt = F.pmod(F.xxhash64("body"), F.lit(salts)).cast("int")
    own = named.filter(F.col("key").isNotNull()).select(
        "key", block, dealt.alias("salt"), F.lit(_FACT).alias("kind"), F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"), "body")
    grouped = spread(changes).select(*shared).unionByName(own).groupBy("block", "salt")
    met = grouped.transformWithStateInPandas(TableBlock(), outputStructType=_MET, outputMode="append", timeMode="None",
                                             initialState=None if base is None else spread(base).groupBy("block", "salt"))
    without = named.filter(F.col("key").isNull()).select("key", F.col("body").alias("fact"), F.lit(None).cast("string").alias(TABLE_ROW))
    return met.unionByName(without)


def facts_of(met: DataFrame, schema: T.StructType) -> DataFrame:
    """The facts' own columns again, beside ``table_row``."""
    return met.select(F.from_json("fact", schema, _TIMES).alias("__fact"), TABLE_ROW).select("__fact.*", TABLE_ROW)
