"""Current-value count as a stream: ``table.groupBy((k, v) -> (v, k)).count()``.

Two stateful steps in one query (one checkpoint covers both):

1. per key (``transformWithStateInPandas``): keep the key's current value and its
   version, the place in the read order (topic time, partition, offset) of the row that
   set it.  For the rows of a micro-batch, the newest row wins if it is newer than the
   stored version; older rows are ignored, so files or partitions delivered out of order
   do not bring a stale value back.  A changed value emits ``(old, -1)`` and
   ``(new, +1)``; every value seen emits ``(value, 0)`` so values whose holders
   all moved away keep a row with count 0.  A null value is a delete: the key
   loses its value but keeps its version.
2. per value: ``sum(delta)`` -- a streaming hash aggregate in update mode.

Before the shuffle by key every task reduces its rows to the newest one of each key and
value (:func:`newest_per_value`), which is all that the per-key step reads.  A key that
holds a third of the rows therefore sends one row per task and value, not its rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from keytally.sources.topics import READ_ORDER, read_order

VERSION = ["time", "partition", "offset"]  # as in ``topics.READ_ORDER``
ROW_SCHEMA = "key string, value string, time long, partition int, offset long"
STATE_SCHEMA = StructType([StructField("value", StringType()), StructField("time", LongType()),
                           StructField("partition", IntegerType()), StructField("offset", LongType())])
DELTA_SCHEMA = StructType([StructField("value", StringType(), True), StructField("delta", LongType(), True)])
HELD = 200_000  # reduced rows that a task holds before it hands them on


def newest_rows(pdf: pd.DataFrame) -> pd.DataFrame:
    """The newest row of each key and value (a null value is one), oldest first."""
    return pdf.sort_values(VERSION).drop_duplicates(["key", "value"], keep="last")


def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held = None
    for pdf in batches:
        held = newest_rows(pdf if held is None else pd.concat([held, pdf]))
        if len(held) > HELD:
            yield held
            held = None
    if held is not None and len(held):
        yield held


def versioned(records: DataFrame, key: str = "key", value: str = "value", order: str = "offset") -> DataFrame:
    """(key, value, time, partition, offset) of the records with a key and a place in
    the read order.  ``order`` is an offset column or a ``read_order`` struct."""
    place = (F.col(order) if isinstance(records.schema[order].dataType, StructType)
             else read_order(records, order)).cast(READ_ORDER)
    rows = records.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(value).alias("value"),
                                                         place.alias("_place"))
    return rows.where("_place.offset is not null").select("key", "value", "_place.*")


def newest_per_value(rows: DataFrame) -> DataFrame:
    """The rows of :func:`versioned` reduced within each task, before any shuffle."""
    return rows.mapInPandas(reduced, ROW_SCHEMA)


class CurrentValueProcessor(StatefulProcessor):
    """Per key: current (value, version); emits value deltas."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.current = handle.getValueState("current", STATE_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest, value, seen = None, None, set()
        for chunk in rows:
            if chunk.empty:
                continue
            last = chunk.sort_values(VERSION).iloc[-1]
            place = tuple(int(last[c]) for c in VERSION)
            if newest is None or place > newest:
                newest, value = place, None if pd.isna(last["value"]) else last["value"]
            seen.update(chunk["value"].dropna().unique())

        out: list[tuple[str, int]] = []
        stored = self.current.get()  # None when the key has no state yet
        held, version = (stored[0], tuple(stored[1:])) if stored is not None else (None, None)
        if newest is not None and (version is None or newest > version):
            if held != value:
                out += [(held, -1)] if held is not None else []
                out += [(value, 1)] if value is not None else []
            self.current.update((value, *newest))
        out += [(v, 0) for v in seen]
        if out:
            yield pd.DataFrame(out, columns=["value", "delta"])

    def close(self) -> None:
        pass


def current_value_deltas(records: DataFrame, key: str = "key", value: str = "value",
                         order: str = "offset") -> DataFrame:
    """Stream of (value, delta) from keyed records (null keys and offsets skipped).
    Records with a ``timestamp`` and a ``partition`` are ordered by them first.

    The query must start with the RocksDB state store provider
    (``keytally.session.ROCKSDB_PROVIDER``); the job starters set it.
    """
    # ship this module's code with the task: workers need not have the package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return newest_per_value(versioned(records, key, value, order)).groupBy("key").transformWithStateInPandas(
        statefulProcessor=CurrentValueProcessor(),
        outputStructType=DELTA_SCHEMA,
        outputMode="Append",
        timeMode="None",
    )
