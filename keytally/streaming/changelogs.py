"""Per-record changelogs as streams: one output row per input record, as the
reference emits with its record cache off (running balance, running summary,
running word count, and the ±1 updates of counts per current value).

One streaming query holds two branches over the same source:

* the records of the micro-batch, as they are;
* per key that the micro-batch touches, what was known of it before: the totals of
  earlier micro-batches, or its current value and version.  They live in Spark's own
  state store (RocksDB under the checkpoint; a streaming aggregate where all totals are
  sums, else ``transformWithStateInPandas``) and are fed by rows that each task has
  reduced to one per key (or key and value), so a hot key costs its task count, and a
  micro-batch reads and writes the state of its own keys only.

``foreachBatch`` then runs the batch operators of :mod:`keytally.operators.changelog`
(two-level, skew-safe) over the records, seeded with the second branch, and writes
``<base>/changelog/batch_id=<n>``.  A replayed micro-batch finds the state as it was
before it and overwrites its folder with the same rows, so the output is exactly once.

Across micro-batches totals follow arrival, as the reference processes records; within
one, the read order (topic time, partition, offset).  Current values follow the read
order throughout: a record older than the one that set its key's value changes nothing
and has no row, the same rule as for the counts of :mod:`.current_value`.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from keytally.functions.times import epoch_ntz
from keytally.operators import accounts, tables, wordcount
from keytally.operators.changelog import order_cuts, running
from keytally.session import ROCKSDB_PROVIDER, job_dir, session_conf
from keytally.sources.topics import read_order
from keytally.streaming import current_value
from keytally.streaming.current_value import VERSION, newest_per_value, versioned
from keytally.streaming.ownership import claim
from keytally.streaming.upsert import BATCH_COL

ORDER = [f"_at_{c}" for c in VERSION]
HELD = 200_000  # keys that a task totals before it hands them on


@dataclass
class ChangelogJob:
    query: StreamingQuery
    base: str
    schema: StructType

    def result(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(f"{self.base}/changelog").drop(BATCH_COL)

    def run_to_end(self, spark: SparkSession) -> DataFrame:
        self.query.awaitTermination()
        if self.query.exception() is not None:
            raise self.query.exception()
        return self.result(spark)


# --- totals of earlier micro-batches -------------------------------------------------------

def _folded(pdf: pd.DataFrame, key: str, kinds: dict[str, str]) -> pd.DataFrame:
    return pdf.groupby(key, sort=False, as_index=False).agg(kinds)


class EarlierTotals(StatefulProcessor):
    """Per key: emits its totals of earlier micro-batches, then adds this one's."""

    def __init__(self, key: str, kinds: dict[str, str]):
        self.key, self.kinds = key, kinds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", StructType([StructField(n, LongType()) for n in self.kinds]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        stored = self.totals.get()
        known = [pd.DataFrame([tuple(stored)], columns=list(self.kinds))] if stored is not None else []
        for chunk in rows:
            known = [pd.concat([*known, chunk[list(self.kinds)]]).agg(self.kinds).to_frame().T]
        self.totals.update(tuple(int(known[0].iloc[0][n]) for n in self.kinds))
        if stored is not None:
            yield pd.DataFrame({self.key: [key[0]], **{n: [int(v)] for n, v in zip(self.kinds, stored)}})

    def close(self) -> None:
        pass


def _only_sums(aggs: dict[str, tuple[str, str]]) -> bool:
    return all(kind == "sum" for kind, _ in aggs.values())


def with_totals(rows: DataFrame, key: str, aggs: dict[str, tuple[str, str]]) -> DataFrame:
    """The rows of each micro-batch (``_state`` 0) and what Spark's state knows of every
    key among them (``_state`` 1).

    Sums come from a streaming aggregate, with this micro-batch in them; they are taken
    back in :func:`earlier_totals`.  A maximum cannot be, so other aggregates come from
    :class:`EarlierTotals`, without this micro-batch."""
    if _only_sums(aggs):
        totals = rows.groupBy(key).agg(*[F.sum(F.col(c)).cast("long").alias(n) for n, (_, c) in aggs.items()])
        return rows.withColumn("_state", F.lit(0)).unionByName(
            totals.withColumn("_state", F.lit(1)), allowMissingColumns=True)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    kinds = {name: kind for name, (kind, _) in aggs.items()}
    schema = f"`{key}` string, " + ", ".join(f"{n} long" for n in kinds)

    def per_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            part = _folded(pdf, key, kinds)
            held = part if held is None else _folded(pd.concat([held, part]), key, kinds)
            if len(held) > HELD:
                yield held
                held = None
        if held is not None and len(held):
            yield held

    shares = rows.select(key, *[F.col(c).cast("long").alias(n) for n, (_, c) in aggs.items()])
    earlier = (shares.mapInPandas(per_task, schema).groupBy(key)
               .transformWithStateInPandas(EarlierTotals(key, kinds), schema, "Append", "None"))
    return rows.withColumn("_state", F.lit(0)).unionByName(
        earlier.withColumn("_state", F.lit(1)), allowMissingColumns=True)


def earlier_totals(batch: DataFrame, key: str, aggs: dict[str, tuple[str, str]]) -> DataFrame:
    """The totals of earlier micro-batches of the keys of this one."""
    known = batch.where("_state = 1").select(key, *aggs)
    if not _only_sums(aggs):
        return known
    own = batch.where("_state = 0").select(key, *[(-F.col(c)).cast("long").alias(n) for n, (_, c) in aggs.items()])
    return known.unionByName(own).groupBy(key).agg(*[F.sum(n).alias(n) for n in aggs])


def _ordered(records: DataFrame) -> DataFrame:
    """Records with their place in the read order as ``_at_time``, ``_at_partition``, ``_at_offset``."""
    place = read_order(records)
    return records.select("*", *[place.getField(c).alias(o) for c, o in zip(VERSION, ORDER)])


def _lead(rows: DataFrame) -> str:
    """The order column that the rows of one micro-batch are cut by: their time, or the
    offset where one time and partition is all there is."""
    first, last = rows.agg(*[f(F.struct("_at_time", "_at_partition")) for f in (F.min, F.max)]).first()
    return "_at_offset" if first == last else "_at_time"


class _RunningBatch:
    """``foreachBatch`` step: running aggregates of one micro-batch on top of the totals
    of earlier ones."""

    def __init__(self, base: str, key: str, order: list[str], aggs: dict[str, tuple[str, str]],
                 finish: Callable[[DataFrame], DataFrame], out_schema: StructType, extra_sink=None):
        self.base, self.key, self.order, self.aggs = base, key, order, aggs
        self.finish, self.out_schema, self.extra_sink = finish, out_schema, extra_sink

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read several times below; recomputed from the source if lost
        try:
            rows = batch.where("_state = 0").drop("_state", *self.aggs)
            out = running(rows, self.key, self.order, self.aggs, lead=_lead(rows),
                          initial=earlier_totals(batch, self.key, self.aggs))
            _write(self.finish(out), self.base, batch_id, self.out_schema, self.extra_sink)
        finally:
            batch.unpersist()


def _write(out: DataFrame, base: str, batch_id: int, schema: StructType, extra_sink) -> None:
    path = f"{base}/changelog/{BATCH_COL}={batch_id}"
    out.select(*schema.names).write.mode("overwrite").parquet(path)
    if extra_sink is not None:  # a topic, fed from the written rows
        extra_sink(out.sparkSession.read.schema(schema).parquet(path), batch_id)


def _start(df: DataFrame, step, base: str, job_name: str, available_now: bool, processing_time: str | None,
           fresh: bool, mode: str = "append") -> ChangelogJob:
    claim(df.sparkSession, f"{base}/changelog", f"{base}/checkpoint", BATCH_COL)
    w = (df.writeStream.queryName(f"{job_name}_{base.rsplit('/', 1)[-1]}" if fresh else job_name).outputMode(mode)
         .option("checkpointLocation", f"{base}/checkpoint").foreachBatch(step))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 second")
    with session_conf(df.sparkSession, {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER}):
        return ChangelogJob(w.start(), base, step.out_schema)


def _running_job(rows: DataFrame, key: str, order: list[str], aggs, finish, schema: str, job_name: str, *,
                 fresh: bool = False, available_now: bool = True, processing_time: str | None = None,
                 base: str | None = None, extra_sink=None) -> ChangelogJob:
    base = base or job_dir(rows.sparkSession, job_name, fresh=fresh)
    step = _RunningBatch(base, key, order, aggs, finish, StructType.fromDDL(schema), extra_sink)
    return _start(with_totals(rows, key, aggs), step, base, job_name, available_now, processing_time, fresh,
                  "update" if _only_sums(aggs) else "append")


def _place(records: DataFrame) -> str:
    """Further output columns that tell records of several partitions apart."""
    return ", partition int" if "partition" in records.columns else ""


def _kept(place: str) -> list[Column]:
    return [F.col("_at_partition").alias("partition")] if place else []


def running_summary_job(records: DataFrame, job_name: str = "running_summary", *, on_bad: str = "fail",
                        **kw) -> ChangelogJob:
    """JSON transactions -> (offset, name, count, balance, time) per transaction, and its
    ``partition`` where the records have one."""
    place = _place(records)
    tx = accounts.parse_transactions(_ordered(records), on_bad=on_bad, keep=ORDER)
    rows = tx.select("name", "amount", *ORDER, F.lit(1).cast("long").alias("_one"),
                     F.timestamp_diff("MICROSECOND", epoch_ntz(), F.col("time")).alias("_micros"))
    aggs = {"count": ("sum", "_one"), "balance": ("sum", "amount"), "latest": ("max", "_micros")}

    def finish(out):
        return out.select(F.col("_at_offset").alias("offset"), *_kept(place), "name", "count", "balance",
                          F.timestamp_add("MICROSECOND", F.greatest(F.lit(0), F.col("latest")), epoch_ntz()).alias("time"))

    return _running_job(rows, "name", ORDER, aggs, finish,
                        f"offset long{place}, name string, count long, balance long, time timestamp_ntz", job_name, **kw)


def running_balance_job(records: DataFrame, job_name: str = "running_balance", *, on_bad: str = "fail",
                        **kw) -> ChangelogJob:
    """JSON transactions -> (offset, name, balance) per transaction, and its ``partition``
    where the records have one."""
    place = _place(records)
    tx = accounts.parse_transactions(_ordered(records), on_bad=on_bad, need_time=False, keep=ORDER)

    def finish(out):
        return out.select(F.col("_at_offset").alias("offset"), *_kept(place), "name", "balance")

    return _running_job(tx.select("name", "amount", *ORDER), "name", ORDER, {"balance": ("sum", "amount")}, finish,
                        f"offset long{place}, name string, balance long", job_name, **kw)


def running_word_count_job(lines: DataFrame, job_name: str = "running_word_count", **kw) -> ChangelogJob:
    """Text lines -> (offset, pos, word, count) per word occurrence, and the line's
    ``partition`` where the records have one."""
    place = _place(lines)
    toks = wordcount.line_tokens(_ordered(lines), order="_at_offset", keep=ORDER[:2])
    rows = toks.withColumn("_one", F.lit(1).cast("long"))

    def finish(out):
        return out.select(F.col("_at_offset").alias("offset"), *_kept(place), "pos", "word", "count")

    return _running_job(rows, "word", [*ORDER, "pos"], {"count": ("sum", "_one")}, finish,
                        f"offset long{place}, pos long, word string, count long", job_name, **kw)


# --- current values ----------------------------------------------------------------------

class EarlierValue(StatefulProcessor):
    """Per key: emits its value and version of earlier micro-batches (kind ``key``) and
    how the counts of values change (kind ``value``), then keeps the newest value."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.current = handle.getValueState("current", current_value.STATE_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest, value, seen = None, None, set()
        stored = self.current.get()
        held, version = (stored[0], tuple(stored[1:])) if stored is not None else (None, None)
        for chunk in rows:
            for row in chunk.itertuples(index=False):
                place = tuple(int(getattr(row, c)) for c in VERSION)
                if version is not None and place <= version:
                    continue  # older than what is known: nothing changes
                own = None if pd.isna(row.value) else row.value
                seen.add(own)
                if newest is None or place > newest:
                    newest, value = place, own
        out = []
        if stored is not None:
            out.append(("key", key[0], held, 0, *version))
        if newest is not None:
            self.current.update((value, *newest))
            seen.add(held)
            out += [("value", v, None, (v == value) - (v == held), 0, 0, 0) for v in seen if v is not None]
        if out:
            yield pd.DataFrame(out, columns=["kind", "key", "held", "delta", *VERSION])

    def close(self) -> None:
        pass


class EarlierCount(StatefulProcessor):
    """Per value: emits its count before this micro-batch.  Rows of keys pass through."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", StructType([StructField("count", LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0] == "key":
            yield from (chunk[["kind", "key", "held", "delta", *VERSION]] for chunk in rows)
            return
        stored = self.count.get()
        before = int(stored[0]) if stored is not None else 0
        self.count.update((before + sum(int(chunk["delta"].sum()) for chunk in rows),))
        yield pd.DataFrame([("value", key[1], None, before, 0, 0, 0)],
                           columns=["kind", "key", "held", "delta", *VERSION])

    def close(self) -> None:
        pass


class _CurrentValueBatch:
    """``foreachBatch`` step of the current-value changelog: previous value per key and
    running count per value, both seeded with what was known before."""

    def __init__(self, base: str, out_schema: StructType, extra_sink=None):
        self.base, self.out_schema, self.extra_sink = base, out_schema, extra_sink

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            place = F.struct(*VERSION)
            known = (batch.where("kind = 'key'").select("key", F.col("held").alias("value"), place.alias("_known")))
            rows = batch.where("kind = 'row'").select("key", "value", *VERSION, place.alias("_place"))
            # one row a key on the right: a hot key's rows are split by the join as they are
            rows = (rows.join(known.select("key", "_known"), "key", "left")
                    .where("_known is null or _place > _known").drop("_known", "_place"))
            counts = batch.where("kind = 'value'").select(F.col("key").alias("value"), F.col("delta").alias("count"))
            rows = rows.select("key", "value", *[F.col(c).alias(o) for c, o in zip(VERSION, ORDER)])
            lead = _lead(rows)
            log = tables.current_value_changelog(rows, order=ORDER, lead=lead, bounds=order_cuts(rows, lead),
                                                 initial_values=known.drop("_known"), initial_counts=counts)
            out = log.select(F.col("_at_offset").alias("offset"), F.col("_at_partition").alias("partition"), "step",
                             "value", "count")
            _write(out, self.base, batch_id, self.out_schema, self.extra_sink)
        finally:
            batch.unpersist()


def current_value_changelog_job(records: DataFrame, job_name: str = "current_value_changelog", *,
                                fresh: bool = False, available_now: bool = True,
                                processing_time: str | None = None, base: str | None = None,
                                extra_sink=None) -> ChangelogJob:
    """(key, value) records -> (offset, step, value, count): for each record the
    old value losing one (step 0) and the new value gaining one (step 1); a null
    value deletes its key.  A record older than its key's current value has no row.
    Records of several partitions also have their ``partition``."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    cloudpickle.register_pickle_by_value(current_value)
    base = base or job_dir(records.sparkSession, job_name, fresh=fresh)
    out_schema = StructType.fromDDL(f"offset long{_place(records)}, step int, value string, count long")
    rows = versioned(records)
    schema = "kind string, key string, held string, delta long, time long, partition int, offset long"
    changes = (newest_per_value(rows).groupBy("key")
               .transformWithStateInPandas(EarlierValue(), schema, "Append", "None"))
    known = changes.groupBy("kind", "key").transformWithStateInPandas(EarlierCount(), schema, "Append", "None")
    both = rows.withColumn("kind", F.lit("row")).unionByName(known, allowMissingColumns=True)
    step = _CurrentValueBatch(base, out_schema, extra_sink)
    return _start(both, step, base, job_name, available_now, processing_time, fresh)
