"""Structured Streaming jobs: the reference's three applications as streams.

A job is: a record stream (Kafka or files) -> the same DataFrame transforms the
batch queries use -> ``outputMode("update")`` (the table's changelog: one row
per changed key per micro-batch) -> the upsert table of :mod:`.upsert`.

* Identity and progress: ``queryName`` plus one stable checkpoint folder per
  job under ``spark.checkpoint.dir`` (:func:`keytally.session.job_dir`).  A
  restart on the same folder resumes exactly where the last committed batch
  ended; the source's ``earliest`` start applies only to a new checkpoint.
* State: the aggregates keep their per-key state in the RocksDB state store
  under the checkpoint -- exactly-once state with a replayable source.  No watermark: every record counts however old, as in the reference.
* Output: the upsert table is idempotent per batch id, so output is exactly
  once too.  The Kafka sink (``sources.sinks.write_topic``) is at-least-once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from keytally.operators import accounts, tables, wordcount
from keytally.session import ROCKSDB_PROVIDER, job_dir, session_conf
from keytally.sources.topics import read_order
from keytally.streaming.ownership import claim
from keytally.streaming.upsert import DEFAULT_COMPACT_EVERY, UpsertSink, read_upsert


@dataclass
class StreamJob:
    """A started job and where its result table lives."""
    query: StreamingQuery
    result_path: str
    checkpoint: str
    schema: StructType
    keys: tuple[str, ...]

    def result(self, spark: SparkSession) -> DataFrame:
        return read_upsert(spark, self.result_path, self.schema, self.keys)

    def run_to_end(self, spark: SparkSession, timeout_s: float | None = None) -> DataFrame:
        """Wait for an ``availableNow`` run to finish and return the table."""
        if timeout_s is None:
            self.query.awaitTermination()
        else:
            self.query.awaitTermination(timeout_s)
        if self.query.isActive:
            self.query.stop()
            raise TimeoutError(f"stream {self.query.name} did not finish")
        if self.query.exception() is not None:
            raise self.query.exception()
        return self.result(spark)


def start_upsert(df: DataFrame, keys, job_name: str, *, fresh: bool = False, available_now: bool = True,
                 processing_time: str | None = None, output_mode: str = "update",
                 state_partitions: int | None = None, conf: dict[str, str] | None = None,
                 compact_every: int = DEFAULT_COMPACT_EVERY) -> StreamJob:
    """Start ``df`` (a streaming aggregate or changelog) into an upsert table.

    ``fresh=False`` reuses the job's stable folder (restartable job);
    ``fresh=True`` runs in a new folder (a one-shot run over a table).
    ``state_partitions`` fixes the number of state-store partitions of a *new*
    checkpoint (a restart keeps the checkpoint's own); default: the session's
    ``spark.sql.shuffle.partitions``.  The query runs on a clone of the session
    taken at start, so the setting does not leak into the caller's session.
    """
    spark = df.sparkSession
    base = job_dir(spark, job_name, fresh=fresh)
    ckpt, out = f"{base}/checkpoint", f"{base}/table"
    claim(spark, out, ckpt)
    w = (df.writeStream.queryName(f"{job_name}_{base.rsplit('/', 1)[-1]}" if fresh else job_name)
         .outputMode(output_mode)
         .option("checkpointLocation", ckpt)
         .foreachBatch(UpsertSink(out, df.schema, [keys] if isinstance(keys, str) else list(keys),
                                  compact_every=compact_every)))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    # state in RocksDB whatever the session says: it spills to disk, the default
    # provider keeps every key in the executors' heap
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER, **(conf or {})}
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    with session_conf(spark, settings):
        q = w.start()
    return StreamJob(q, out, ckpt, df.schema, tuple([keys] if isinstance(keys, str) else keys))


# --- the three applications -------------------------------------------------------------

def word_count_job(lines: DataFrame, job_name: str = "word_count", **kw) -> StreamJob:
    """Text lines -> running word counts (word, count)."""
    return start_upsert(wordcount.word_count(lines), ["word"], job_name, **kw)


def latest_by_key_job(records: DataFrame, job_name: str = "latest_by_key", **kw) -> StreamJob:
    """Keyed records -> table of the latest value per key; a null value deletes.

    The aggregate emits tombstone rows (value null) so the upsert table sees
    the delete; reading the table drops them.  Records with a ``timestamp`` and a
    ``partition`` are ordered by them first (:func:`keytally.sources.topics.read_order`).
    """
    placed = records.withColumn("_place", read_order(records))
    return start_upsert(tables.latest_by_key(placed, order="_place", deletes=False), ["key"], job_name, **kw)


def quarantine_job(records: DataFrame, job_name: str, *, fresh: bool = False, available_now: bool = True,
                   processing_time: str | None = None, base: str | None = None) -> tuple[StreamingQuery, str]:
    """Bad transactions (offset, key, value, reason) appended to a side table.

    A second query over the same source with its own checkpoint: the aggregate
    skips bad records (``on_bad="drop"``) and this one keeps them, each exactly
    once (file sink with its own commit log).  ``base`` names its folder (default:
    one under the shared root).  Returns (query, table path).
    """
    spark = records.sparkSession
    base = (base or job_dir(spark, job_name + "_quarantine", fresh=fresh)).rstrip("/")
    w = (accounts.bad_transactions(records).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", f"{base}/checkpoint").option("path", f"{base}/table"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 second")
    return w.start(), f"{base}/table"


def _parsed(records: DataFrame, on_bad: str, need_time: bool = True) -> DataFrame:
    return accounts.parse_transactions(records, on_bad="drop" if on_bad == "quarantine" else on_bad,
                                       need_time=need_time)


def account_balance_job(records: DataFrame, job_name: str = "account_balance", on_bad: str = "fail",
                        **kw) -> StreamJob:
    """JSON transactions -> (name, balance).  ``on_bad``: fail, drop or
    quarantine (start :func:`quarantine_job` next to it)."""
    return start_upsert(accounts.balances(_parsed(records, on_bad, need_time=False)), ["name"], job_name, **kw)


def account_summary_job(records: DataFrame, job_name: str = "account_summary", on_bad: str = "fail",
                        **kw) -> StreamJob:
    """JSON transactions -> (name, count, balance, time).  ``on_bad`` as above."""
    return start_upsert(accounts.summaries(_parsed(records, on_bad)), ["name"], job_name, **kw)


def current_value_count_job(records: DataFrame, job_name: str = "current_value_count", **kw) -> StreamJob:
    """(key, value) records -> (value, count) of keys holding each value now."""
    from keytally.streaming.current_value import current_value_deltas
    deltas = current_value_deltas(records)
    counts = deltas.groupBy("value").agg(F.sum("delta").alias("count"))
    return start_upsert(counts, ["value"], job_name, **kw)
