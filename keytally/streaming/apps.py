"""The reference's applications as long-running Structured Streaming jobs.

    python -m keytally.streaming.apps word-count \\
        --bootstrap-servers host:9092 --input-topic text-lines \\
        --output-topic word-counts

    python -m keytally.streaming.apps colour-count --input-path /data/colours --output-path /data/out

Applications: ``word-count``, ``colour-count``, ``balance``, ``summary`` and
``publish-transactions`` (the rows of any table, by ``--name-column``, ``--amount-column``
and ``--time-column``, or ready-made records -> keyed JSON on a topic).  The
``*-log`` forms (``word-count-log``, ``colour-count-log``, ``balance-log``,
``summary-log``) emit one update per input record, as the reference does with its record cache off; their
output folder holds ``changelog/`` and the running ``totals/``.

Input: a Kafka topic (``--bootstrap-servers`` + ``--input-topic``; the connector
must be on the classpath -- unverified in this build's container) or a folder
of record files (``--input-path``: parquet with ``key, value, offset`` columns
and, for several partitions, ``partition`` and ``timestamp``, or ``--input-format text`` for plain text lines, word count only).

Output: a Kafka topic (``--output-topic``; values as the reference's serdes
write them: 8-byte longs or JSON; at-least-once, each record with its batch and row id in
the headers, so repeats can be told) and/or an upsert table (``--output-path``; exactly
once per micro-batch, and refused if another checkpoint filled it).  Progress lives in
``--checkpoint`` (default: ``<spark.checkpoint.dir>/<app name>``); a restart
resumes there, and ``earliest`` applies only to a new checkpoint.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from keytally.functions.records import summary_json
from keytally.functions.times import utc_wallclock
from keytally.operators import accounts, wordcount
from keytally.operators.pairs import split_pairs
from keytally.session import ROCKSDB_PROVIDER, checkpoint_root, session_conf
from keytally.sources import sinks, topics
from keytally.streaming.ownership import claim
from keytally.streaming.upsert import UpsertSink

RECORD_SCHEMA = "key string, value string, offset long, partition int, timestamp timestamp"

# Default job identities (query name and checkpoint folder); --application-id
# overrides them.  Two jobs with the same id share their progress.
DEFAULT_IDS = {
    "word-count": "word-count",
    "colour-count": "colour-count",
    "balance": "balance",
    "summary": "summary",
    "publish-transactions": "publish-transactions",
    "word-count-log": "word-count-log",
    "balance-log": "balance-log",
    "summary-log": "summary-log",
    "colour-count-log": "colour-count-log",
}


# Producer settings of the reference's publisher.
PRODUCER = {"kafka.acks": "all", "kafka.enable.idempotence": "true"}


def read_input(spark: SparkSession, args) -> DataFrame:
    if args.input_topic:
        opts = {"maxOffsetsPerTrigger": str(args.max_offsets_per_trigger)} if args.max_offsets_per_trigger else {}
        recs = topics.read_topic(spark, args.input_topic, args.bootstrap_servers,
                                 starting_offsets=args.starting_offsets, options=opts)
        return recs.select("key", "value", "offset", "partition", "timestamp")
    reader = spark.readStream
    if args.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(args.max_files_per_trigger))
    if args.input_format == "text":
        lines = reader.text(args.input_path)
        return lines.select(F.lit(None).cast("string").alias("key"), F.col("value"),
                            F.lit(None).cast("long").alias("offset"))
    reader = reader.option("recursiveFileLookup", "true")
    if args.name_column:  # a table of any columns, published as transactions
        schema = spark.read.option("recursiveFileLookup", "true").parquet(args.input_path).schema
        return published(reader.schema(schema).parquet(args.input_path), args)
    return reader.schema(RECORD_SCHEMA).parquet(args.input_path)


def published(table: DataFrame, args) -> DataFrame:
    """The rows of a table as keyed JSON transactions, by the columns that are named."""
    time = F.col(args.time_column)
    if isinstance(table.schema[args.time_column].dataType, TimestampType):
        time = utc_wallclock(time)
    return topics.published_transactions(table, F.col(args.name_column), F.col(args.amount_column).cast("long"), time)


def build(app: str, recs: DataFrame, allowed: Sequence[str], on_bad: str = "fail") -> tuple[DataFrame, list[str]]:
    """(result changelog, its key columns) for one application."""
    if app == "word-count":
        return wordcount.word_count(recs), ["word"]
    if app == "colour-count":
        from keytally.streaming.current_value import current_value_deltas
        pairs = split_pairs(recs, allowed=allowed)
        return current_value_deltas(pairs).groupBy("value").agg(F.sum("delta").alias("count")), ["value"]
    if app == "balance":
        return accounts.balances(accounts.parse_transactions(recs, on_bad=on_bad, need_time=False)), ["name"]
    if app == "summary":
        return accounts.summaries(accounts.parse_transactions(recs, on_bad=on_bad)), ["name"]
    if app == "publish-transactions":
        return recs.select("key", "value"), ["key"]
    raise ValueError(f"unknown application {app!r}")


def start_log(spark: SparkSession, args, app_id: str, recs: DataFrame):
    """The per-record changelog applications (see :mod:`.changelogs`)."""
    from keytally.streaming import changelogs
    base = args.output_path or args.checkpoint or f"{checkpoint_root(spark).rstrip('/')}/{app_id}"
    extra = None
    if args.output_topic:
        enc = {"word-count-log": lambda b: sinks.long_records(b, "word", "count"),
               "colour-count-log": lambda b: sinks.long_records(b, "value", "count"),
               "balance-log": lambda b: sinks.long_records(b, "name", "balance"),
               "summary-log": lambda b: sinks.json_records(b, "name", summary_json("count", "balance", "time"))}[args.app]

        def extra(batch: DataFrame, batch_id: int) -> None:
            sinks.write_topic(sinks.identified(enc(batch), batch_id), args.output_topic, args.bootstrap_servers,
                              options=PRODUCER)
    kw = dict(job_name=app_id, base=base, extra_sink=extra, available_now=args.available_now,
              processing_time=args.trigger)
    if args.app == "word-count-log":
        return changelogs.running_word_count_job(recs, **kw).query
    if args.app == "colour-count-log":
        pairs = split_pairs(recs, allowed=tuple(args.allowed.split(",")))
        return changelogs.current_value_changelog_job(pairs, **kw).query
    on_bad = "drop" if args.on_bad == "quarantine" else args.on_bad
    if args.on_bad == "quarantine":
        _quarantine(recs, app_id, args)
    if args.app == "balance-log":
        return changelogs.running_balance_job(recs, on_bad=on_bad, **kw).query
    return changelogs.running_summary_job(recs, on_bad=on_bad, **kw).query


def _quarantine(recs: DataFrame, app_id: str, args):
    """A second query that keeps the bad records (see :func:`.jobs.quarantine_job`)."""
    from keytally.streaming.jobs import quarantine_job
    return quarantine_job(recs, app_id, available_now=args.available_now, processing_time=args.trigger,
                          base=args.quarantine_path)


def start(spark: SparkSession, args):
    app_id = args.application_id or DEFAULT_IDS[args.app]
    ckpt = args.checkpoint or f"{checkpoint_root(spark).rstrip('/')}/{app_id}"
    recs = read_input(spark, args)
    if args.app.endswith("-log"):
        return start_log(spark, args, app_id, recs)
    quarantine = args.on_bad == "quarantine" and args.app in ("balance", "summary")
    out, keys = build(args.app, recs, tuple(args.allowed.split(",")), "drop" if quarantine else args.on_bad)
    if quarantine:
        _quarantine(recs, app_id, args)
    log = args.app == "publish-transactions"
    # published records are a log: every batch is kept, none is folded by key.  With a topic
    # alone the batches are still written, under the checkpoint, and the topic is fed from
    # there: a micro-batch runs its plan once, and a replay sends the same records
    folder = args.output_path or f"{ckpt}/outbox"
    claim(spark, folder, f"{ckpt}/checkpoint")
    sink = UpsertSink(folder) if log or not args.output_path else UpsertSink(folder, out.schema, keys)
    mode, schema = "append" if log else "update", out.schema

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        sink(batch, batch_id)  # on a replay too: running the plan is what commits its state
        if args.output_topic:
            rows = sink.batch(batch.sparkSession, schema, batch_id)
            records = rows if log else build_records(args.app, rows)
            sinks.write_topic(sinks.identified(records, batch_id), args.output_topic, args.bootstrap_servers,
                              options=PRODUCER)

    w = (out.writeStream.queryName(app_id).outputMode(mode).option("checkpointLocation", f"{ckpt}/checkpoint")
         .foreachBatch(each_batch))
    w = w.trigger(availableNow=True) if args.available_now else w.trigger(processingTime=args.trigger)
    # state in RocksDB for every stateful application (required by the colour count)
    with session_conf(spark, {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER}):
        return w.start()


def build_records(app: str, batch: DataFrame) -> DataFrame:
    if app == "word-count":
        return sinks.long_records(batch, "word", "count")
    if app == "colour-count":
        return sinks.long_records(batch, "value", "count")
    if app == "balance":
        return sinks.long_records(batch, "name", "balance")
    if app == "summary":
        return sinks.json_records(batch, "name", summary_json("count", "balance", "time"))
    raise ValueError(app)


def parse_args(argv=None):
    p = argparse.ArgumentParser(prog="keytally.streaming.apps", description=__doc__.split("\n\n")[0])
    p.add_argument("app", choices=sorted(DEFAULT_IDS))
    p.add_argument("--application-id")
    p.add_argument("--bootstrap-servers")
    p.add_argument("--input-topic")
    p.add_argument("--input-path")
    p.add_argument("--input-format", choices=["records", "text"], default="records")
    p.add_argument("--output-topic")
    p.add_argument("--output-path")
    p.add_argument("--checkpoint")
    p.add_argument("--starting-offsets", default="earliest")
    p.add_argument("--allowed", default="red,white", help="colour-count: allowed values")
    p.add_argument("--max-files-per-trigger", type=int, help="folder input: files per micro-batch")
    p.add_argument("--max-offsets-per-trigger", type=int, help="Kafka input: records per micro-batch")
    p.add_argument("--trigger", default="1 second", help="processing-time trigger interval")
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    p.add_argument("--on-bad", choices=["fail", "drop", "quarantine"], default="fail",
                   help="balance/summary: bad transactions stop the job, are skipped, or are kept aside")
    p.add_argument("--name-column", help="publish-transactions: the account column of the input table")
    p.add_argument("--amount-column", help="publish-transactions: its amount column (whole numbers)")
    p.add_argument("--time-column", help="publish-transactions: its time column")
    p.add_argument("--quarantine-path", help="folder of the bad transactions kept aside, with their checkpoint")
    a = p.parse_args(argv)
    if a.app.endswith("-log") and a.input_path and a.input_format == "text":
        p.error("text lines have no read order: the -log applications need records with an offset")
    named = [a.name_column, a.amount_column, a.time_column]
    if any(named) and not (all(named) and a.app == "publish-transactions" and a.input_path):
        p.error("--name-column, --amount-column and --time-column go together, with publish-transactions "
                "and --input-path")
    if not (a.input_topic or a.input_path):
        p.error("give --input-topic or --input-path")
    if not (a.output_topic or a.output_path):
        p.error("give --output-topic or --output-path")
    if (a.input_topic or a.output_topic) and not a.bootstrap_servers:
        p.error("Kafka topics need --bootstrap-servers")
    return a


def wait_for_all(spark: SparkSession) -> None:
    """Until every running query has ended; the first that fails raises here."""
    started = spark.streams.active
    while spark.streams.active:
        spark.streams.awaitAnyTermination()
        spark.streams.resetTerminated()
    for query in started:
        if query.exception() is not None:
            raise query.exception()


def main(argv=None) -> None:
    args = parse_args(argv)
    spark = SparkSession.builder.appName(args.application_id or DEFAULT_IDS[args.app]).getOrCreate()
    start(spark, args)
    wait_for_all(spark)


if __name__ == "__main__":
    main()
