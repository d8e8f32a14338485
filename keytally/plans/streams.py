"""Named streaming queries over the driver's tables.

Each reads a table folder as a file stream, runs the job to the end of the
available data (``availableNow``) into a fresh upsert table under
``spark.checkpoint.dir`` and returns that table read back.  The final table
equals the batch answer, so the oracle is the batch query's SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keytally.operators.pairs import split_pairs
from keytally.plans.catalog import COLOUR_VALUES
from keytally.plans.oracle import ORACLE_SQL
from keytally.sources import topics
from keytally.streaming import changelogs, jobs

# input bytes per state partition for a one-shot run over a table
BYTES_PER_STATE_PARTITION = 128 * 1024 * 1024


def _state_partitions(spark: SparkSession, sf_dir: str, name: str) -> int:
    """State partitions for a one-shot run: enough for the table's size, at
    least twice the cores, never more than the session's shuffle partitions."""
    size = topics.path_bytes(spark, topics.table_path(spark, sf_dir, name)[0])
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(2 * spark.sparkContext.defaultParallelism, -(-size // BYTES_PER_STATE_PARTITION))
    return min(configured, wanted)


def stream_word_count(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    lines = topics.text_lines(topics.read_table_stream(spark, sf_dir, "documents", max_files_per_trigger))
    return jobs.word_count_job(lines, "stream_word_count", fresh=True,
                               state_partitions=_state_partitions(spark, sf_dir, "documents")).run_to_end(spark)


def stream_latest_by_key(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    events = topics.read_table_stream(spark, sf_dir, "events", max_files_per_trigger)
    pairs = split_pairs(topics.colour_lines(events), allowed=COLOUR_VALUES)
    out = jobs.latest_by_key_job(pairs, "stream_latest_by_key", fresh=True,
            state_partitions=_state_partitions(spark, sf_dir, "events")).run_to_end(spark)
    return out.withColumnRenamed("value", "colour")


def stream_latest_with_deletes(spark: SparkSession, sf_dir: str,
                               max_files_per_trigger: int | None = None) -> DataFrame:
    events = topics.read_table_stream(spark, sf_dir, "events", max_files_per_trigger)
    recs = topics.tombstone_records(events)
    return jobs.latest_by_key_job(recs, "stream_latest_with_deletes", fresh=True,
            state_partitions=_state_partitions(spark, sf_dir, "events")).run_to_end(spark)


def stream_account_balance(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    events = topics.read_table_stream(spark, sf_dir, "events", max_files_per_trigger)
    recs = topics.transaction_records(events)
    return jobs.account_balance_job(recs, "stream_account_balance", fresh=True,
            state_partitions=_state_partitions(spark, sf_dir, "events")).run_to_end(spark)


def stream_account_summary(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    events = topics.read_table_stream(spark, sf_dir, "events", max_files_per_trigger)
    recs = topics.transaction_records(events)
    return jobs.account_summary_job(recs, "stream_account_summary", fresh=True,
            state_partitions=_state_partitions(spark, sf_dir, "events")).run_to_end(spark)


def stream_current_value_count(spark: SparkSession, sf_dir: str,
                               max_files_per_trigger: int | None = None) -> DataFrame:
    events = topics.read_table_stream(spark, sf_dir, "events", max_files_per_trigger)
    pairs = split_pairs(topics.colour_lines(events), allowed=COLOUR_VALUES)
    out = jobs.current_value_count_job(pairs, "stream_current_value_count", fresh=True,
            state_partitions=_state_partitions(spark, sf_dir, "events")).run_to_end(spark)
    return out.select(F.col("value").alias("colour"), "count")


def stream_running_summary(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    events = topics.read_table_stream(spark, sf_dir, "events", max_files_per_trigger)
    out = changelogs.running_summary_job(topics.transaction_records(events), "stream_running_summary",
                                         fresh=True).run_to_end(spark)
    return out.withColumnRenamed("offset", "event_id")


def stream_running_balance(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    events = topics.read_table_stream(spark, sf_dir, "events", max_files_per_trigger)
    out = changelogs.running_balance_job(topics.transaction_records(events), "stream_running_balance",
                                         fresh=True).run_to_end(spark)
    return out.withColumnRenamed("offset", "event_id")


def stream_running_word_count(spark: SparkSession, sf_dir: str,
                              max_files_per_trigger: int | None = None) -> DataFrame:
    docs = topics.read_table_stream(spark, sf_dir, "documents", max_files_per_trigger)
    out = changelogs.running_word_count_job(topics.text_lines(docs), "stream_running_word_count",
                                            fresh=True).run_to_end(spark)
    return out.withColumnRenamed("offset", "doc_id")


def stream_current_value_changelog(spark: SparkSession, sf_dir: str,
                                   max_files_per_trigger: int | None = None) -> DataFrame:
    events = topics.read_table_stream(spark, sf_dir, "events", max_files_per_trigger)
    pairs = split_pairs(topics.colour_lines(events), allowed=COLOUR_VALUES)
    out = changelogs.current_value_changelog_job(pairs, "stream_current_value_changelog",
                                                 fresh=True).run_to_end(spark)
    return out.select(F.col("offset").alias("event_id"), "step", F.col("value").alias("colour"), "count")


STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_word_count": stream_word_count,
    "stream_latest_by_key": stream_latest_by_key,
    "stream_latest_with_deletes": stream_latest_with_deletes,
    "stream_account_balance": stream_account_balance,
    "stream_account_summary": stream_account_summary,
    "stream_current_value_count": stream_current_value_count,
    "stream_running_summary": stream_running_summary,
    "stream_running_balance": stream_running_balance,
    "stream_running_word_count": stream_running_word_count,
    "stream_current_value_changelog": stream_current_value_changelog,
}

STREAM_ORACLE: dict[str, str] = {
    "stream_word_count": ORACLE_SQL["word_count"],
    "stream_latest_by_key": ORACLE_SQL["latest_by_key"],
    "stream_latest_with_deletes": ORACLE_SQL["latest_with_deletes"],
    "stream_account_balance": ORACLE_SQL["account_balance"],
    "stream_account_summary": ORACLE_SQL["account_summary"],
    "stream_current_value_count": ORACLE_SQL["current_value_count"],
    "stream_running_summary": ORACLE_SQL["running_summary"],
    "stream_running_balance": ORACLE_SQL["running_balance"],
    "stream_running_word_count": ORACLE_SQL["running_word_count"],
    "stream_current_value_changelog": ORACLE_SQL["current_value_changelog"],
}
