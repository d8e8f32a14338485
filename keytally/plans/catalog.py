"""Named batch queries over the driver's tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame; nothing is
collected.  The tables stand in for the reference's topics (see
``keytally.sources.topics``):

* text lines        <- ``documents`` (value = text, read order = doc_id)
* colour lines      <- ``events`` (``<user letters>,<event_type>``; values click, view)
* transactions      <- ``events`` published as JSON records (name = user_id)
* keyed with deletes <- ``events`` (value = event_type, ``error`` = tombstone)
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keytally.functions.records import summary_json
from keytally.operators import accounts, tables, wordcount
from keytally.operators.changelog import order_cuts
from keytally.operators.pairs import split_pairs
from keytally.sources import sinks, topics

# The colour stand-in's allowed values (event types).
COLOUR_VALUES = ("click", "view")


def _table(spark, sf_dir, name):
    return topics.read_table(spark, sf_dir, name, topics.small_table_parallelism(spark, sf_dir, name))


def _events(spark, sf_dir):
    return _table(spark, sf_dir, "events")


def _documents(spark, sf_dir):
    return _table(spark, sf_dir, "documents")


def _lines(spark, sf_dir):
    return topics.text_lines(_documents(spark, sf_dir))


def _pairs(spark, sf_dir):
    return split_pairs(topics.colour_lines(_events(spark, sf_dir)), allowed=COLOUR_VALUES)


def _transactions(spark, sf_dir, need_time=True):
    return accounts.parse_transactions(topics.transaction_records(_events(spark, sf_dir)), need_time=need_time)


def _event_cuts(spark, sf_dir):
    # of the plain table: nothing is dealt or parsed to read one column
    return order_cuts(topics.read_table(spark, sf_dir, "events"), "event_id")


# --- text --------------------------------------------------------------------------------

def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordcount.word_count(_lines(spark, sf_dir))


def line_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordcount.line_tokens(_lines(spark, sf_dir)).withColumnRenamed("offset", "doc_id")


def running_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    # of the plain table: the lines are dealt by bucket anyway
    out = wordcount.running_word_count(topics.text_lines(topics.read_table(spark, sf_dir, "documents")))
    return out.withColumnRenamed("offset", "doc_id")


def word_count_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts as the output topic: key = word, value = 8-byte long (hex shown)."""
    return sinks.long_records(word_count(spark, sf_dir), "word", "count", encoding="hex")


# --- colours: pairs, latest value, current-value counts -------------------------------------

def pair_filter_rekey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select(F.col("offset").alias("event_id"), "key",
                                         F.col("value").alias("colour"))


def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.latest_by_key(_pairs(spark, sf_dir)).withColumnRenamed("value", "colour")


def latest_with_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.latest_by_key(topics.tombstone_records(_events(spark, sf_dir)), deletes=True)


def current_value_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.count_by_current_value(_pairs(spark, sf_dir)).withColumnRenamed("value", "colour")


def current_value_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tables.current_value_changelog(_pairs(spark, sf_dir), bounds=_event_cuts(spark, sf_dir))
    return out.select(F.col("offset").alias("event_id"), "step", F.col("value").alias("colour"), "count")


def changelog_with_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog over keyed records with tombstones (a delete takes one away)."""
    recs = topics.tombstone_records(_events(spark, sf_dir))
    out = tables.current_value_changelog(recs, bounds=_event_cuts(spark, sf_dir))
    return out.select(F.col("offset").alias("event_id"), "step", "value", "count")


def colour_count_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.long_records(current_value_count(spark, sf_dir), "colour", "count", encoding="hex")


# --- accounts ---------------------------------------------------------------------------

def transaction_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.transaction_records(_events(spark, sf_dir)).withColumnRenamed("offset", "event_id")


def bad_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = accounts.bad_transactions(topics.faulty_transaction_records(_events(spark, sf_dir)))
    return out.withColumnRenamed("offset", "event_id")


def account_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounts.balances(_transactions(spark, sf_dir, need_time=False))


def account_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounts.summaries(_transactions(spark, sf_dir))


def running_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = accounts.running_balances(_transactions(spark, sf_dir, need_time=False), bounds=_event_cuts(spark, sf_dir))
    return out.withColumnRenamed("offset", "event_id")


def running_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = accounts.running_summaries(_transactions(spark, sf_dir), bounds=_event_cuts(spark, sf_dir))
    return out.withColumnRenamed("offset", "event_id")


def count_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances as the output topic: key = name, value = 8-byte long (hex shown)."""
    return sinks.long_records(account_balance(spark, sf_dir), "name", "balance", encoding="hex")


def summary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = account_summary(spark, sf_dir)
    return sinks.json_records(s, "name", summary_json("count", "balance", "time"))


BATCH_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "word_count": word_count,
    "line_tokens": line_tokens,
    "running_word_count": running_word_count,
    "word_count_records": word_count_records,
    "pair_filter_rekey": pair_filter_rekey,
    "latest_by_key": latest_by_key,
    "latest_with_deletes": latest_with_deletes,
    "current_value_count": current_value_count,
    "current_value_changelog": current_value_changelog,
    "changelog_with_deletes": changelog_with_deletes,
    "colour_count_records": colour_count_records,
    "transaction_records": transaction_records,
    "bad_transactions": bad_transactions,
    "account_balance": account_balance,
    "account_summary": account_summary,
    "running_balance": running_balance,
    "running_summary": running_summary,
    "count_records": count_records,
    "summary_records": summary_records,
}
