"""keytally: keyed event analytics on Spark.

Word counts over text, the latest value per key with deletes, counts of keys
per current value, running balances and account summaries -- each as a batch
query, as a per-record changelog and as a Structured Streaming job.

The operators are plain DataFrame -> DataFrame functions over records with
``key``, ``value`` and ``offset`` (read order) columns; they work on batch and,
where Spark allows, on streaming DataFrames.
"""

from keytally.operators.accounts import (balances, bad_transactions, parse_transactions, running_balances,
                                         running_summaries, summaries)
from keytally.operators.changelog import previous_value, running
from keytally.operators.pairs import split_pairs
from keytally.operators.tables import count_by_current_value, current_value_changelog, latest_by_key
from keytally.operators.wordcount import line_tokens, running_word_count, word_count

__version__ = "0.1.0"

__all__ = [
    "balances", "bad_transactions", "parse_transactions", "running_balances", "running_summaries", "summaries",
    "previous_value", "running", "split_pairs", "count_by_current_value", "current_value_changelog",
    "latest_by_key", "line_tokens", "running_word_count", "word_count",
]
