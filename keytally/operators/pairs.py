"""Keyed records from ``key,value`` text lines (the colour analysis's first steps).

Filter on a whole-line match, then re-key: a projection, no explode and no
shuffle.  The regex cannot reach the parquet scan, but column pruning does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keytally.functions.pairs import DEFAULT_VALUES, KEY_PATTERN, matches_pair, pair_key, pair_value


def split_pairs(lines: DataFrame, value: str = "value", order: str = "offset",
                allowed: Sequence[str] = DEFAULT_VALUES, key_pattern: str = KEY_PATTERN) -> DataFrame:
    """(offset, key, value) for the lines that are ``key,value`` with an allowed value.

    A null line never matches (the reference would throw on it; here it is
    simply not a pair).  The ``partition`` and ``timestamp`` of topic records are kept,
    so the pairs still know their read order.
    """
    line = F.col(value)
    kept = [c for c in ("partition", "timestamp") if c in lines.columns]
    return (lines.where(matches_pair(line, allowed, key_pattern))
            .select(F.col(order).alias("offset"), pair_key(line).alias("key"), pair_value(line).alias("value"), *kept))
