"""Parsing ``key,value`` text lines (the colour analysis).

The reference keeps a line only if it *wholly* matches ``^[a-z]*,(red|white)$``
(Java ``String.matches``), then splits it at the comma into (key, value).
Spark's ``rlike`` searches instead of matching the whole string and its ``$``
also matches before a final newline, so the pattern is anchored with ``\\A`` and
``\\z`` here.  An empty key (``",white"``) is valid.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference's key pattern and its allowed colours.
KEY_PATTERN = "[a-z]*"
DEFAULT_VALUES = ("red", "white")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def full_match_pattern(allowed: Sequence[str] = DEFAULT_VALUES, key_pattern: str = KEY_PATTERN) -> str:
    """Regex that a whole line must match: ``<key_pattern>,(v1|v2|...)``."""
    alts = "|".join(re.escape(v) for v in allowed)
    return r"\A" + key_pattern + ",(" + alts + r")\z"


def matches_pair(line, allowed: Sequence[str] = DEFAULT_VALUES, key_pattern: str = KEY_PATTERN) -> Column:
    """True when the whole line is ``key,value`` with an allowed value (null for a null line)."""
    return _col(line).rlike(full_match_pattern(allowed, key_pattern))


def pair_key(line) -> Column:
    """Text before the first comma (``split(",")[0]``)."""
    return F.split_part(_col(line), F.lit(","), F.lit(1))


def pair_value(line) -> Column:
    """Text after the first comma up to the next one (``split(",")[1]``)."""
    return F.split_part(_col(line), F.lit(","), F.lit(2))
