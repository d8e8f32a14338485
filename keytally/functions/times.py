"""ISO-8601 instants as the reference reads and writes them.

* Parsing follows ``Instant.parse``: a date, ``T``, a time with seconds, an
  optional fraction and a zone (``Z`` or ``+hh:mm``).  Spark's own parser is
  more lenient (it takes ``2024-01-01`` or a space instead of ``T``), so a
  format guard runs first and ``try_to_timestamp`` second.
* Rendering follows ``Instant.toString``: the fraction is printed with 0, 3
  or 6 digits, as few as needed (Spark timestamps hold microseconds).
* Instants are kept as ``timestamp_ntz`` holding the UTC wall clock, whatever
  the session time zone, so results compare equal to naive UTC tables.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the shape Instant.parse accepts (ISO_INSTANT with an offset).
ISO_INSTANT_PATTERN = r"\A\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{1,9})?(Z|[+-]\d\d:\d\d)\z"

# The reference's seed time for summaries (the epoch).
EPOCH = "1970-01-01 00:00:00"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_wallclock(ts) -> Column:
    """An instant (``timestamp``) as its UTC wall clock (``timestamp_ntz``).

    Micro-second arithmetic from the epoch: exact in every session time zone
    (a cast through the session zone would be ambiguous in DST overlaps).
    """
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)), epoch_ntz())


def _micros_of_second(t: Column) -> Column:
    """0..999999 for a ``timestamp_ntz`` (field extraction: no time zone involved)."""
    return (F.extract(F.lit("SECOND"), t) * F.lit(1000000)).cast("long") % F.lit(1000000)


def is_iso_instant(text) -> Column:
    return _col(text).rlike(ISO_INSTANT_PATTERN)


def parse_iso_instant(text, guarded: Column | None = None) -> Column:
    """ISO text -> UTC ``timestamp_ntz``; null when the text is not an instant.

    ``guarded`` may pass an already computed :func:`is_iso_instant` column.
    """
    t = _col(text)
    ok = is_iso_instant(t) if guarded is None else guarded
    return F.when(ok, utc_wallclock(F.try_to_timestamp(t)))


def truncate_millis(ts) -> Column:
    """Cut a ``timestamp_ntz`` to milliseconds (``toEpochMilli`` floors)."""
    t = _col(ts)
    return F.timestamp_add("MICROSECOND", -(_micros_of_second(t) % F.lit(1000)), t)


def iso_instant(ts) -> Column:
    """``Instant.toString`` of a UTC ``timestamp_ntz``: ``...:ssZ``, ``.SSSZ`` or ``.SSSSSSZ``.

    Built from the fields of the wall clock, so no session time zone applies.
    """
    t = _col(ts)
    base = F.format_string("%04d-%02d-%02dT%02d:%02d:%02d", F.year(t), F.month(t), F.dayofmonth(t),
                           F.hour(t), F.minute(t), F.second(t))
    us = _micros_of_second(t)
    frac = (F.when(us == F.lit(0), F.lit(""))
            .when(us % F.lit(1000) == F.lit(0), F.format_string(".%03d", (us / F.lit(1000)).cast("long")))
            .otherwise(F.format_string(".%06d", us)))
    # format_string would print a null as text
    return F.when(t.isNotNull(), F.concat(base, frac, F.lit("Z")))


def epoch_ntz() -> Column:
    return F.lit(EPOCH).cast("timestamp_ntz")
