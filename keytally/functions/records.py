"""Record encodings: what the reference's serdes put on a topic.

* ``Serdes.Long()`` writes a long as 8 bytes, big-endian, two's complement.
* JSON values are objects built from named fields.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from keytally.functions.times import iso_instant

# Fixed value: the JSON shape of one transaction, as the producer writes it.
TRANSACTION_SCHEMA = "name string, amount long, time string"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def long_to_hex(n) -> Column:
    """The 8 bytes of a long as 16 upper-case hex digits (two's complement)."""
    return F.lpad(F.hex(_col(n).cast("long")), 16, "0")


def encode_long(n) -> Column:
    """A long as the 8-byte big-endian ``binary`` of ``Serdes.Long()``."""
    return F.unhex(long_to_hex(n))


def decode_long(b) -> Column:
    """Inverse of :func:`encode_long` (null unless exactly 8 bytes)."""
    c = _col(b)
    return F.when(F.octet_length(c) == 8, F.conv(F.hex(c), 16, -10).cast("long"))


def transaction_json(name, amount, time) -> Column:
    """``{"name":..,"amount":..,"time":"<ISO instant>"}`` from a UTC ``timestamp_ntz``."""
    return F.to_json(F.struct(_col(name).alias("name"), _col(amount).alias("amount"),
                              iso_instant(time).alias("time")))


def summary_json(count, balance, time) -> Column:
    """``{"count":..,"balance":..,"time":"<ISO instant>"}`` as the summary sink writes it."""
    return F.to_json(F.struct(_col(count).alias("count"), _col(balance).alias("balance"),
                              iso_instant(time).alias("time")))
