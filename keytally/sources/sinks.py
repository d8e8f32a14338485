"""Sinks: keyed results as the reference writes them to topics.

* ``Produced.with(String, Long)`` -> key text, value the 8 bytes of a long
  (:func:`long_records`); ``encoding="text"`` gives decimal text instead.
* ``Produced.with(String, json)`` -> key text, value JSON (:func:`json_records`).
* :func:`write_topic` -- the Kafka sink (unverified here, see ``topics.py``).
  Spark's Kafka sink is at-least-once: for exactly-once *output* use the upsert
  table of :mod:`keytally.streaming.upsert`, which is idempotent per batch id, or tell
  repeats by the identity that :func:`identified` puts into the headers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keytally.functions.records import encode_long, long_to_hex


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def long_records(df: DataFrame, key, value, encoding: str = "bytes") -> DataFrame:
    """(key, long) rows as topic records.  ``encoding``: ``bytes`` (8-byte
    big-endian, the reference's serde), ``hex`` (the same bytes as hex text) or
    ``text`` (decimal)."""
    v = _col(value)
    if encoding == "bytes":
        enc = encode_long(v)
    elif encoding == "hex":
        enc = long_to_hex(v)
    elif encoding == "text":
        enc = v.cast("string")
    else:
        raise ValueError(f"unknown encoding {encoding!r}")
    return df.select(_col(key).cast("string").alias("key"), enc.alias("value"))


def json_records(df: DataFrame, key, value_json) -> DataFrame:
    return df.select(_col(key).cast("string").alias("key"), _col(value_json).alias("value"))


def identified(records: DataFrame, batch_id: int) -> DataFrame:
    """``records`` (key, value) with the ``headers`` ``batch_id`` and ``row_id``.

    The row id comes from the record itself (a hash of key and value, and its number
    among equal records), so a replayed micro-batch writes the same identities whatever
    its partitions or order, and a consumer can drop what it has seen."""
    own = F.xxhash64("key", "value")
    equal = Window.partitionBy(own, "key", "value").orderBy(own)
    row_id = F.concat(F.lower(F.lpad(F.hex(own), 16, "0")), F.lit("-"), F.row_number().over(equal).cast("string"))
    headers = [F.struct(F.lit(n).alias("key"), v.cast("binary").alias("value"))
               for n, v in (("batch_id", F.lit(str(batch_id))), ("row_id", row_id))]
    return records.select("key", "value", F.array(*headers).alias("headers"))


def write_topic(df: DataFrame, topic: str, bootstrap_servers: str, *, checkpoint: str | None = None,
                options: dict | None = None, query_name: str | None = None, output_mode: str = "update"):
    """Write ``key``/``value`` records to Kafka (batch or stream).

    Producer settings of the reference's publisher map to ``kafka.acks=all``,
    ``kafka.retries``, ``kafka.enable.idempotence=true``, ``kafka.linger.ms``;
    pass them in ``options``.  Unverified in this container.
    """
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    opts.update(options or {})
    if df.isStreaming:
        w = df.writeStream.format("kafka").outputMode(output_mode).options(**opts)
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
        if query_name:
            w = w.queryName(query_name)
        return w.start()
    df.write.format("kafka").options(**opts).save()
    return None
