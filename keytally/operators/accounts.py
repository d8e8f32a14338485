"""Accounts: running balance and account summary from JSON transactions.

Input records: key = account name, value = ``{"name","amount","time"}`` JSON.

* :func:`parse_transactions` -- one ``from_json`` per record; ``amount`` must be
  a JSON integer, ``time`` an ISO-8601 instant (cut to milliseconds).  Bad
  records follow ``on_bad``: ``"fail"`` stops the job (the reference throws),
  ``"drop"`` leaves them out; :func:`bad_transactions` lists them with a reason
  (quarantine).  Amounts are 64-bit, also where the reference used 32-bit ints.
* :func:`balances` -- sum per key from a zero seed.
* :func:`summaries` -- count, sum and latest time per key, time never below the
  epoch (the seed).  All three parts commute, so arrival order does not matter
  and a hash aggregate (partial per task, then final) does it: no UDAF.
* :func:`running_balances`, :func:`running_summaries` -- the changelogs, one row
  per transaction (two-level prefix sums, so a hot account is split).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keytally.functions.records import TRANSACTION_SCHEMA
from keytally.functions.times import epoch_ntz, is_iso_instant, parse_iso_instant, truncate_millis
from keytally.operators.changelog import Cuts, running


def _once(df: DataFrame, **made) -> DataFrame:
    """``df`` with further columns that are computed once a row.

    A one-element ``inline`` stands between the expressions and what reads them: the
    optimiser moves filters and field reads through a projection, and would then repeat
    the projection's expressions in each of them, but not through a generator.
    """
    row = F.struct(*[expr.alias(name) for name, expr in made.items()])
    return df.select("*", F.inline(F.array(row)).alias(*made))


def _with_parsed(records: DataFrame, key: str, value: str, need_time: bool = True) -> DataFrame:
    """Records plus ``_has`` (a value), ``_amount``, ``_time`` and ``_reason`` (null for a
    good record).

    The JSON is parsed once, and the time text once; everything else reads those results.
    A bad record's text is looked at again, only to tell what is wrong with it.
    """
    parsed = _once(records, _j=F.from_json(F.col(value), TRANSACTION_SCHEMA), _has=F.col(value).isNotNull())
    fields = parsed.select(*records.columns, "_has", F.col("_j.amount").alias("_amount"), F.col("_j.time").alias("_tt"))
    instant = parse_iso_instant(F.col("_tt"))
    timed = _once(fields, _instant=instant) if need_time else fields.withColumn("_instant", instant)
    timed = timed.withColumn("_time", truncate_millis(F.col("_instant")))
    reason = (F.when(F.col(key).isNull(), F.lit("null key"))
              .when(~F.col("_has"), F.lit("null value"))
              .when(F.col("_amount").isNull(), F.when(F.json_object_keys(F.col(value)).isNull(), F.lit("not a JSON object"))
                    .otherwise(F.lit("amount missing or not an integer"))))
    if need_time:
        reason = (reason.when(F.col("_tt").isNull(), F.lit("time missing"))
                  .when(F.col("_time").isNull(), F.when(is_iso_instant(F.col("_tt")), F.lit("time not a valid instant"))
                        .otherwise(F.lit("time not an ISO-8601 instant"))))
    return timed.select(*records.columns, "_has", "_amount", "_time", reason.alias("_reason"))


def parse_transactions(records: DataFrame, key: str = "key", value: str = "value", order: str = "offset",
                       on_bad: str = "fail", need_time: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """(offset, name, amount long, time timestamp_ntz UTC, ms precision), then the
    columns ``keep`` of the records.

    A null key or value is not an error: keyed operators skip such records.  With
    ``need_time=False`` (balances, which read only the amount) a record without a
    valid time is good and its time is null.
    """
    # asked of ``_has``: a test of the value itself would be made below, where the value is
    # built, and build it twice
    p = _with_parsed(records, key, value, need_time).where(F.col(key).isNotNull() & F.col("_has"))
    if on_bad == "fail":
        # a filter, so that the check runs whatever columns the plan reads
        stop = F.raise_error(F.concat(F.lit("bad transaction at offset "),
                                      F.coalesce(F.col(order).cast("string"), F.lit("null")),
                                      F.lit(": "), F.col("_reason"))).cast("boolean")
        p = p.where(F.when(F.col("_reason").isNotNull(), stop).otherwise(F.lit(True)))
    elif on_bad == "drop":
        p = p.where(F.col("_reason").isNull())
    else:
        raise ValueError("on_bad must be 'fail' or 'drop' (bad_transactions() quarantines)")
    return p.select(F.col(order).alias("offset"), F.col(key).alias("name"), F.col("_amount").cast("long").alias("amount"),
                    F.col("_time").alias("time"), *keep)


def bad_transactions(records: DataFrame, key: str = "key", value: str = "value",
                     order: str = "offset") -> DataFrame:
    """(offset, key, value, reason) of the records :func:`parse_transactions` rejects."""
    p = _with_parsed(records, key, value)
    return p.where(F.col("_reason").isNotNull()).select(F.col(order).alias("offset"), F.col(key).alias("key"),
                                                        F.col(value).alias("value"), F.col("_reason").alias("reason"))


def balances(tx: DataFrame) -> DataFrame:
    """(name, balance)."""
    return tx.groupBy("name").agg(F.sum("amount").cast("long").alias("balance"))


def summaries(tx: DataFrame) -> DataFrame:
    """(name, count, balance, time)."""
    return tx.groupBy("name").agg(
        F.count(F.lit(1)).alias("count"),
        F.sum("amount").cast("long").alias("balance"),
        F.greatest(epoch_ntz(), F.max("time")).alias("time"),
    )


def running_summaries(tx: DataFrame, *, bounds: Cuts | tuple[int, ...] | None = None,
                      buckets: int | None = None) -> DataFrame:
    """(offset, name, count, balance, time) after each transaction of the account."""
    t = tx.withColumn("_one", F.lit(1).cast("long"))
    out = running(t, "name", "offset", {"count": ("sum", "_one"), "balance": ("sum", "amount"),
                                         "_tmax": ("max", "time")}, bounds=bounds, buckets=buckets)
    return out.select("offset", "name", "count", F.col("balance").cast("long").alias("balance"),
                      F.greatest(epoch_ntz(), F.col("_tmax")).alias("time"))


def running_balances(tx: DataFrame, *, bounds: Cuts | tuple[int, ...] | None = None,
                     buckets: int | None = None) -> DataFrame:
    """(offset, name, balance) after each transaction of the account."""
    out = running(tx, "name", "offset", {"balance": ("sum", "amount")}, bounds=bounds, buckets=buckets)
    return out.select("offset", "name", F.col("balance").cast("long").alias("balance"))
