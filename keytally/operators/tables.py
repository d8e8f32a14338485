"""Stream/table duality: the latest value per key, and counts over a table.

* :func:`latest_by_key` -- ``stream.toTable()``: the last value per key in read
  order; a null value deletes the key (a tombstone).  Planned as
  ``max_by(struct(value), offset)`` per key: a partial aggregate per task, so a
  hot key sends one row per task over the shuffle, not all its rows.  The
  struct keeps a null value apart from "no row".
* :func:`count_by_current_value` -- ``table.groupBy((k, v) -> (v, k)).count()``:
  how many keys hold each value now.  A value whose last holder moved away
  stays with count 0.  Planned without a join: every (key, value) seen
  contributes 0 to its value, every current (key, value) contributes 1, one
  ``sum`` per value -- all from one reduced (key, value) table.
* :func:`current_value_changelog` -- the same count as a changelog: for each
  input row, the old value loses one and the new value gains one, each with the
  running count of that value (two-level prefix sums, since there are only a
  handful of values).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keytally.operators.changelog import Cuts, order_cuts, previous_value, running


def latest_by_key(records: DataFrame, key: str = "key", value: str = "value", order: str = "offset",
                  deletes: bool = True) -> DataFrame:
    """(key, value) with the last value per key in ``order``.

    Null keys are dropped (a keyed table has no null key).  With ``deletes`` a
    key whose last value is null is absent from the result.
    """
    latest = (records.where(F.col(key).isNotNull())
              .groupBy(key)
              .agg(F.max_by(F.struct(F.col(value).alias("v")), F.col(order)).alias("_last")))
    out = latest.select(F.col(key), F.col("_last.v").alias(value))
    return out.where(F.col(value).isNotNull()) if deletes else out


def count_by_current_value(records: DataFrame, key: str = "key", value: str = "value",
                           order: str = "offset", count: str = "count") -> DataFrame:
    """(value, count): keys currently holding each value; values ever seen keep
    a row, with 0 once nobody holds them.

    One pass over the input: rows are first reduced to one row per
    (key, value) with its newest offset (partial aggregate, so a hot key costs
    one row per value and task); both the current value per key and the set of
    values seen come from that reduced table, whose exchange Spark reuses.
    """
    pairs = (records.where(F.col(key).isNotNull())
             .groupBy(key, value).agg(F.max(order).alias("_last")))
    current = (pairs.groupBy(key)
               .agg(F.max_by(F.struct(F.col(value).alias("v")), F.col("_last")).alias("_cur"))
               .select(F.col("_cur.v").alias(value), F.lit(1).cast("long").alias("_d"))
               .where(F.col(value).isNotNull()))
    # A value counts as seen at a known read position, as for the current value
    # (max_by skips null orderings).  Both branches must read ``pairs`` alike to
    # share its aggregate and exchange, so nothing is filtered on the grouping
    # columns here (Catalyst would push it below the aggregate); the null value
    # (a delete) is dropped after the final sum instead, by a predicate that also
    # reads the sum and so stays there.
    seen = pairs.where(F.col("_last").isNotNull()).select(F.col(value), F.lit(0).cast("long").alias("_d"))
    counts = current.unionByName(seen).groupBy(value).agg(F.sum("_d").alias(count))
    return counts.where(F.col(value).isNotNull() | F.col(count).isNull())


def current_value_changelog(records: DataFrame, key: str = "key", value: str = "value",
                            order: str | Sequence[str] = "offset", count: str = "count", *,
                            lead: str | None = None, bounds: Cuts | tuple[int, ...] | None = None,
                            buckets: int | None = None, initial_values: DataFrame | None = None,
                            initial_counts: DataFrame | None = None) -> DataFrame:
    """(offset, step, value, count): the change stream of
    :func:`count_by_current_value` with one update per value touched.

    For an input row of a key that held ``old`` before: ``step`` 0 is ``old``
    losing one, ``step`` 1 is the new value gaining one; a key's first row has
    only step 1.  A null value deletes its key: only step 0, and none if the key
    held nothing.  A repeat of the same value keeps its -1/+1 pair, as the
    reference's library emits it.  ``count`` is the value's count after the step.

    ``order`` may be several columns; ``lead`` (default: the first) is the integral one
    that buckets are cut by.  ``initial_values`` (key, value) and ``initial_counts``
    (value, count) carry the state from before ``records`` (earlier micro-batches of a
    stream).
    """
    order = [order] if isinstance(order, str) else list(order)
    lead = lead or order[0]
    keyed = records.where(F.col(key).isNotNull()).select(key, value, *order)
    if bounds is None:
        bounds = order_cuts(keyed, lead, buckets)
    with_old = previous_value(keyed, key, order, value, out="_old", lead=lead, bounds=bounds, buckets=buckets,
                              initial=initial_values)
    steps = F.array(
        F.struct(F.lit(0).alias("step"), F.col("_old").alias("v"), F.lit(-1).cast("long").alias("d")),
        F.struct(F.lit(1).alias("step"), F.col(value).alias("v"), F.lit(1).cast("long").alias("d")),
    )
    deltas = (with_old.select(*order, F.explode(steps).alias("s"))
              .where(F.col("s.v").isNotNull())
              .select(*order, F.col("s.step").alias("step"), F.col("s.v").alias(value), F.col("s.d").alias("_d")))
    init = None if initial_counts is None else initial_counts.select(value, F.col(count).alias(count))
    out = running(deltas, value, [*order, "step"], {count: ("sum", "_d")}, lead=lead, bounds=bounds,
                  buckets=buckets, initial=init)
    return out.select(*order, "step", value, count)
