"""Changelogs: one output row per input row (the reference with its record
cache off), i.e. running aggregates per key in read order.

A plain ``Window.partitionBy(key).orderBy(order)`` puts every row of a key into
one task.  With few keys (the colour count has a handful) or one hot key (a
third of all rows) that is one task for most of the data.  So every running
aggregate here is computed in two levels over buckets of the order column:

1. buckets of the leading order column ``lead`` that hold about equally many rows: they
   are cut at quantiles of the rows that are windowed (:func:`order_cuts`, one aggregate,
   one row back), so gaps and outliers of the column do not matter;
2. totals per (key, bucket) -- a partial + final hash aggregate, so only one
   row per (key, bucket) and task crosses the shuffle;
3. an exclusive prefix over those totals per key, ordered by bucket.  A key has
   at most ``buckets`` rows here, so that window is bounded whatever the skew;
4. the prefix of each (key, bucket) enters the window of that (key, bucket) as
   one leading *carry* row (a union, not a join), and a window inside
   (key, bucket) finishes the job; the carry rows are then dropped.

The rows are shuffled once (by key and bucket, for the last window); the totals
are small.  No join, so nothing is broadcast and no side's size matters.  Rows
of one key in one bucket share a narrow range of the order column (for tokens:
one document), which bounds the last window's partitions.

The same scheme gives the previous value per key (``lag``): the carry row holds
the last value of the key's earlier buckets.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_kt_bucket"
DEFAULT_BUCKETS_PER_PARTITION = 4
# rows of the order column's table per bucket at most (by default): with n rows,
# about n / ROWS_PER_BUCKET buckets, so at 10^12 rows both window levels hold
# about 10^6 rows per key and bucket
ROWS_PER_BUCKET = 1_000_000
# quantiles asked for at most; beyond that, the rows between two of them are cut further
# by equal widths.  The accuracy keeps a bucket's share within a tenth of the wanted one.
QUANTILES = 1000
ACCURACY = 20 * QUANTILES


@dataclass(frozen=True)
class Cuts:
    """Where the leading order column is cut: inner ``points``, ascending, between ``lo``
    and ``hi``, and the ``pieces`` that each bucket between two points is cut into."""
    points: tuple[int, ...]
    lo: int
    hi: int
    pieces: int = 1


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def order_bounds(df: DataFrame, lead: str) -> tuple[int, int, int]:
    """(min, max, count) of the lead order column: one small aggregate, one row back."""
    row = df.agg(F.min(lead).alias("lo"), F.max(lead).alias("hi"), F.count(lead).alias("n")).first()
    lo, hi, n = row["lo"], row["hi"], row["n"]
    return (0, 0, 0) if lo is None else (int(lo), int(hi), int(n))


def default_buckets(df: DataFrame, rows: int | None = None) -> int:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    by_parts = max(1, n * DEFAULT_BUCKETS_PER_PARTITION)
    by_rows = -(-rows // ROWS_PER_BUCKET) if rows else 0
    return max(by_parts, by_rows)


def order_cuts(df: DataFrame, lead: str, buckets: int | None = None, rows_per_bucket: int | None = None) -> Cuts:
    """Cuts of ``lead`` that leave about equally many rows of ``df`` between them: so many
    ``buckets``, or else about ``rows_per_bucket`` rows in each (but a bucket for every core)."""
    shares = [k / QUANTILES for k in range(1, QUANTILES)]
    row = df.agg(F.percentile_approx(lead, shares, ACCURACY).alias("at"), F.min(lead).alias("lo"),
                 F.max(lead).alias("hi"), F.count(lead).alias("n")).first()
    if row["lo"] is None:
        return Cuts((), 0, 0)
    if not buckets and rows_per_bucket:
        buckets = max(df.sparkSession.sparkContext.defaultParallelism, -(-int(row["n"]) // rows_per_bucket))
    wanted = buckets or default_buckets(df, int(row["n"]))
    inner = min(wanted, QUANTILES)
    picked = {int(row["at"][round(k * QUANTILES / inner) - 1]) for k in range(1, inner)}
    # a cut at the least value would leave nothing below it
    return Cuts(tuple(sorted(p for p in picked if p > row["lo"])), int(row["lo"]), int(row["hi"]),
                -(-wanted // QUANTILES))


def with_bucket(df: DataFrame, lead: str, bounds: Cuts | tuple[int, ...] | None = None,
                buckets: int | None = None) -> DataFrame:
    """``df`` with the bucket of its ``lead``, which never falls as ``lead`` rises.

    ``bounds`` are cuts (default: :func:`order_cuts` of ``df``), or ``(lo, hi)`` or
    ``(lo, hi, rows)`` as from :func:`order_bounds` for buckets of equal width."""
    if bounds is None:
        bounds = order_cuts(df, lead, buckets)
    if not isinstance(bounds, Cuts):
        lo, hi = bounds[0], bounds[1]
        nb = buckets or default_buckets(df, bounds[2] if len(bounds) > 2 else None)
        width = max(1, -(-(hi - lo + 1) // nb))
        # integer division: exact for any long range (lead >= lo, so div == floor)
        return df.withColumn(BUCKET, F.expr(f"(CAST(`{lead}` AS BIGINT) - {lo}L) div {width}L"))
    if not bounds.points and bounds.pieces == 1:
        return df.withColumn(BUCKET, F.lit(0).cast("long"))
    place = f"{BUCKET}_place"
    out = df.withColumn(place, F.col(lead).cast("double"))  # rounding keeps the order
    if bounds.points:
        # distinct as doubles too
        points = sorted({float(p) for p in bounds.points})
        out = Bucketizer(splits=[-float("inf"), *points, float("inf")], inputCol=place, outputCol=BUCKET,
                         handleInvalid="keep").transform(out)
    else:
        points, out = [], out.withColumn(BUCKET, F.lit(0))
    bucket = F.col(BUCKET).cast("long")
    if bounds.pieces > 1:
        edges = [float(bounds.lo), *points, float(bounds.hi) + 1]
        at = bucket.cast("int")
        low = F.get(F.lit(edges), at)
        share = (F.col(place) - low) / F.greatest(F.get(F.lit(edges), at + 1) - low, F.lit(1.0))
        piece = F.floor(share * bounds.pieces)
        bucket = bucket * bounds.pieces + F.greatest(F.lit(0), F.least(piece, F.lit(bounds.pieces - 1)))
    return out.withColumn(BUCKET, F.when(F.col(place).isNotNull(), bucket)).drop(place)


DATA = "_kt_data"  # 0 for a carry row, 1 for an input row


def _bucket_window(keys, order):
    return Window.partitionBy(*keys, BUCKET).orderBy(DATA, *order)


def running(df: DataFrame, partition_by, order_by, aggs: dict[str, tuple[str, str]], *,
            lead: str | None = None, bounds: Cuts | tuple[int, ...] | None = None,
            buckets: int | None = None, initial: DataFrame | None = None) -> DataFrame:
    """Add running aggregates per ``partition_by`` in ``order_by`` order
    (``rows between unbounded preceding and current row``).

    ``aggs`` maps an output name to ``(kind, column)`` with kind in
    sum/count/max/min (count counts non-null values).  ``lead`` (default: first
    order column) must be an integral column that never decreases along
    ``order_by``.  Partition keys must be non-null (keyed operators drop null
    keys first).

    ``initial`` (keys + one column per aggregate name) holds totals from
    before ``df`` -- e.g. earlier micro-batches.  It enters as a bucket before
    the first one: one more row per key in the bounded prefix window.
    """
    keys = _names(partition_by)
    order = _names(order_by)
    lead = lead or order[0]
    b = with_bucket(df, lead, bounds, buckets)

    # per-row contribution of each aggregate; count becomes a sum of 0/1
    contrib = {name: (F.when(F.col(c).isNotNull(), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
                      if kind == "count" else F.col(c)) for name, (kind, c) in aggs.items()}
    roll = {name: ("sum" if kind == "count" else kind) for name, (kind, _) in aggs.items()}
    fn = {"sum": F.sum, "max": F.max, "min": F.min}

    rows = b.select("*", *[e.alias(f"_v_{n}") for n, e in contrib.items()], F.lit(1).alias(DATA))
    totals = rows.groupBy(*keys, BUCKET).agg(*[fn[roll[n]](f"_v_{n}").alias(f"_t_{n}") for n in aggs])
    if initial is not None:
        totals = totals.unionByName(initial.select(
            *keys, F.lit(-1).cast("long").alias(BUCKET), *[F.col(n).alias(f"_t_{n}") for n in aggs]))
    before = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, BUCKET, *[fn[roll[n]](f"_t_{n}").over(before).alias(f"_v_{n}") for n in aggs])
    # a key's first bucket has nothing before it: no carry row
    present = reduce(lambda x, y: x | y, [F.col(f"_v_{n}").isNotNull() for n in aggs])
    carry = carry.where(present).select("*", F.lit(0).alias(DATA))

    both = rows.unionByName(carry, allowMissingColumns=True)
    upto = _bucket_window(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = both.select("*", *[fn[roll[n]](f"_v_{n}").over(upto).alias(f"_r_{n}") for n in aggs])
    out = out.where(F.col(DATA) == F.lit(1))
    for n, (kind, _) in aggs.items():
        out = out.withColumn(n, F.col(f"_r_{n}").cast("long") if kind == "count" else F.col(f"_r_{n}"))
    return out.drop(BUCKET, DATA, *[f"_v_{n}" for n in aggs], *[f"_r_{n}" for n in aggs])


def previous_value(df: DataFrame, partition_by, order_by, value: str, out: str = "previous", *,
                   lead: str | None = None, bounds: Cuts | tuple[int, ...] | None = None,
                   buckets: int | None = None, initial: DataFrame | None = None) -> DataFrame:
    """Add ``out`` = ``value`` of the previous row of the same key in read order
    (``lag(value)``; null for the first row of a key), in two levels as above.
    A null ``value`` of a previous row is kept as null.  ``initial`` (keys +
    ``value``) gives each key's value from before ``df`` (earlier batches)."""
    keys = _names(partition_by)
    order = _names(order_by)
    lead = lead or order[0]
    b = with_bucket(df, lead, bounds, buckets)

    ordkey = F.struct(*[F.col(c) for c in order])
    last = b.groupBy(*keys, BUCKET).agg(F.max_by(F.struct(F.col(value).alias("v")), ordkey).alias("_last"))
    if initial is not None:
        last = last.unionByName(initial.select(*keys, F.lit(-1).cast("long").alias(BUCKET),
                                               F.struct(F.col(value).alias("v")).alias("_last")))
    by_bucket = Window.partitionBy(*keys).orderBy(BUCKET)
    carry = (last.select(*keys, BUCKET, F.lag("_last", 1).over(by_bucket).alias("_carry"))
             .where(F.col("_carry").isNotNull())
             .select(*keys, BUCKET, F.col("_carry.v").alias(value), F.lit(0).alias(DATA)))
    rows = b.select("*", F.lit(1).alias(DATA))
    both = rows.unionByName(carry, allowMissingColumns=True)
    res = both.select("*", F.lag(value, 1).over(_bucket_window(keys, order)).alias(out))
    return res.where(F.col(DATA) == F.lit(1)).drop(BUCKET, DATA)
