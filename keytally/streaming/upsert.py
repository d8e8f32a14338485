"""Upsert result table: the reference's output topic read as a table (last
value per key), written exactly once per micro-batch.

Each micro-batch's changed rows go to ``<path>/batch_id=<n>`` in overwrite
mode from ``foreachBatch``.  A batch that is replayed after a failure (the
checkpoint says it did not commit) rewrites the same folder, so the table is
idempotent per batch id -- exactly-once output without a transactional format.
Reading takes, per key, the row of the highest batch id.  A row whose value
columns are all null is a delete.

:func:`compact` folds all batches up to a *committed* batch ``n`` into one
snapshot in a folder of its own, ``_snapshots/<n>`` (every key, deletes
included).  Batch folders are never written again by it, so a crash at any
point loses nothing: a snapshot counts only once Spark's ``_SUCCESS`` file is
there.  Readers take the newest snapshot at or below the batch they read and
the batch folders after it, by name; older folders can be removed by whoever
owns the table.  :class:`UpsertSink` compacts by itself every
``compact_every`` batches, always the batch before the running one (which is
committed, or the running one would not have started).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

BATCH_COL = "batch_id"


SNAPSHOTS = "_snapshots"
DEFAULT_COMPACT_EVERY = 100


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _numbers(spark: SparkSession, path: str, prefix: str = "") -> list[int]:
    """The numbers of the folders ``<prefix><n>`` in ``path`` (one listing of names)."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(jpath)]
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].isdigit())


def latest_snapshot(spark: SparkSession, path: str, up_to: int | None = None) -> int | None:
    """Newest complete snapshot at or below ``up_to``."""
    base = f"{path.rstrip('/')}/{SNAPSHOTS}"
    for n in reversed(_numbers(spark, base)):
        if up_to is None or n <= up_to:
            fs, done = _fs(spark, f"{base}/{n}/_SUCCESS")
            if fs.exists(done):
                return n
    return None


class UpsertSink:
    """``foreachBatch`` callable writing each micro-batch under its batch id.

    With ``schema`` and ``keys`` it also compacts the table every
    ``compact_every`` batches (the previous, committed batch)."""

    def __init__(self, path: str, schema: StructType | None = None, keys: Sequence[str] | None = None,
                 compact_every: int = DEFAULT_COMPACT_EVERY):
        self.path = path.rstrip("/")
        self.schema, self.keys, self.compact_every = schema, keys, compact_every

    def batch(self, spark: SparkSession, schema: StructType, batch_id: int) -> DataFrame:
        """The rows of one written batch."""
        return spark.read.schema(schema).parquet(f"{self.path}/{BATCH_COL}={batch_id}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/{BATCH_COL}={batch_id}")
        maybe_compact(batch.sparkSession, self.path, self.schema, self.keys, batch_id, self.compact_every)


def maybe_compact(spark: SparkSession, path: str, schema: StructType | None, keys: Sequence[str] | None,
                  batch_id: int, every: int) -> int | None:
    """Compact up to ``batch_id - 1`` when ``batch_id`` is a multiple of ``every``."""
    if schema is None or not keys or every <= 0 or batch_id == 0 or batch_id % every:
        return None
    return compact(spark, path, schema, keys, up_to=batch_id - 1)


def _with_batch(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField(BATCH_COL, LongType(), True)])


def read_upsert(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str],
                drop_deletes: bool = True, since: int | str | None = "snapshot",
                up_to: int | None = None) -> DataFrame:
    """The current table: per key the row of the newest batch.

    One partial + final aggregate per key (``max_by`` on the batch id), so a key
    updated in every batch costs one row per task on the shuffle.  ``since``
    skips older folders: ``"snapshot"`` (default) starts at the newest snapshot
    at or below ``up_to``, an int at that batch, None reads everything;
    ``up_to`` ignores later batches.
    """
    keys = list(keys)
    base = path.rstrip("/")
    snapshot = None
    if since is not None:
        snapshot = latest_snapshot(spark, base, up_to if since == "snapshot" else min(since, up_to or since))
    first = since if isinstance(since, int) else 0
    if snapshot is not None:
        first = snapshot + 1
    values = [f.name for f in schema.fields if f.name not in keys]
    ids = [n for n in _numbers(spark, base, f"{BATCH_COL}=") if n >= first and (up_to is None or n <= up_to)]
    if ids:  # only the folders that count are listed
        raw = (spark.read.schema(_with_batch(schema)).option("basePath", base)
               .parquet(*[f"{base}/{BATCH_COL}={n}" for n in ids]))
    else:
        raw = spark.createDataFrame([], _with_batch(schema))
    if snapshot is not None:
        raw = raw.unionByName(spark.read.schema(schema).parquet(f"{base}/{SNAPSHOTS}/{snapshot}")
                              .withColumn(BATCH_COL, F.lit(snapshot).cast("long")))
    latest = raw.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(v) for v in values]), F.col(BATCH_COL)).alias("_row"))
    out = latest.select(*keys, *[F.col(f"_row.{v}").alias(v) for v in values])
    if drop_deletes and values:
        alive = None
        for v in values:
            c = F.col(v).isNotNull()
            alive = c if alive is None else (alive | c)
        out = out.where(alive)
    return out


def compact(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str],
            up_to: int) -> int:
    """Write the table as of committed batch ``up_to`` as the snapshot ``up_to`` and
    return ``up_to``.

    Safe to rerun at any point: batch folders stay as they are, a complete snapshot
    is left alone, and an incomplete one is not read and is written anew.
    """
    base = path.rstrip("/")
    if latest_snapshot(spark, base, up_to) != up_to:
        # deletes stay in the snapshot: older folders may still hold the old values
        snap = read_upsert(spark, base, schema, keys, drop_deletes=False, up_to=up_to)
        snap.write.mode("overwrite").parquet(f"{base}/{SNAPSHOTS}/{up_to}")
    return up_to
