"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keytally.session import checkpoint_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written once, as Parquet, below the shared folder of
    ``spark.checkpoint.dir`` and read back: a cut in the lineage that outlives
    lost executors.  Each call takes a new folder."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # the schema is known: an empty table has no file to infer it from
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish


def fold(id_col: Column, modulus: int, held: int) -> Column:
    """True for held-out rows: crc32 of the id as text leaves ``held`` on division
    by ``modulus``.  A null id has no fold and counts as held out, so nothing is
    learned from it."""
    return F.coalesce(F.crc32(id_col.cast("string")) % F.lit(modulus) == F.lit(held), F.lit(True))


#: Bytes of text that a classifier's sample brings to the driver at most.
SAMPLE_BYTES = 64 * 1024 * 1024


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, modulus: int, held: int,
                    per_class: int, seed: int = 42) -> list[tuple[str, int]]:
    """(text, label) of at most ``per_class`` labelled training rows of each class.

    Rows are taken in the order of a hash of the id, so a rerun takes the same
    ones.  Ids whose labels disagree, null ids and null labels are left out; a
    null text counts as empty, and an id that occurs twice counts once, with its least
    text.  The ids (2 x ``per_class`` at most) are the only thing broadcast.  The driver
    receives one text of each, in the same order as long as they are within
    ``SAMPLE_BYTES`` together; a text that would exceed it is left out.
    """
    clean = (labels.select(F.col("doc_id").alias("_id"), F.col(label_col).cast("int").alias("_y"))
             .where(F.col("_id").isNotNull() & F.col("_y").isin(0, 1))
             .where(~fold(F.col("_id"), modulus, held))
             .groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_y2"))
             .where("_y = _y2").select("_id", "_y", F.xxhash64(F.col("_id"), F.lit(seed)).alias("_h")))
    picked = None
    for y in (0, 1):
        part = clean.where(F.col("_y") == y).orderBy("_h", "_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    texts = (docs.select(F.col("doc_id").alias("_id"), F.coalesce(F.col("text"), F.lit("")).alias("_text"))
             .join(F.broadcast(picked), "_id").groupBy("_h", "_id", "_y").agg(F.min("_text").alias("_text")))
    texts = stored(texts.withColumn("_n", F.octet_length("_text")), "sample")
    room, ids = SAMPLE_BYTES, []
    for r in sorted(texts.select("_h", "_id", "_n").collect()):
        if r["_n"] <= room:
            room -= r["_n"]
            ids.append(r["_id"])
    rows = texts.where(F.col("_id").isin(ids)).select("_h", "_id", "_text", "_y").collect() if ids else []
    return [(r["_text"], int(r["_y"])) for r in sorted(rows, key=lambda r: (r["_h"], r["_id"]))]
