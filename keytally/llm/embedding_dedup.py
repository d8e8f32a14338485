"""Embedding near-duplicates: int8 tile products with error bounds, full precision
for the pairs that may reach the threshold.

Each vector is scaled to length one in double precision and rounded to
``scale * int8``; the length of what the rounding left over is kept.  For two unit
vectors ``u = a + e`` and ``v = b + f`` (a, b rounded) the product is off by at most
``|a||f| + |e||v|``, so a pair whose int8 product plus that bound stays below the
threshold is surely no link; all others are recomputed in double precision.

Vectors meet only within a label (and a length).  Equal vectors are one class with a
count.  A label's classes are dealt by a hash to tiles of about ``tile`` classes, and
each pair of tiles is one task's product, so a hot label is as many tasks as it needs.

Defined cases: a null label or vector, a null or non-finite component, an empty or
zero vector link with nothing and are their own component; a row with a null id is
never compared (no links, null component, not kept); rows repeated whole are
separate vectors that link with each other; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keytally.llm.common import stored, table
from keytally.llm.graph import components
from keytally.llm.hamming import _roots

THRESHOLD = 0.98
TILE = 512
ROWS = 256  # rows of a tile that meet the others at a time


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 rows, scales, lengths of the rounding errors) of unit rows ``x``."""
    scale = np.abs(x).max(axis=1) / 127.0
    q = np.rint(x / scale[:, None]).astype(np.int8)
    err = np.sqrt(((x - scale[:, None] * q) ** 2).sum(axis=1))
    return q, scale, err


def close_pairs(x: np.ndarray, threshold: float, side: np.ndarray | None = None):
    """Blocks of index pairs (i, j), i < j, of rows whose cosine is at least
    ``threshold``; with ``side``, only pairs across two sides."""
    length = np.sqrt((x * x).sum(axis=1))
    unit = x / length[:, None]
    q, scale, err = quantise(unit)
    # products of int8 are exact in single precision up to this many terms
    wide = q.astype(np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64)
    slack = 1e-9  # rounding of the unit vectors and of the bound itself
    for r in range(0, len(x), ROWS):
        s = slice(r, r + ROWS)
        about = (wide[s] @ wide.T).astype(np.float64) * scale[s, None] * scale[None, :]
        bound = (1 + err[s, None]) * err[None, :] + err[s, None] + slack
        may = about + bound >= threshold
        if side is not None:
            may &= side[s, None] != side[None, :]
        i, j = np.nonzero(may)
        i += r
        i, j = i[i < j], j[i < j]
        for k in range(0, len(i), 1 << 16):
            a, b = i[k:k + 65536], j[k:k + 65536]
            cos = (x[a] * x[b]).sum(axis=1) / (length[a] * length[b])
            hit = cos >= threshold
            if hit.any():
                yield a[hit], b[hit]


def embedding_links(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))
    sound = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("e").isNotNull()
             & F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
             & F.exists("e", lambda v: v != 0.0))
    rows = stored(rows.withColumn("sound", F.coalesce(sound, F.lit(False))), "vectors")
    cls = (rows.where("sound").groupBy("label", "e").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"))
           .withColumn("dim", F.size("e")))
    cls = stored(cls, "vector-classes")
    tiles = (cls.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("classes"))
             .select("label", "dim", F.ceil(F.col("classes") / F.lit(tile)).cast("int").alias("tiles")))
    own = F.pmod(F.xxhash64("rep", F.lit(11)), F.col("tiles")).cast("int")
    dealt = (cls.join(tiles, ["label", "dim"]).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .select("label", "dim", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                     F.when(F.col("own") == F.least("own", "other"), 0).otherwise(1).alias("side"), "rep", "n", "e"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.array(pdf["e"].tolist(), dtype=np.float64)
        x /= np.abs(x).max(axis=1)[:, None]  # no overflow in the squares
        rep, n = pdf["rep"].to_numpy(), pdf["n"].to_numpy()
        side = pdf["side"].to_numpy() if pdf["lo"].iat[0] != pdf["hi"].iat[0] else None
        links = np.zeros(len(rep), dtype=np.int64)

        def counted():
            for i, j in close_pairs(x, threshold, side):
                np.add.at(links, i, n[j])
                np.add.at(links, j, n[i])
                yield i, j

        root = _roots(len(rep), counted())
        hit = np.flatnonzero(links)
        return pd.DataFrame({"rep": rep[hit], "links": links[hit], "root": rep[root[hit]]})

    found = stored(dealt.groupBy("label", "dim", "lo", "hi").applyInPandas(compare, "rep long, links long, root long"),
                   "vector-links")
    per_class = (cls.select("label", "e", "rep", "n")
                 .join(found.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left")
                 .join(components(found, "rep", "root"), F.col("rep") == F.col("node"), "left")
                 .select("label", "e", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                         F.coalesce("component", "rep").alias("component_id")))
    linked = (rows.where("sound").join(per_class, ["label", "e"])
              .select("vec_id", "n_links", "component_id"))
    alone = rows.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                           F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(table(spark, sf_dir, "embeddings"))


#: Every pair of a label, and the closure of the links, in DuckDB.
ORACLE = """
with recursive v as (
  select vec_id, label, cast(embedding as double[]) as e from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (
  select a.vec_id as a, b.vec_id as b from v a join v b
  on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.98),
r as (
  select vec_id as a, vec_id as b from embeddings
  union select r.a, l.b from r join l on r.b = l.a)
select e.vec_id, coalesce(n.n, 0) as n_links, c.c as component_id, e.vec_id = c.c as kept
from embeddings e
join (select a, min(b) as c from r group by a) c on c.a = e.vec_id
left join (select a, count(*) as n from l group by a) n on n.a = e.vec_id
"""
