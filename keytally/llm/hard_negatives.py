"""Hard negatives by zone maps over Hilbert-ordered blocks of candidates.

Rows are sorted by label and, within a label, along a Hilbert curve through their
vectors, and cut into blocks of at most ``rows`` rows.  A block is one row of a Parquet
table: its rows packed, and a zone map of the least and greatest value of each dimension.
For an anchor ``a`` interval arithmetic gives ``sum(min(a*lo, a*hi))`` and
``sum(max(a*lo, a*hi))`` as bounds of all scores in a block, from the zone maps alone.
Only blocks whose bounds meet what an anchor still looks for are read for it:

* positives: blocks of its label whose upper bound reaches the fifth best score of its
  own block;
* negatives: blocks of other labels whose bounds meet the window of one of its positives,
  ``least_share`` of the positive's score up to that score.

Anchors keep the order of the blocks and are dealt in tiles of ``tile``; a task holds one
tile and some blocks, so no label, however frequent, is one task.

Scores are integers: components become ``floor(scale * x)``, products are summed in 64
bits.  Defined cases: a row with a null id, label or vector, or a null or non-finite
component, takes no part; of rows with one id the smallest (label, vector) counts, so
rows repeated whole count once; vectors meet only those of their own length, and an empty
vector has score 0 with the others; a positive of negative score has an empty window; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keytally.llm.common import stored, table

ROWS = 256  # rows of a block
TILE = 2048  # anchors of a tile
TOGETHER = 16  # blocks that a task scores at a time
ZONES = 512  # zone maps that a task tests at a time
BITS = 4  # of each dimension, for the order along the curve
NOTHING = np.iinfo(np.int64).min

BLOCK = ("block long, part int, label long, dim int, n int, anchors int, anchors_before long, "
         "lo binary, hi binary, ids binary, vectors binary")
ANCHOR = "anchor_id long, label long, dim int, part int, nth long, vector binary, least long"


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places of the rows of ``cells`` (whole numbers below ``2**bits``) along the
    Hilbert curve through all their dimensions (Skilling's transform)."""
    x = cells.astype(np.int64).T.copy()  # one row a dimension
    if not len(x):
        return [b""] * len(cells)
    for b in range(bits - 1, 0, -1):
        below = (1 << b) - 1
        for i in range(len(x)):
            is_set = (x[i] >> b & 1).astype(bool)
            swap = np.where(is_set, 0, (x[0] ^ x[i]) & below)
            x[i] ^= swap
            x[0] ^= np.where(is_set, below, swap)
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(len(cells), np.int64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> b & 1, (1 << b) - 1, 0)
    x ^= turn
    planes = np.concatenate([x >> b & 1 for b in range(bits - 1, -1, -1)]).astype(np.uint8)
    return [row.tobytes() for row in np.packbits(planes.T, axis=1)]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two int64 tables, exact in 64 bits."""
    reach = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if reach < 2.0 ** 53:  # every sum is exact in doubles
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def bounds(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of the scores of anchors ``a`` in blocks of zone maps
    ``lo``, ``hi``, each a table anchors x blocks."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return products(up, lo) + products(down, hi), products(up, hi) + products(down, lo)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` highest scores of each row, ties by smaller id;
    ``NOTHING`` is no score."""
    if scores.shape[1] > k:
        cut = np.partition(scores, -k, axis=1)[:, -k]
        i, j = np.nonzero((scores >= cut[:, None]) & (scores > NOTHING))
    else:
        i, j = np.nonzero(scores > NOTHING)
    order = np.lexsort((ids[j], -scores[i, j], i))
    i, j = i[order], j[order]
    first = np.searchsorted(i, np.arange(scores.shape[0]))
    keep = np.arange(len(i)) - first[i] < k
    return i[keep], j[keep]


def _table(packed, dim: int) -> np.ndarray:
    """Rows of int64 vectors packed one after the other, from one or several values.
    Vectors of no length leave no bytes: the caller knows how many there are."""
    return np.frombuffer(b"".join(packed), np.int64).reshape(-1, dim) if dim else np.zeros((0, 0), np.int64)


def clean_rows(vectors: DataFrame, label, scale: int) -> DataFrame:
    """(vec_id, label, e): the rows that take part, one an id."""
    e = F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", label.cast("long").alias("label"), e.alias("e"))
    sound = F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (rows.where("vec_id is not null and label is not null and e is not null").where(sound)
            .select("vec_id", "label",
                    F.transform("e", lambda v: F.floor(v * F.lit(float(scale))).cast("long")).alias("e"))
            .groupBy("vec_id").agg(F.min(F.struct("label", "e")).alias("r")).select("vec_id", "r.label", "r.e"))


def blocks_of(rows: DataFrame, every: int, rows_a_block: int = ROWS, bits: int = BITS) -> DataFrame:
    """The blocks of (vec_id, label, e) along (label, length, Hilbert curve, id), stored."""
    rows = stored(rows, "negatives-rows")
    least, most = rows.agg(F.min(F.array_min("e")), F.max(F.array_max("e"))).first()
    least, most = (0.0, 1.0) if least is None else (float(least), max(float(most), float(least) + 1.0))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sizes = pdf["e"].map(len).to_numpy()
            for dim in np.unique(sizes):
                part = pdf[sizes == dim]
                x = np.array(part["e"].tolist(), np.int64).reshape(len(part), int(dim))
                cells = np.clip((x - least) / (most - least) * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
                yield pd.DataFrame({"vec_id": part["vec_id"], "label": part["label"], "dim": int(dim),
                                    "place": hilbert_keys(cells, bits), "v": [r.tobytes() for r in x]})

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Blocks of the sorted rows of one task; a label or length starts a new one."""
        part, number, before = TaskContext.get().partitionId(), 0, 0
        held = None

        def block(label, dim, ids, packed):
            nonlocal number, before
            x = _table(packed, dim).reshape(len(ids), dim)
            lo, hi = x.min(axis=0), x.max(axis=0)
            anchors = int((ids % every == 0).sum())
            row = ((part << 32) + number, part, label, dim, len(ids), anchors, before,
                   lo.tobytes(), hi.tobytes(), ids.tobytes(), b"".join(packed))
            number, before = number + 1, before + anchors
            return row

        def frame(rows):
            return pd.DataFrame(rows, columns=[c.split()[0] for c in BLOCK.split(", ")])

        for pdf in batches:
            if held is not None:
                pdf = pd.concat([held, pdf], ignore_index=True)
            kinds = pdf[["label", "dim"]].to_numpy(np.int64)
            edges = [0, *(np.flatnonzero((kinds[1:] != kinds[:-1]).any(axis=1)) + 1), len(pdf)] if len(pdf) else [0]
            made, at = [], 0
            for start, stop in zip(edges[:-1], edges[1:]):
                for at in range(start, stop, rows_a_block):
                    end = min(at + rows_a_block, stop)
                    if end == len(pdf):  # may go on in the next batch
                        break
                    made.append(block(int(pdf["label"].iat[at]), int(pdf["dim"].iat[at]),
                                      pdf["vec_id"].to_numpy(np.int64)[at:end], list(pdf["v"][at:end])))
            held = pdf[at:].reset_index(drop=True)
            if made:
                yield frame(made)
        if held is not None and len(held):
            yield frame([block(int(held["label"].iat[0]), int(held["dim"].iat[0]),
                               held["vec_id"].to_numpy(np.int64), list(held["v"]))])

    order = ["label", "dim", "place", "vec_id"]
    spread = (rows.mapInPandas(placed, "vec_id long, label long, dim int, place binary, v binary").orderBy(*order))
    return stored(spread.mapInPandas(cut, BLOCK), "negatives-blocks")


def anchors_of(blocks: DataFrame, every: int, k: int, tile: int) -> DataFrame:
    """The anchors in the order of the blocks: their tile, their vector, and the score
    that a positive must reach to be among the first ``k`` of the anchor's own block."""

    def unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for b in pdf.itertuples(index=False):
                x, ids = _table([b.vectors], b.dim), np.frombuffer(b.ids, np.int64)
                x = x.reshape(len(ids), b.dim)
                own = np.flatnonzero(ids % every == 0)
                scores = products(x[own], x)
                scores[np.arange(len(own)), own] = NOTHING
                least = np.partition(scores, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(own), NOTHING)
                yield pd.DataFrame({"anchor_id": ids[own], "label": b.label, "dim": b.dim, "part": b.part,
                                    "nth": b.anchors_before + np.arange(len(own)),
                                    "vector": [x[o].tobytes() for o in own], "least": least})

    anchors = blocks.where("anchors > 0").mapInPandas(unpacked, ANCHOR)
    # one row a part of the sort: how many anchors the parts before it have
    counts = blocks.groupBy("part").agg(F.sum("anchors").alias("anchors"))
    earlier = counts.select("part", F.coalesce(F.sum("anchors").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    return stored(anchors.join(earlier, "part").withColumn(
        "tile", F.floor((F.col("earlier") + F.col("nth")) / F.lit(tile)).cast("long")).drop("part", "nth", "earlier"),
        "negatives-anchors")


def _scan(anchors: DataFrame, blocks: DataFrame, same_label: bool, meets, found, schema: str) -> DataFrame:
    """Rows that ``found(tile, scores, ids)`` makes of every tile of anchors and the
    blocks that ``meets(tile, lower, upper)`` lets some anchor of the tile read.

    The zone maps alone are tested first; only the blocks that are left are read."""
    by = ["dim", "label"] if same_label else ["dim"]
    zones = blocks.select("block", "label", "dim", "lo", "hi")
    slices = (zones.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / F.lit(ZONES)).cast("int").alias("slices")))
    cut = F.pmod(F.xxhash64("block"), F.col("slices")).cast("int")
    tiles = anchors.select(*by, "tile").distinct()
    tiles = tiles.toDF(*tiles.columns)  # columns of its own: it meets its source again
    zone_side = zones.join(slices, by).withColumn("slice", cut).join(tiles, by).drop("slices")
    zone_side = zone_side.toDF(*zone_side.columns)
    tile_side = (anchors.join(slices, by)
                 .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices"))

    def test(tile: pd.DataFrame, z: pd.DataFrame) -> pd.DataFrame:
        if not len(tile) or not len(z):
            return pd.DataFrame({"tile": [], "block": [], "readers": []})
        tile = tile.sort_values("anchor_id", ignore_index=True)
        dim = int(tile["dim"].iat[0])
        a = _table(tile["vector"], dim).reshape(len(tile), dim)
        lo, hi = (_table(z[c], dim).reshape(len(z), dim) for c in ("lo", "hi"))
        needs = meets(tile, *bounds(a, lo, hi))
        needs &= (tile["label"].to_numpy()[:, None] == z["label"].to_numpy()[None, :]) == same_label
        hit = np.flatnonzero(needs.any(axis=0))
        return pd.DataFrame({"tile": np.full(len(hit), tile["tile"].iat[0], np.int64),
                             "block": z["block"].to_numpy(np.int64)[hit],
                             "readers": [tile["anchor_id"].to_numpy(np.int64)[needs[:, h]].tobytes() for h in hit]})

    keys = [*by, "tile", "slice"]
    reads = (tile_side.groupBy(*keys).cogroup(zone_side.groupBy(*keys))
             .applyInPandas(test, "tile long, block long, readers binary"))
    some = F.pmod(F.xxhash64("block"), F.col("groups")).cast("int")
    reads = stored(reads, "negatives-reads")
    groups = reads.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / F.lit(TOGETHER)).cast("int").alias("groups"))
    reads = reads.join(groups, "tile").withColumn("group", some).drop("groups")
    block_side = reads.join(blocks.select("block", "dim", "ids", "vectors"), "block")
    block_side = block_side.toDF(*block_side.columns)
    tile_side = (anchors.join(groups, "tile")
                 .withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups"))
    names = [c.split()[0] for c in schema.split(", ")]

    def score(tile: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        made = []
        for dim in (b["dim"].unique() if len(tile) else []):
            of, here = tile[tile["dim"] == dim], b[b["dim"] == dim]
            of = of.sort_values("anchor_id", ignore_index=True)
            ids = np.frombuffer(b"".join(here["ids"]), np.int64)
            x = _table(here["vectors"], dim).reshape(len(ids), dim)
            a = _table(of["vector"], dim).reshape(len(of), dim)
            own = of["anchor_id"].to_numpy(np.int64)
            reads_it = np.zeros((len(own), len(here)), bool)
            for k, readers in enumerate(here["readers"]):
                reads_it[np.searchsorted(own, np.frombuffer(readers, np.int64)), k] = True
            width = [len(i) // 8 for i in here["ids"]]
            for s in range(0, len(own), 256):  # some anchors at a time: bounded memory
                t = slice(s, s + 256)
                scores = products(a[t], x)
                scores[~np.repeat(reads_it[t], width, axis=1)] = NOTHING
                scores[own[t, None] == ids[None, :]] = NOTHING
                made.append(found(of[t], scores, ids))
        made = [m for m in made if len(m)]
        return pd.concat(made) if made else pd.DataFrame({c: [] for c in names})

    return (tile_side.groupBy("tile", "group").cogroup(block_side.groupBy("tile", "group"))
            .applyInPandas(score, schema))


def _first(df: DataFrame, by: list[str], score: str, row: str, k: int, rank: str) -> DataFrame:
    """The first ``k`` rows of each group; tasks keep only their own first ``k``."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), row)
    return df.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)


def hard_negatives(vectors: DataFrame, label=None, every: int = 100, positives: int = 5, negatives: int = 5,
                   least_share: int = 80, scale: int = 256, rows: int = ROWS, tile: int = TILE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for
    the anchors, rows whose ``vec_id`` is a multiple of ``every``: their best
    ``positives`` rows of the same label, and for each the best ``negatives`` rows of
    other labels that score at most as much and at least ``least_share`` percent of it."""
    label = F.col("label") if label is None else label
    blocks = blocks_of(clean_rows(vectors, label, scale), every, rows)
    anchors = anchors_of(blocks, every, positives, tile)

    def reach(tile_, lower, upper):
        return upper >= tile_["least"].to_numpy(np.int64)[:, None]

    def best_rows(tile_, scores, ids):
        i, j = best(scores, ids, positives)
        return pd.DataFrame({"anchor_id": tile_["anchor_id"].to_numpy(np.int64)[i], "positive_id": ids[j],
                             "positive_score": scores[i, j]})

    found = _scan(anchors, blocks, True, reach, best_rows,
                  "anchor_id long, positive_id long, positive_score long")
    pairs = stored(_first(found, ["anchor_id"], "positive_score", "positive_id", positives, "nth"), "positives")

    wanted = pairs.groupBy("anchor_id").agg(F.sort_array(F.collect_list(
        F.struct("nth", "positive_id", "positive_score"))).alias("p"))  # at most ``positives`` an anchor
    looking = stored(anchors.drop("least").join(wanted, "anchor_id").select(
        "*", F.col("p.positive_id").alias("ids"), F.col("p.positive_score").alias("tops")).drop("p"), "windows")

    def windows(tile_):
        tops = np.full((len(tile_), positives), NOTHING, np.int64)
        for r, t in enumerate(tile_["tops"]):
            tops[r, :len(t)] = t
        whole, rest = np.divmod(np.maximum(tops, 0), 100)
        lows = whole * least_share - (rest * -least_share) // 100  # rounded up, no overflow
        return np.where(tops >= 0, lows, 0), np.where(tops >= 0, tops, -1)  # a negative top: nothing fits

    def meet(tile_, lower, upper):
        low, top = windows(tile_)
        needs = np.zeros(lower.shape, bool)
        for w in range(positives):
            needs |= (upper >= low[:, w, None]) & (lower <= top[:, w, None]) & (top[:, w, None] >= 0)
        return needs

    def best_in_windows(tile_, scores, ids):
        low, top = windows(tile_)
        own, made = tile_["anchor_id"].to_numpy(np.int64), []
        for w in range(positives):
            fits = (scores >= low[:, w, None]) & (scores <= top[:, w, None])
            i, j = best(np.where(fits, scores, NOTHING), ids, negatives)
            made.append(pd.DataFrame({"anchor_id": own[i], "positive_id": [tile_["ids"].iat[r][w] for r in i],
                                      "negative_id": ids[j], "positive_score": top[i, w],
                                      "negative_score": scores[i, j]}))
        return pd.concat(made)

    found = _scan(looking, blocks, False, meet, best_in_windows,
                  "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    out = _first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives, "rank")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), moved)


#: All rows against all anchors, in DuckDB.
ORACLE = """
with v as (
  select vec_id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as integer) as label,
    list_transform(cast(embedding as double[]), lambda x: floor(256 * x)) as e
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (
  select a.vec_id as a, b.vec_id as b, a.label = b.label as same,
    cast(list_inner_product(a.e, b.e) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) where a.vec_id % 100 = 0),
p as (
  select a, b, score from (select *, row_number() over (partition by a order by score desc, b) as k from s where same)
  where k <= 5),
n as (
  select p.a, p.b, s.b as c, p.score as positive, s.score as negative,
    row_number() over (partition by p.a, p.b order by s.score desc, s.b) as k
  from p join s on s.a = p.a and not s.same
  where 80 * p.score <= 100 * s.score and 100 * s.score <= 100 * p.score)
select a as anchor_id, b as positive_id, cast(k as integer) as rank, c as negative_id,
  positive as positive_score, negative as negative_score
from n where k <= 5
"""
