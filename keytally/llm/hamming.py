"""All pairs of 64-bit fingerprints within a few differing bits, through block tables.

The 64 bits are cut into ``radius + agree`` blocks.  Two fingerprints that differ
in at most ``radius`` bits differ in at most ``radius`` blocks, so they share some
``agree`` blocks whole: one table per choice of ``agree`` blocks, keyed by those
bits, brings every such pair into one bucket.  Inside a bucket the distance is
counted exactly.

A bucket of more than ``tile`` fingerprints is cut into tiles by a hash, and each
pair of tiles is compared by itself, so no task holds more than two tiles of a hot
bucket and no pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 64


def block_bounds(blocks: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each block; widths differ by one at most."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:], strict=False)]


def table_masks(radius: int, agree: int) -> list[int]:
    """The bits that must agree, for each block table."""
    bounds = block_bounds(radius + agree)
    return [sum(((1 << w) - 1) << lo for lo, w in some) for some in combinations(bounds, agree)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _keys(fp: Column, masks: list[int]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(t).alias("t"), fp.bitwiseAND(F.lit(_signed(m))).alias("key"))
                               for t, m in enumerate(masks)]))


def bucket_rows(fps: DataFrame, radius: int, agree: int, tile: int) -> DataFrame:
    """Rows (t, key, lo, hi, side, fp, n): every bucket of two or more fingerprints,
    cut into tile pairs ``lo <= hi``."""
    rows = fps.select("fp", "n", _keys(F.col("fp"), table_masks(radius, agree)).alias("k")) \
              .select("fp", "n", "k.t", "k.key")
    size = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    tiles = F.ceil(F.col("rows") / F.lit(tile)).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("tiles")).cast("int")
    cut = (rows.join(size, ["t", "key"]).withColumn("tiles", tiles).withColumn("own", own)
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))))
    return cut.select("t", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                      F.when(F.col("own") == F.least("own", "other"), 0).otherwise(1).alias("side"), "fp", "n")


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted batches regrouped so that no (t, key, lo, hi) is cut in two."""
    cols = ["t", "key", "lo", "hi"]
    rest = None
    for pdf in batches:
        if not len(pdf):
            continue
        if rest is not None:
            pdf = pd.concat([rest, pdf], ignore_index=True)
        last = pdf[cols].iloc[-1].to_numpy()
        open_from = int(np.argmax((pdf[cols].to_numpy() == last).all(axis=1)))
        if open_from:
            yield pdf.iloc[:open_from]
        rest = pdf.iloc[open_from:]
    if rest is not None:
        yield rest


def _starts(pdf: pd.DataFrame) -> np.ndarray:
    k = pdf[["t", "key", "lo", "hi"]].to_numpy()
    new = np.r_[True, (k[1:] != k[:-1]).any(axis=1)]
    return np.flatnonzero(new)


SMALL = 48  # groups up to this size are compared together, offset by offset
ROWS = 512  # rows of a larger group that meet all the others at a time


def _close(pdf: pd.DataFrame, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), i < j, of a batch within ``radius``.  In a bucket of two
    different tiles only pairs across them count."""
    fp = pdf["fp"].to_numpy().view(np.uint64)
    side = pdf["side"].to_numpy()
    cross = (pdf["lo"] != pdf["hi"]).to_numpy()
    at = _starts(pdf)
    size = np.diff(np.r_[at, len(pdf)])
    gid = np.repeat(np.arange(len(at)), size)
    small = size <= SMALL
    if small.any():
        idx = np.flatnonzero(small[gid])
        f, g, s, c = fp[idx], gid[idx], side[idx], cross[idx]
        for d in range(1, int(size[small].max())):
            hit = (g[d:] == g[:-d]) & (np.bitwise_count(f[d:] ^ f[:-d]) <= radius)
            hit &= ~c[d:] | (s[d:] != s[:-d])
            i = np.flatnonzero(hit)
            if len(i):
                yield idx[i], idx[i + d]
    for k in np.flatnonzero(~small):
        lo, n = at[k], size[k]
        f, s = fp[lo:lo + n], side[lo:lo + n]
        for r in range(0, n, ROWS):
            near = np.bitwise_count(f[r:r + ROWS, None] ^ f[None, :]) <= radius
            if cross[lo]:
                near &= s[r:r + ROWS, None] != s[None, :]
            i, j = np.nonzero(near)
            keep = i + r < j
            if keep.any():
                yield i[keep] + r + lo, j[keep] + lo


def _roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index reachable over the pairs, taken block by block."""
    root = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = root[i], root[j]
            if (a == b).all():
                break
            low, high = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(root, high, low)
            while (root[root] != root).any():
                root = root[root]
    return root


def near_links(fps: DataFrame, radius: int, agree: int = 2, tile: int = 2048) -> DataFrame:
    """Links (a, b) between distinct fingerprints whose closure is the closure of
    all pairs within ``radius``: each bucket gives a spanning forest, not its pairs.

    ``fps``: distinct ``fp`` (long) with ``n`` (rows that carry it).
    """
    rows = bucket_rows(fps, radius, agree, tile)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _groups(batches):
            fp = pdf["fp"].to_numpy()
            root = _roots(len(fp), _close(pdf, radius))
            i = np.flatnonzero(root != np.arange(len(fp)))
            if len(i):
                yield pd.DataFrame({"a": fp[i], "b": fp[root[i]]}).drop_duplicates()

    return _sorted(rows).mapInPandas(compare, "a long, b long").distinct()


def near_counts(fps: DataFrame, radius: int, agree: int = 2, tile: int = 2048) -> DataFrame:
    """(fp, near): for each distinct fingerprint with another one within ``radius``,
    the number of rows that carry those others.

    A pair that several tables bring together is counted in the first of them.
    """
    masks = np.array(table_masks(radius, agree), dtype=np.uint64)
    rows = bucket_rows(fps, radius, agree, tile)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _groups(batches):
            fp, n, t = pdf["fp"].to_numpy(), pdf["n"].to_numpy(), pdf["t"].to_numpy()
            bits = fp.view(np.uint64)
            near = np.zeros(len(fp), dtype=np.int64)
            for i, j in _close(pdf, radius):
                apart = bits[i] ^ bits[j]
                first = np.ones(len(i), dtype=bool)
                for k, m in enumerate(masks):
                    first &= (t[i] <= k) | ((apart & m) != 0)
                i, j = i[first], j[first]
                np.add.at(near, i, n[j])
                np.add.at(near, j, n[i])
            hit = np.flatnonzero(near)
            if len(hit):
                yield pd.DataFrame({"fp": fp[hit], "near": near[hit]})

    return _sorted(rows).mapInPandas(compare, "fp long, near long").groupBy("fp").agg(F.sum("near").alias("near"))


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition("t", "key", "lo", "hi").sortWithinPartitions("t", "key", "lo", "hi")
