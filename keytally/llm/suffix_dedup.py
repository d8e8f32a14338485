"""Suffix-array dedup: every byte covered by a string of ``LENGTH`` bytes that also
starts anywhere else is removed.

Finding candidates.  Of each window of LENGTH bytes the gram of ``GRAM`` bytes with
the smallest hash is its anchor.  Equal windows have equal anchors at equal places, so
a window can only repeat if its anchor's hash does.  Each run of windows that share an
anchor is a region: the bytes those windows cover.

Deciding.  Equal regions of a repeated anchor are one row with a count (told apart by
a digest beside the anchor's hash); a region alone with its anchor has only its own
copies to repeat.  Where an anchor has different regions, one of each is fetched from
its document, and they meet in a bucket.  Their bytes to the right of the anchor, cut into blocks that become symbols
in order, are concatenated and put in order by a suffix array (``suffix_array``:
suffixes are grouped by Lyndon prefix, groups in descending order, through
previous-smaller pointers; a second pass emits the order).  The bytes to the left,
read backwards, likewise.  Neighbours' common lengths in both orders then tell, for
each of a region's windows, how many regions hold the same bytes: those in one class
to the right and one class to the left.

Very frequent anchors.  Of more than ``HOT`` regions of one anchor, two hold the same
window only if they share the ``HALF`` bytes left of the anchor (windows that start as
far before it) or else the ``LENGTH - HALF + 1`` bytes from it on: such regions meet in
groups by those bytes.  Where a group is still that large, its windows are counted by
digest, a row each, without meeting in one task.

Removing.  Repeated windows go back to the documents that hold the region, where the
covered runs are cut out.  Texts are dealt to chunks by a hash, never to one task.

Defined cases: a null text is empty (0 bytes, the hash of nothing); texts shorter than
LENGTH have no windows; the two or more places of a repeat within one document count;
rows repeated whole repeat each other; null ids keep their rows; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keytally.llm.common import stored, table

LENGTH = 400
GRAM = 128
CHUNK = 8 << 20  # bytes of text in a chunk, about
PIECE = 1 << 22  # window starts worked on at a time
SYMBOL = 40  # bytes of a region that make a symbol
HALF = (LENGTH - GRAM) // 2
HOT = 1024  # regions that meet in one task for their anchor at most
_PLACE = np.uint64((1 << 24) - 1)


# --- suffix array ---------------------------------------------------------------------

def suffix_array(text: list[int]) -> list[int]:
    """The order of the suffixes of ``text``, whose last symbol is its only smallest one.

    First pass: suffixes start out grouped by symbol.  Groups are taken in descending
    order; each suffix of the group points to the nearest one before it in a lower
    group, and the suffixes pointed to, whose prefix the group's now extends, are moved
    to new groups above the rest of their own, the more often pointed to the higher.
    At the end a suffix's group is that of its longest Lyndon prefix.
    Second pass: in ascending order, each suffix emitted lets the one before it, and
    those along its pointers, take the next place of their groups.
    """
    n = len(text)
    sa = sorted(range(n), key=text.__getitem__)
    place, group, last = [0] * n, [0] * n, [0] * n
    start = 0
    for k, s in enumerate(sa):
        place[s] = k
        if text[s] != text[sa[start]]:
            start = k
        group[s] = start
        last[start] = k
    before = [-1] * n
    top = n
    while top:
        g = group[sa[top - 1]]
        pointed: dict[int, int] = {}
        for s in sorted(sa[g:top]) if top - g > 1 else sa[g:top]:
            p = s - 1
            while p >= 0:
                at = group[p]
                if at < g:
                    break
                p = before[p]
                if at == g:
                    break
            before[s] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        top = g
        by_group: dict[int, list[tuple[int, int]]] = {}
        for p, times in pointed.items():
            by_group.setdefault(group[p], []).append((times, p))
        for h, moved in by_group.items():
            if len(moved) > 1:
                moved.sort(reverse=True)
            end = last[h]
            t, k = end, 0
            while k < len(moved):
                times, stop = moved[k][0], t
                first = k
                while k < len(moved) and moved[k][0] == times:
                    p, other = moved[k][1], sa[t]
                    q = place[p]
                    sa[q], sa[t] = other, p
                    place[other], place[p] = q, t
                    t -= 1
                    k += 1
                for _, p in moved[first:k]:
                    group[p] = t + 1
                last[t + 1] = stop
            if t >= h:
                last[h] = t
    out, nxt, done = [0] * n, list(range(n)), [False] * n
    out[0] = n - 1
    done[n - 1] = True
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            out[nxt[g]] = s
            nxt[g] += 1
            done[s] = True
            s = before[s]
    return out


def _ordered(rows: np.ndarray) -> np.ndarray:
    """The order of equally long byte rows, through the suffix array of their blocks."""
    m, width = rows.shape
    pad = -width % SYMBOL
    blocks = np.pad(rows, ((0, 0), (0, pad))).reshape(-1, SYMBOL)
    words = np.ascontiguousarray(blocks).view(">u8")
    order = np.lexsort(words.T[::-1])
    in_order = words[order]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(np.r_[True, (in_order[1:] != in_order[:-1]).any(axis=1)]) + 1
    per = (width + pad) // SYMBOL
    text = np.ones((m, per + 1), np.int64)  # 1 ends a row, 0 the text
    text[:, :per] = rank.reshape(m, per)
    sa = np.array(suffix_array([*text.ravel().tolist(), 0]))
    heads = sa[(sa % (per + 1) == 0) & (sa < m * (per + 1))]
    return heads // (per + 1)


def _common(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How many bytes each row in order shares with the one before it."""
    a = rows[order]
    differ = a[1:] != a[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return np.r_[0, shared]


def repeated_windows(regions: list[bytes], anchor: np.ndarray, count: np.ndarray,
                     length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Which windows of distinct regions occur in more than one place: booleans, a row
    for each region and a column for each start before its anchor (0 first)."""
    m, most = len(regions), length - gram
    size = np.array([len(r) for r in regions])
    right = np.zeros((m, length), np.uint8)
    left = np.zeros((m, most), np.uint8)
    for k, r in enumerate(regions):
        b = np.frombuffer(r, np.uint8)
        tail, head = b[anchor[k]:][:length], b[:anchor[k]][::-1]
        right[k, :len(tail)] = tail
        left[k, :len(head)] = head
    shared = []
    for rows in (right, left):
        order = _ordered(rows)
        shared.append((order, _common(rows, order)))
    # region k has the windows that start `back` bytes before its anchor, for back in:
    farthest, nearest = anchor, anchor - (size - length)
    out = np.zeros((m, most + 1), bool)
    classes = [np.empty(m, np.int64), np.empty(m, np.int64)]
    for back in range(int(max(0, nearest.min())), int(farthest.max()) + 1):
        own = np.flatnonzero((back >= nearest) & (back <= farthest))
        if not len(own):
            continue
        for c, (order, common), depth in zip(classes, shared, (length - back, back), strict=True):
            c[order] = np.cumsum(common < depth)
        _, inverse = np.unique(classes[0][own] * (m + 1) + classes[1][own], return_inverse=True)
        out[own, back] = np.bincount(inverse, count[own])[inverse] > 1
    return out


# --- anchors --------------------------------------------------------------------------

_rng = np.random.default_rng(400)
_BYTE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = int(_rng.integers(0, 1 << 62)) * 2 + 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_up = _powers(_BASE, 1)
_down = _powers(1, 1)


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every gram: a polynomial modulo 2^64, then mixed."""
    global _up, _down
    if len(_up) <= len(data):
        n = max(len(data) + 1, 1 << 20)
        _up, _down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
    sums = np.cumsum(_BYTE[data] * _up[:len(data)], dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), sums])
    h = (sums[gram:] - sums[:-gram]) * _down[:len(data) - gram + 1]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _smallest(v: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        v = np.minimum(v[:-span], v[span:])
        span *= 2
    rest = width - span
    return np.minimum(v[:len(v) - rest], v[rest:]) if rest else v


def anchors(pieces: list[tuple[int, int, np.ndarray]], length: int = LENGTH, gram: int = GRAM):
    """(key, anchor's hash, digest of the region, first window start, anchor's place in
    the region, region's size) of each run of windows with one anchor.  ``pieces``:
    (key, offset in the document, bytes), each of ``length`` bytes or more; together
    they stay below 2^24 bytes."""
    data = np.concatenate([p[2] for p in pieces])
    size = np.array([len(p[2]) for p in pieces])
    end = np.cumsum(size)
    h = _gram_hashes(data, gram)
    value = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    place = (_smallest(value, length - gram + 1) & _PLACE).astype(np.int64)
    start = np.arange(len(place))
    piece = np.searchsorted(end, start, side="right")
    whole = start + length <= end[piece]  # the window lies in one piece
    first = np.flatnonzero(whole & np.r_[True, (place[1:] != place[:-1]) | ~whole[:-1]
                                         | (piece[1:] != piece[:-1])])
    last = np.flatnonzero(whole & np.r_[(place[1:] != place[:-1]) | ~whole[1:] | (piece[1:] != piece[:-1]), True])
    at = piece[first]
    shift = np.array([p[1] for p in pieces])[at] - (end - size)[at]
    key = np.array([p[0] for p in pieces])[at]
    anchor, size = place[first] - first, last - first + length
    raw = data.tobytes()
    digest = np.array([xxhash.xxh3_64_intdigest(raw[a:a + n], p) for a, n, p in
                       zip(first.tolist(), size.tolist(), anchor.tolist(), strict=True)], dtype=np.uint64)
    return key, h[place[first]].view(np.int64), digest.view(np.int64), first + shift, anchor, size


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _find_anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cols = ["key", "h", "d", "lo", "anchor", "size"]
    for pdf in batches:
        pieces, size = [], 0
        for key, text in zip(pdf["key"], pdf["text"], strict=True):
            b = np.frombuffer(_raw(text), np.uint8)
            for r in range(0, len(b) - LENGTH + 1, PIECE):
                part = b[r:r + PIECE + LENGTH - 1]
                pieces.append((key, r, part))
                size += len(part)
                if size >= PIECE:
                    yield pd.DataFrame(dict(zip(cols, anchors(pieces), strict=True)))
                    pieces, size = [], 0
        if pieces:
            yield pd.DataFrame(dict(zip(cols, anchors(pieces), strict=True)))


# --- very frequent anchors ------------------------------------------------------------

def _halves(anchor: int, size: int) -> list[tuple[int, int, int]]:
    """(half, first, last) start of a region's windows before its anchor: those nearer
    than ``HALF``, and the others."""
    near, far = max(0, anchor - (size - LENGTH)), anchor
    return [(half, a, b) for half, a, b in ((0, near, min(far, HALF - 1)), (1, max(near, HALF), far)) if a <= b]


def _split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Halves of hot anchors' regions with the part they meet in: that of the bytes that
    all windows of the half have."""
    cols = ["h", "d", "n", "anchor", "region", "half", "part"]
    for pdf in batches:
        out = []
        for r in pdf.itertuples():
            b, at = bytes(r.region), r.anchor
            for half, _, _ in _halves(at, len(b)):
                own = b[at - HALF:at] if half else b[at:at + LENGTH - HALF + 1]
                part = xxhash.xxh3_64_intdigest(own, (r.h + half) % (1 << 64))
                out.append((r.h, r.d, r.n, at, b, half, part - (1 << 63)))
        yield pd.DataFrame(out, columns=cols)


def _single_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each window of a region's half."""
    cols = ["h", "d", "n", "anchor", "back", "w"]
    for pdf in batches:
        for at in range(0, len(pdf), 256):
            out = []
            for r in pdf.iloc[at:at + 256].itertuples():
                b = bytes(r.region)
                for half, first, last in _halves(r.anchor, len(b)):
                    if half == r.half:
                        out += [(r.h, r.d, r.n, r.anchor, k, xxhash.xxh3_128_digest(b[r.anchor - k:][:LENGTH]))
                                for k in range(first, last + 1)]
            yield pd.DataFrame(out, columns=cols)


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of neighbouring windows."""
    for pdf in batches:
        out = []
        for r in pdf.itertuples():
            backs = np.sort(np.asarray(r.backs, np.int64))
            cut = np.flatnonzero(np.diff(backs) > 1)
            for lo, hi in zip(backs[np.r_[0, cut + 1]].tolist(), backs[np.r_[cut, len(backs) - 1]].tolist(), strict=True):
                out.append((r.h, r.d, r.anchor - hi, r.anchor - lo + LENGTH))
        yield pd.DataFrame(out, columns=["h", "d", "a", "b"])


def _counted_windows(regions: DataFrame) -> DataFrame:
    """(h, d, a, b) of the repeated windows of regions whose groups are too large."""
    single = stored(regions.mapInPandas(
        _single_windows, "h long, d long, n long, anchor int, back int, w binary"), "windows")
    twice = stored(single.groupBy("h", "back", "w").agg(F.sum("n").alias("n")).where("n > 1")
                   .select("h", "back", "w"), "repeated_windows")
    return (single.join(twice, ["h", "back", "w"]).groupBy("h", "d", "anchor")
            .agg(F.collect_set("back").alias("backs"))
            .mapInPandas(_joined, "h long, d long, a long, b long"))


# --- the operator ---------------------------------------------------------------------

def _cut_out(text: bytes, runs: np.ndarray) -> tuple[int, int, str]:
    """(bytes removed, maximal runs, sha256 of the rest) for covered runs (from, to)."""
    kept, removed, spans, at, end = hashlib.sha256(), 0, 0, 0, -1
    for a, b in runs[np.lexsort((runs[:, 1], runs[:, 0]))].tolist() if len(runs) else []:
        if a > end:
            spans += 1
            kept.update(text[at:a])
            removed += b - a
            at = end = b
        elif b > end:
            removed += b - end
            at = end = b
    kept.update(text[at:])
    return removed, spans, kept.hexdigest()


def repeats_removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK,
                    hot: int = HOT) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-total // chunk))
    buckets = max(64, 2 * chunks)
    # rows that are equal throughout share a key, and so each other's repeats
    rows = rows.withColumn("key", F.xxhash64("id", "text"))
    dealt = rows.withColumn("chunk", F.pmod("key", F.lit(chunks)).cast("int"))
    kind = dict(rows.dtypes)["id"]

    found = stored(rows.select("key", "text").mapInPandas(
        _find_anchors, "key long, h long, d long, lo long, anchor int, size int"), "anchors")
    # written: the join below can then split the rows of a very frequent anchor
    twice = stored(found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "repeated")
    # the same plan at every size: a side that is broadcast only while it is small would
    # let the shuffle grow faster than the input
    hits = stored(found.join(twice.hint("merge"), "h"), "hits")
    per = stored(hits.groupBy("h", "d").agg(F.count(F.lit(1)).alias("n"), F.min("anchor").alias("anchor"),
                                            F.min("size").alias("size"),
                                            F.min(F.struct("key", "lo")).alias("at")), "regions")
    mixed = per.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    any_hot = bool(mixed.where(F.col("kinds") > hot).head(1))
    alone = (per.where("n > 1").join(mixed.select("h"), "h", "left_anti")
             .select("h", "d", F.lit(0).cast("long").alias("a"), F.col("size").cast("long").alias("b")))
    wanted = (per.join(mixed, "h")
              .select("h", "d", "n", "anchor", "size", "at.key", "at.lo", (F.col("kinds") > hot).alias("hot"),
                      F.pmod("at.key", F.lit(chunks)).cast("int").alias("chunk")))

    def take_regions(texts: pd.DataFrame, want: pd.DataFrame) -> pd.DataFrame:
        cols = ["h", "d", "n", "anchor", "hot", "region"]
        if not len(want) or not len(texts):
            return pd.DataFrame([], columns=cols)
        keys = set(want["key"])
        raw = {k: _raw(t) for k, t in zip(texts["key"], texts["text"], strict=True) if k in keys}
        return pd.DataFrame([(r.h, r.d, r.n, r.anchor, r.hot, raw[r.key][r.lo:r.lo + r.size])
                             for r in want.itertuples()], columns=cols)

    # written at every size: the texts are then dealt once for the regions and once for the
    # removal, whether or not an anchor is hot, and the shuffle grows as the input does
    regions = stored(dealt.groupBy("chunk").cogroup(wanted.groupBy("chunk")).applyInPandas(
        take_regions, "h long, d long, n long, anchor int, hot boolean, region binary"), "region_bytes")
    if any_hot:
        # only the regions of hot anchors are written again, a row for each half
        parts = stored(regions.where("hot").mapInPandas(
            _split, "h long, d long, n long, anchor int, region binary, half int, part long"), "parts")
        size = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("uses"))
        large = stored(size.where(F.col("n") > hot).select("part"), "large_parts")
        # a region by itself in its part repeats nothing
        out = size.where((F.col("n") > hot) | (F.col("uses") == 1)).select("part")
        if large.head(1):
            alone = alone.unionByName(_counted_windows(parts.join(large, "part", "left_semi")))
        parts = parts.join(out, "part", "left_anti")
    regions = regions.where("not hot").drop("hot").withColumn("half", F.lit(-1)).withColumn("part", F.col("h"))
    if any_hot:
        regions = regions.unionByName(parts)
    # the halves of a region are apart: they would repeat each other
    regions = regions.select("h", "d", "n", "anchor", "region", (
        F.pmod(F.xxhash64("part"), F.lit(buckets)) + (F.col("half") + 1) * buckets).cast("int").alias("bucket"))

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        h, d = pdf["h"].to_numpy(), pdf["d"].to_numpy()
        anchor = pdf["anchor"].to_numpy().astype(np.int64)
        hit = repeated_windows(pdf["region"].tolist(), anchor, pdf["n"].to_numpy())
        edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, first = np.nonzero(edge == 1)  # runs of windows first..stop-1 bytes before the anchor
        _, stop = np.nonzero(edge == -1)
        return pd.DataFrame({"h": h[row], "d": d[row], "a": anchor[row] - (stop - 1),
                             "b": anchor[row] - first + LENGTH})

    runs = regions.groupBy("bucket").applyInPandas(decide, "h long, d long, a long, b long").unionByName(alone)
    spans = (hits.select("h", "d", "key", "lo").join(runs, ["h", "d"])
             .select(F.pmod("key", F.lit(chunks)).cast("int").alias("chunk"), "key",
                     (F.col("lo") + F.col("a")).alias("a"), (F.col("lo") + F.col("b")).alias("b")))

    def remove(texts: pd.DataFrame, span: pd.DataFrame) -> pd.DataFrame:
        by_key = {k: g[["a", "b"]].to_numpy() for k, g in span.groupby("key")} if len(span) else {}
        none, out = np.empty((0, 2), np.int64), []
        for r in texts.itertuples():
            raw = _raw(r.text)
            out.append((r.id, len(raw), *_cut_out(raw, by_key.get(r.key, none))))
        return pd.DataFrame(out, columns=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    done = dealt.groupBy("chunk").cogroup(spans.groupBy("chunk")).applyInPandas(
        remove, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return done.withColumnRenamed("id", id_col)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_removed(table(spark, sf_dir, "documents"))
