"""Language-model scores by context-tree weighting over bytes.

A text is its tokens: words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, joined by one
space, then an end (a line feed, which no word holds).  Every byte is decided bit by
bit; each of its 255 binary decisions has a context tree over the ``DEPTH`` bytes in
front of it.  A node's Krichevsky-Trofimov estimate from the training counts is mixed
with what its children give, each with weight 1/2 a priori, so the weights follow from
the training text itself and all depths take part in every prediction.  A context that
training never met predicts 1/2 below the depth where it is new.

How it runs.  Documents are dealt by a hash to chunks of about ``CHUNK`` bytes.
1. Each chunk sends its distinct windows (a byte and its ``DEPTH`` bytes of context)
   and distinct words, with training counts, to buckets: windows by the two bytes
   next to the predicted one, words by hash.  Held-out windows go along with count 0.
2. Each bucket adds up its counts and weights its trees from the leaves to depth 2;
   the sums for depths 1 and 0 (65,280 nodes at most, whatever the corpus) go to the
   driver, which weights these and sends them back.
3. Each bucket answers every chunk with the log probabilities of its windows.
4. Each chunk adds up its documents' scores.
So the counts gathered and the answers grow with the corpus, and no task holds more
than a chunk or a bucket.  The unigram base score takes the same way.

Defined cases: a null text is empty (one end token); null ids are held out; repeated
ids and rows are scored alike; without training documents counts are 0 and every bit
has probability 1/2; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keytally.llm.common import fold, stored, table
from keytally.llm.fingerprints import _hashes

DEPTH = 5
CHUNK = 8 << 20  # bytes of text in a chunk, about
BLOCK = 1 << 16  # positions worked on at a time: a code (48 bits) and its place fill a number
MODULUS, HELD = 7, 2
GRAM, WORD = 0, 1
_PAD = b"\n" * DEPTH
_LOG2 = math.log(2.0)


def normal(text: str | None) -> tuple[bytes, list[bytes]]:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return b" ".join(words) + b"\n", words


def _pack(a: np.ndarray) -> bytes:
    return zlib.compress(a.tobytes(), 1)


def _unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zlib.decompress(b), dtype=kind)


def _pack_keys(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_keys(b: bytes) -> np.ndarray:
    return np.cumsum(_unpack(b, np.uint64), dtype=np.uint64)


def window_codes(data: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Codes of positions start..stop (DEPTH or more): the context, nearest byte on
    top, then the byte itself."""
    code = data[start:stop].astype(np.uint64)
    for k in range(1, DEPTH + 1):
        code |= data[start - k:stop - k].astype(np.uint64) << np.uint64(8 * (DEPTH + 1 - k))
    return code


class Chunk:
    """The documents of a chunk as one run of bytes, and their words' hashes."""

    def __init__(self, pdf: pd.DataFrame):
        parts, self.words = [], []
        for text in pdf["text"]:
            line, words = normal(text)
            parts.append(_PAD + line)
            self.words.append(np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words)))
        size = np.array([len(p) for p in parts])
        self.end = np.cumsum(size)
        self.start = self.end - size
        self.data = np.frombuffer(b"".join(parts), np.uint8)

    def blocks(self):
        """(codes, document numbers) of all text positions, block by block."""
        for r in range(DEPTH, len(self.data), BLOCK):
            stop = min(r + BLOCK, len(self.data))
            first, last = np.searchsorted(self.end, [r, stop - 1], side="right")
            own = slice(first, last + 1)
            doc = np.repeat(np.arange(first, last + 1, dtype=np.int32),
                            np.minimum(self.end[own], stop) - np.maximum(self.start[own], r))
            text = np.arange(r, stop) >= self.start[doc] + DEPTH
            yield window_codes(self.data, r, stop)[text], doc[text]

    def numbered(self):
        """(distinct codes, each position's place among them, document numbers), block
        by block: whoever looks a code up does so once a block, not once a position."""
        for code, doc in self.blocks():
            both = (code << np.uint64(16)) | np.arange(len(code), dtype=np.uint64)
            both.sort()
            in_order = both >> np.uint64(16)
            new = np.r_[True, in_order[1:] != in_order[:-1]][:len(code)]
            place = np.empty(len(code), np.int32)
            place[(both & np.uint64(0xFFFF)).astype(np.int64)] = np.cumsum(new) - 1
            yield in_order[new], place, doc

    def grams(self, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct window codes and their training counts."""
        keys, counts = [], []
        for k, inverse, doc in self.numbered():
            keys.append(k)
            counts.append(np.bincount(inverse, train[doc], len(k)).astype(np.int64))
        return _added(np.concatenate(keys), np.concatenate(counts))

    def distinct_words(self, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate(self.words)
        weight = np.repeat(train.astype(np.int64), [len(w) for w in self.words])
        return _added(every, weight)


def _distinct(parts: list[np.ndarray]) -> np.ndarray:
    keys = np.sort(np.concatenate(parts))
    return keys[np.r_[True, keys[1:] != keys[:-1]][:len(keys)]]


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


def bucket_of(keys: np.ndarray, kind: int, buckets: int) -> np.ndarray:
    """Windows with the same two nearest context bytes share a bucket."""
    k = keys >> np.uint64(8 * (DEPTH - 1)) if kind == GRAM else keys
    return ((k * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(buckets)


def lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 1/2: Stirling's series at x + 8, stepped down."""
    shift = np.log(x)
    for k in range(1, 8):
        shift += np.log(x + k)
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z ** 3) - shift


def kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return lgamma(zeros + 0.5) + lgamma(ones + 0.5) - lgamma(zeros + ones + 1.0) - math.log(math.pi)


def _nodes(codes: np.ndarray, counts: np.ndarray, depth: int, bit: int):
    """(key, zeros, ones) of the nodes that decide bit ``bit`` after ``depth`` bytes.
    ``codes`` hold ``depth`` context bytes and the byte, in order; a key holds the
    context and the bits decided so far behind a leading 1."""
    byte = codes & np.uint64(255)
    prefix = (byte >> np.uint64(8 - bit)) | np.uint64(1 << bit)
    key = ((codes >> np.uint64(8)) << np.uint64(8)) | prefix
    one = ((byte >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.int64) * counts
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    total, ones = np.add.reduceat(counts, first), np.add.reduceat(one, first)
    return key[first], (total - ones).astype(np.float64), ones.astype(np.float64)


def _shorter(codes: np.ndarray, counts: np.ndarray):
    """Windows with the farthest context byte dropped."""
    return _added(((codes >> np.uint64(16)) << np.uint64(8)) | (codes & np.uint64(255)), counts)


def weigh(codes: np.ndarray, counts: np.ndarray, deepest: int, top: int):
    """Nodes of depths ``deepest``..``top`` with their weights: {(depth, bit): (key,
    probability of 1, weight of the node's own estimate, log of the weighted
    probability, zeros, ones)}."""
    out = {}
    below = {}
    for depth in range(deepest, top - 1, -1):
        for bit in range(8):
            key, zeros, ones = _nodes(codes, counts, depth, bit)
            own = kt(zeros, ones)
            if depth == deepest:
                mixed, weight = own, np.ones(len(key))
            else:
                child_key, child_mixed = below[bit]
                parent = ((child_key >> np.uint64(16)) << np.uint64(8)) | (child_key & np.uint64(255))
                rest = np.bincount(np.searchsorted(key, parent), child_mixed, len(key))
                mixed = np.logaddexp(own, rest) - _LOG2
                weight = np.exp(own - _LOG2 - mixed)
            below[bit] = (key, mixed)
            out[depth, bit] = (key, (ones + 0.5) / (zeros + ones + 1.0), weight, mixed, zeros, ones)
        codes, counts = _shorter(codes, counts)
    return out


def log10_windows(codes: np.ndarray, nodes: dict, deepest: int = DEPTH) -> np.ndarray:
    """log10 of the probability of each window's byte after its context."""
    total = np.zeros(len(codes))
    byte = codes & np.uint64(255)
    for bit in range(8):
        p = np.full(len(codes), 0.5)
        prefix = (byte >> np.uint64(8 - bit)) | np.uint64(1 << bit)
        for depth in range(deepest, -1, -1):
            key, own, weight = nodes[depth, bit][:3]
            if not len(key):
                continue
            context = codes >> np.uint64(8 * (deepest - depth + 1))
            want = (context << np.uint64(8)) | prefix
            at = np.minimum(np.searchsorted(key, want), len(key) - 1)
            p = np.where(key[at] == want, weight[at] * own[at] + (1 - weight[at]) * p, p)
        one = (byte >> np.uint64(7 - bit)) & np.uint64(1) == 1
        total += np.log10(np.where(one, p, 1 - p))
    return total


def top_nodes(rows: pd.DataFrame) -> dict:
    """Depths 1 and 0 from the sums over depth 2: columns key (nearest byte and bits
    decided), bit, zeros, ones, below (sum of the children's log probabilities)."""
    out = {}
    for bit in range(8):
        r = rows[rows["bit"] == bit].sort_values("key")
        key, zeros, ones = r["key"].to_numpy().astype(np.uint64), r["zeros"].to_numpy(float), r["ones"].to_numpy(float)
        below = r["below"].to_numpy(float)
        for depth in (1, 0):
            if len(key):
                own = kt(zeros, ones)
                mixed = np.logaddexp(own, below) - _LOG2
                out[depth, bit] = (key, (ones + 0.5) / (zeros + ones + 1.0), np.exp(own - _LOG2 - mixed))
                up, inverse = np.unique(key & np.uint64(255), return_inverse=True)
                key, below = up, np.bincount(inverse, mixed)
                zeros, ones = np.bincount(inverse, zeros), np.bincount(inverse, ones)
            else:
                out[depth, bit] = (key, np.empty(0), np.empty(0))
    return out


def _bucket_grams(pdf: pd.DataFrame):
    """All windows of a bucket, in order, with their training counts."""
    keys = [_unpack_keys(b) for b in pdf["keys"]]
    return keys, *_added(np.concatenate(keys), np.concatenate([_unpack(b, np.int64) for b in pdf["counts"]]))


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row per document: id, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score``, ``score`` and ``bits_per_byte``."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       fold(F.col(id_col), MODULUS, HELD).alias("held"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("b"), F.sum((~F.col("held")).cast("long")).alias("t")).first()
    chunks = max(1, -(-(size["b"] or 0) // chunk))
    ends = size["t"] or 0  # training documents, each with one end token
    buckets = max(16, min(512, chunks // 4))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks)).cast("int"))
    kind = dict(rows.dtypes)["id"]

    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        part, train, out = Chunk(pdf), ~pdf["held"].to_numpy(dtype=bool), []
        for k, (keys, counts) in ((GRAM, part.grams(train)), (WORD, part.distinct_words(train))):
            b = bucket_of(keys, k, buckets)
            for i in np.unique(b):
                own = b == i
                out.append((pdf["chunk"].iat[0], k, int(i), _pack_keys(keys[own]), _pack(counts[own])))
        return pd.DataFrame(out, columns=["chunk", "kind", "bucket", "keys", "counts"])

    sent = stored(dealt.groupBy("chunk").applyInPandas(
        send, "chunk int, kind int, bucket int, keys binary, counts binary"), "lm-counts")

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        cols = ["bit", "key", "zeros", "ones", "below"]
        if pdf["kind"].iat[0] == WORD:
            _, _, counts = _bucket_grams(pdf)
            return pd.DataFrame([(-1, 0, float(counts.sum()), float((counts > 0).sum()), 0.0)], columns=cols)
        _, codes, counts = _bucket_grams(pdf)
        codes, counts = codes[counts > 0], counts[counts > 0]
        out = []
        if len(codes):
            nodes = weigh(codes, counts, DEPTH, 2)
            for bit in range(8):
                key, _, _, mixed, zeros, ones = nodes[2, bit]
                up = ((key >> np.uint64(16)) << np.uint64(8)) | (key & np.uint64(255))
                up, inverse = np.unique(up, return_inverse=True)
                out.append(pd.DataFrame({"bit": bit, "key": up.astype(np.int64), "zeros": np.bincount(inverse, zeros),
                                         "ones": np.bincount(inverse, ones), "below": np.bincount(inverse, mixed)}))
        return pd.concat(out) if out else pd.DataFrame([], columns=cols).astype(
            {"bit": int, "key": int, "zeros": float, "ones": float, "below": float})

    # at most 256 x 255 nodes and one row of word totals, however large the corpus
    top = (sent.groupBy("kind", "bucket").applyInPandas(
        sums, "bit int, key long, zeros double, ones double, below double")
        .groupBy("bit", "key").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"),
                                   F.sum("below").alias("below")).toPandas())
    totals = top[top["bit"] < 0]
    n_all = int(totals["zeros"].sum()) + ends
    n_kinds = int(totals["ones"].sum()) + (ends > 0)
    upper = top_nodes(top[top["bit"] >= 0])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        each, keys, counts = _bucket_grams(pdf)
        if pdf["kind"].iat[0] == GRAM:
            seen = counts > 0
            empty = {(d, b): (keys[:0], np.empty(0), np.empty(0)) for d in range(2, DEPTH + 1) for b in range(8)}
            nodes = (weigh(keys[seen], counts[seen], DEPTH, 2) if seen.any() else empty) | upper
            value = log10_windows(keys, nodes).astype(np.float32)
        else:
            value = counts.astype(np.float64)
        return pd.DataFrame({"chunk": pdf["chunk"], "kind": pdf["kind"], "bucket": pdf["bucket"],
                             "value": [_pack(value[np.searchsorted(keys, k)]) for k in each]})

    answers = stored(sent.groupBy("kind", "bucket").applyInPandas(
        answer, "chunk int, kind int, bucket int, value binary"), "lm-answers")

    def add_up(pdf: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame([], columns=["id", "held", "n_tokens", "n_known", "base", "score", "n_bytes"])
        part, none = Chunk(pdf), np.zeros(len(pdf), dtype=bool)
        blocks = list(part.numbered())
        grams = _distinct([k for k, _, _ in blocks])
        looked = {}
        for k, keys, dtype in ((GRAM, grams, np.float32), (WORD, part.distinct_words(none)[0], np.float64)):
            values, b = np.zeros(len(keys)), bucket_of(keys, k, buckets)
            for r in got[got["kind"] == k].itertuples():
                values[b == r.bucket] = _unpack(r.value, dtype)
            looked[k] = (keys, values)
        score = np.zeros(len(pdf))
        keys, values = looked[GRAM]
        for own, inverse, doc in blocks:
            score += np.bincount(doc, values[np.searchsorted(keys, own)][inverse], len(pdf))
        keys, counts = looked[WORD]
        logs = np.log10((counts + 1) / (n_all + n_kinds + 1))
        end = math.log10((ends + 1) / (n_all + n_kinds + 1))
        known, base = [], []
        for w in part.words:
            at = np.searchsorted(keys, w)
            known.append(int((counts[at] > 0).sum()) + (ends > 0))
            base.append(float(logs[at].sum()) + end)
        return pd.DataFrame({"id": pdf["id"], "held": pdf["held"], "n_tokens": [len(w) + 1 for w in part.words],
                             "n_known": known, "base": base, "score": score,
                             "n_bytes": part.end - part.start - DEPTH})

    scored = (dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        add_up, f"id {kind}, held boolean, n_tokens long, n_known long, base double, score double, n_bytes long"))
    return scored.select(F.col("id").alias(id_col), F.col("held").alias("held_out"), "n_tokens", "n_known",
                         F.lit(n_all).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score",
                         (-F.col("score") / F.lit(math.log10(2)) / F.col("n_bytes")).alias("bits_per_byte"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
