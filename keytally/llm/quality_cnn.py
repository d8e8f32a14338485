"""Quality by a byte-level convolutional network in numpy.

A text is cut into chunks of ``CHUNK`` bytes that overlap by ``CHUNK - STEP`` and cover
it to the end.  Learned filters over byte embeddings run along each chunk and are
max-pooled over its positions; a hidden layer describes the chunk; the hidden units
are max-pooled over all chunks and one output unit gives the probability of label 1.

Training (Adam, on the driver) takes a bounded sample of labelled documents:
``PER_CLASS`` of each class and ``TRAIN_CHUNKS`` chunks of a document, spread over its
length.  Scoring reads every chunk of every document.  The output is shifted so that
the best threshold of the sample lies at 0.7.

Defined cases: a null or empty text is one chunk of padding and has that score; a
sample without both classes gives every document the share of class 1 in it (1 if it
is empty: nothing is known against a document); null ids are scored and held out;
repeated rows are scored alike; an empty table gives an empty result; other columns
are ignored, and kept by ``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import as_strided
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keytally.llm.common import fold, free_name, labelled_sample, table
from keytally.llm.toxicity import shift_to_threshold

CHUNK, STEP = 256, 224
KERNEL, STRIDE, DIM = 10, 3, 6
FILTERS, HIDDEN = 32, 16
PER_CLASS = 1000  # labelled training documents of each class at most
TRAIN_CHUNKS = 16
EPOCHS, BATCH, RATE = 10, 64, 0.01
BLOCK = 512  # chunks that go through the filters at a time
THRESHOLD = 0.7
MODULUS, HELD = 4, 2
SEED = 42
_PLACES = (CHUNK - KERNEL) // STRIDE + 1
_START = np.arange(_PLACES) * STRIDE


def chunks(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(chunks padded with zero bytes, their lengths)."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    n = max(1, -(-(len(raw) - (CHUNK - STEP)) // STEP))
    padded = np.zeros((n - 1) * STEP + CHUNK, dtype=np.uint8)
    padded[:len(raw)] = raw
    length = np.minimum(CHUNK, len(raw) - np.arange(n) * STEP)
    return as_strided(padded, (n, CHUNK), (STEP, 1)), np.maximum(length, 1)


class Network:
    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        f = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {"embed": f(256, DIM, scale=0.5), "filt": f(KERNEL * DIM, FILTERS, scale=(KERNEL * DIM) ** -0.5),
                  "fbias": np.zeros(FILTERS, np.float32), "hid": f(FILTERS, HIDDEN, scale=FILTERS ** -0.5),
                  "hbias": np.full(HIDDEN, 0.1, np.float32), "out": f(HIDDEN, scale=HIDDEN ** -0.5),
                  "obias": np.zeros(1, np.float32)}
        self.constant: float | None = None  # the answer of a network that saw one class only

    def filtered(self, x: np.ndarray, length: np.ndarray, where: bool = False):
        """Max-pooled filter outputs of chunks, and (``where``) the pooled places."""
        best = np.empty((len(x), FILTERS), np.float32)
        place = np.empty((len(x), FILTERS), np.int64) if where else None
        for r in range(0, len(x), BLOCK):
            e = self.p["embed"][x[r:r + BLOCK]]
            s = e.strides
            cols = as_strided(e, (len(e), _PLACES, KERNEL * DIM), (s[0], STRIDE * s[1], s[2]))
            a = (cols.reshape(-1, KERNEL * DIM) @ self.p["filt"]).reshape(len(e), _PLACES, FILTERS)
            short = length[r:r + BLOCK]
            if (short < CHUNK).any():
                a[_START[None, :] >= short[:, None]] = -1e9
            best[r:r + BLOCK] = a.max(axis=1)
            if where:
                place[r:r + BLOCK] = a.argmax(axis=1)
        return best + self.p["fbias"], place

    def hidden(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(np.maximum(pooled, 0) @ self.p["hid"] + self.p["hbias"], 0)

    def logit(self, text: str | None) -> float:
        x, length = chunks(text)
        top = np.zeros(HIDDEN, np.float32)
        for r in range(0, len(x), BLOCK):  # a very long text is taken block by block
            pooled, _ = self.filtered(x[r:r + BLOCK], length[r:r + BLOCK])
            top = np.maximum(top, self.hidden(pooled).max(axis=0))
        return float(top @ self.p["out"] + self.p["obias"][0])

    def logits(self, texts: list[str | None]) -> np.ndarray:
        """Logits of many texts; short ones go through the filters together."""
        out, group, size = np.empty(len(texts)), [], 0

        def flush():
            xs, ls = zip(*[chunks(texts[i]) for i in group], strict=True)
            n = np.array([len(v) for v in xs])
            pooled, _ = self.filtered(np.concatenate(xs), np.concatenate(ls))
            top = np.maximum.reduceat(self.hidden(pooled), np.r_[0, np.cumsum(n)[:-1]], axis=0)
            out[group] = top @ self.p["out"] + self.p["obias"][0]

        for i, t in enumerate(texts):
            k = len(t or "") // STEP + 1
            if k > 2 * BLOCK:
                out[i] = self.logit(t)
                continue
            group.append(i)
            size += k
            if size >= BLOCK:
                flush()
                group, size = [], 0
        if group:
            flush()
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -60, 60)))

    def gradients(self, xs: list[np.ndarray], ls: list[np.ndarray], y: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, np.array([len(v) for v in xs])
        x, first = np.concatenate(xs), np.r_[0, np.cumsum(n)[:-1]]
        pooled, place = self.filtered(x, np.concatenate(ls), where=True)
        act = np.maximum(pooled, 0)
        hid = self.hidden(pooled)
        top = np.maximum.reduceat(hid, first, axis=0)
        prob = 1 / (1 + np.exp(-np.clip(top @ p["out"] + p["obias"][0], -30, 30)))
        d = ((prob - y) / len(y)).astype(np.float32)
        g = {"out": top.T @ d, "obias": np.array([d.sum()])}
        dtop = d[:, None] * p["out"]
        # the first chunk that reaches the maximum takes the gradient
        doc = np.repeat(np.arange(len(n)), n)
        is_top = (hid == top[doc]) & (hid > 0)
        seen = np.cumsum(is_top, axis=0)
        base = np.concatenate([np.zeros((1, HIDDEN), seen.dtype), seen])[first]
        is_top &= seen - base[doc] == 1
        dhid = np.where(is_top, dtop[doc], 0).astype(np.float32)
        g["hid"], g["hbias"] = act.T @ dhid, dhid.sum(axis=0)
        dpool = (dhid @ p["hid"].T) * (pooled > 0)
        g["fbias"] = dpool.sum(axis=0)
        r, f = np.nonzero(dpool)
        v = dpool[r, f]
        window = x[r[:, None], _START[place[r, f]][:, None] + np.arange(KERNEL)]
        cols = p["embed"][window].reshape(len(r), KERNEL * DIM)
        g["filt"] = np.zeros_like(p["filt"])
        for k in range(FILTERS):
            own = f == k
            if own.any():
                g["filt"][:, k] = v[own] @ cols[own]
        back = (v[:, None] * p["filt"].T[f]).reshape(-1, DIM)
        flat = window.ravel()
        g["embed"] = np.stack([np.bincount(flat, back[:, k], 256) for k in range(DIM)], axis=1)
        return g


def train(sample: list[tuple[str, int]], epochs: int = EPOCHS, seed: int = SEED) -> Network:
    net, rng = Network(seed), np.random.default_rng(seed)
    y = np.array([y for _, y in sample], dtype=np.float32)
    if not len(y) or y.min() == y.max():
        net.constant = float(y.mean()) if len(y) else 1.0
        return net
    data = []
    for text, _ in sample:
        x, length = chunks(text)
        if len(x) > TRAIN_CHUNKS:
            keep = np.linspace(0, len(x) - 1, TRAIN_CHUNKS).astype(int)
            x, length = x[keep], length[keep]
        data.append((np.ascontiguousarray(x), length))
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    s = {k: np.zeros_like(v) for k, v in net.p.items()}
    step, total = 0, epochs * -(-len(y) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for r in range(0, len(y), BATCH):
            pick = order[r:r + BATCH]
            g = net.gradients([data[i][0] for i in pick], [data[i][1] for i in pick], y[pick])
            step += 1
            rate = RATE * (1 - (step - 1) / total)
            for k, v in net.p.items():
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
                v -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)).astype(v.dtype)
    z = net.logits([t for t, _ in sample])
    net.p["obias"] += np.float32(shift_to_threshold(z, y, THRESHOLD))
    return net


def score_column(text: str, net: Network):
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(net.scores(s.tolist()), dtype="float64")

    apply.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(apply, "double")(F.col(text))


def fitted(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Network:
    return train(labelled_sample(docs, labels, "quality", MODULUS, HELD, per_class))


def quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score``, ``predicted``."""
    net = fitted(docs, labels, per_class)
    return (docs.select("doc_id", fold(F.col("doc_id"), MODULUS, HELD).alias("held_out"),
                        score_column("text", net).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def accepted(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, columns as they are."""
    score = free_name(docs, "quality_score")
    scored = docs.withColumn(score, score_column("text", fitted(docs, labels, per_class)))
    return scored.where(F.col(score) >= THRESHOLD).drop(score)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
