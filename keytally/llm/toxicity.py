"""Toxicity by compression distance: which of two zstandard dictionaries, one trained
on ordinary and one on toxic text, shortens a window more.

Training takes a bounded sample of labelled documents.  The ordinary dictionary is
trained on the windows of whole documents labelled 0 (``ORDINARY_MOST`` drawn by a hash
over the length of all of them, if there are more), and is large, so that ordinary text finds
its matches there; the toxic one on the passages that mark documents labelled 1: the
beginnings of words or, where this tells unseen documents apart better, also whole
words that those documents hold far more often than chance allows, in ever new
surroundings (``VARIED`` different words before it; a word of copied text always follows
the same one), with what nearly all their uses go on with.  Equal texts of the sample
count once, so that copies do not outvote the rest.  Passages that the trainer leaves out are appended.  The
ordinary one is laid over the toxic one, so that the two differ by the toxic material
only and ordinary text compresses alike under both.

Every window of a text (``WINDOW`` bytes, ``STEP`` apart, to the end) is compressed
with both; the bytes saved by the toxic dictionary are the window's
gain.  The two largest gains, the number of windows of some gain and of all windows
go through a logistic function, fitted on halves of the sample measured with the other
half's dictionaries, without falling in any gain, and shifted so that the best threshold lies at 0.7.

Defined cases: a null or empty text has one empty window, no gain, and the score of
that; a sample without both classes gives every document the share of class 1 in it
(0 if it is empty); null ids are scored and held out; repeated rows are scored alike;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keytally.llm.common import fold, labelled_sample, table

WINDOW, STEP = 64, 48
#: A search for matches only, hardly any literal coding to blur them.
SEARCH = {"window_log": 17, "hash_log": 17, "chain_log": 17, "search_log": 5, "min_match": 5, "target_length": 1,
          "strategy": zstandard.STRATEGY_GREEDY}
PER_CLASS = 1500  # labelled training documents of each class at most
ORDINARY_SIZE, TOXIC_SIZE, TOXIC_MOST = 98304, 1024, 8192
ORDINARY_MOST = 1 << 18  # windows that the ordinary dictionary is trained on at most (16 MB)
STEM = 4  # bytes of the beginnings that are counted beside whole words
ODDS = 2.5  # log odds from which a beginning marks a toxic passage
COMMON = 100  # ... if one in so many documents labelled 1 has it
VARIED = 8  # distinct words before it at least, however often it is used
AGREE = 0.9  # share of its uses that a mark's next byte must have to be taken in
#: Fixed value: the three repeat offsets (1, 4, 8) that end a trained dictionary's header.
HEAD_END = struct.pack("<3I", 1, 4, 8)
FEATURES, GAINS = 5, (1, 2, 3)  # columns, and those of them that grow with the gains
GAIN = 5  # bytes from which a window's gain is counted
THRESHOLD = 0.7
MODULUS, HELD = 3, 1


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


def windows(text: bytes) -> list[bytes]:
    """Windows that cover the whole text; the last may be short."""
    last = max(0, len(text) - (WINDOW - STEP) - 1)
    return [text[i:i + WINDOW] for i in range(0, last + 1, STEP)]


def _words(text: bytes) -> list[bytes]:
    return [w + b" " for w in text.replace(b".", b" ").replace(b",", b" ").split()]


def _forms(word: bytes, whole: bool) -> tuple[bytes, ...]:
    """What is counted of a word: its beginning and, with ``whole``, the word."""
    return (word[:STEM], word) if whole else (word[:STEM],)


def _grown(mark: bytes, words: Counter) -> bytes:
    """``mark`` and the bytes that nearly all uses of it go on with."""
    total = sum(words.values())
    while True:
        longer = Counter()
        for w, k in words.items():
            if len(w) > len(mark) and w.startswith(mark):
                longer[w[:len(mark) + 1]] += k
        if not longer or (best := max(longer.items(), key=lambda e: (e[1], e[0])))[1] < AGREE * total:
            return mark
        mark = best[0]


def marked_passages(sample: list[tuple[bytes, int]], whole: bool) -> list[bytes]:
    """Passages that mark the documents labelled 1, each as often as it is used."""
    docs, n = (Counter(), Counter()), [0, 0]
    uses, around = Counter(), {}
    for text, y in sample:
        n[y] += 1
        words = _words(text)
        docs[y].update({p for w in set(words) for p in _forms(w, whole)})
        if y:
            uses.update(words)
            for before, w in zip([b"", *words], words, strict=False):
                for p in _forms(w, whole):
                    around.setdefault(p, set()).add(before)
    share = n[1] / max(1, n[0] + n[1])

    def odds(p: bytes) -> float:
        return math.log((docs[1][p] + 0.5) / (n[1] + 1)) - math.log((docs[0][p] + 0.5) / (n[0] + 1))

    def evidence(p: bytes) -> float:
        """Log likelihood ratio against documents of both classes holding it alike."""
        one, zero = docs[1][p], docs[0][p]
        return (one * math.log(one / (one + zero) / share)
                + (zero * math.log(zero / (one + zero) / (1 - share)) if zero else 0.0))

    # so much evidence that chance gives it to none of the forms counted
    enough = math.log(max(2, len(docs[1])))
    marks = {p for p, k in docs[1].items() if k >= max(3, n[1] // COMMON) and odds(p) >= ODDS
             and evidence(p) >= enough and len(around[p]) >= VARIED}
    held: dict[bytes, Counter] = {}
    for w, k in uses.items():  # a marked beginning covers its words
        if mark := next((p for p in _forms(w, whole) if p in marks), None):
            held.setdefault(mark, Counter())[w] += k
    return [b" " + _grown(p, words) for p, words in held.items() for _ in range(sum(words.values()))]


def _trained(size: int, samples: list[bytes], **shape: int) -> bytes:
    """The content of a dictionary of about ``size`` bytes; with too little text for
    the trainer, the text itself."""
    try:
        made = zstandard.train_dictionary(size, samples, **shape).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]
    head = made.find(HEAD_END)
    return made[head + len(HEAD_END):] if head >= 0 else made


def _with_left_out(trained: bytes, passages: list[bytes]) -> bytes:
    """The dictionary and each passage that is not in it, the most frequent last."""
    left = [w for w, _ in Counter(passages).most_common() if w not in trained]
    return trained + b"".join(reversed(left))[-TOXIC_MOST:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    how = zstandard.ZstdCompressionParameters(**SEARCH, write_content_size=False, write_checksum=False,
                                              write_dict_id=False)
    d.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=how)


class Model:
    """Two dictionaries and the weights of the logistic function.  Compressors are
    built where the model is used; only bytes and numbers travel."""

    def __init__(self, ordinary: bytes, toxic: bytes, weights: list[float] | None = None, share: float = 0.0):
        self.ordinary, self.toxic, self.weights, self.share = ordinary, toxic, weights, share
        self._pair = None

    def __getstate__(self):
        return {**self.__dict__, "_pair": None}

    def features(self, text: bytes) -> list[float]:
        if self._pair is None:
            self._pair = (_compressor(self.ordinary), _compressor(self.toxic + self.ordinary))
        plain, both = self._pair[0].compress, self._pair[1].compress
        best = second = some = 0
        parts = windows(text)
        for w in parts:
            gain = len(plain(w)) - len(both(w))
            some += gain >= GAIN
            if gain > second:
                best, second = (gain, best) if gain > best else (best, gain)
        return [1.0, best, second, math.log1p(some), math.log(len(parts))]

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return self.share
        z = sum(w * x for w, x in zip(self.weights, self.features(_bytes(text)), strict=True))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of a logistic function, by Newton's method with a ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(hess, grad)
        w = w - move
        if np.abs(move).max() < 1e-9:
            break
    return w


def rising_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of which none of a gain is negative: more toxic windows never lower a
    score.  Columns that would get one are left out, one at a time."""
    kept = list(range(x.shape[1]))
    while True:
        w = np.zeros(x.shape[1])
        w[kept] = logistic(x[:, kept], y)
        worst = min(GAINS, key=lambda c: w[c])
        if w[worst] >= 0:
            return w
        kept.remove(worst)


def shift_to_threshold(z: np.ndarray, y: np.ndarray, threshold: float) -> float:
    """What to add to the logits so that the cut with the fewest balanced errors,
    midway between its neighbours, lies at ``threshold``."""
    order = np.argsort(z, kind="stable")
    z, y = z[order], y[order]
    wrong = (np.r_[0, np.cumsum(y)] / max(1, y.sum())
             + np.r_[0, np.cumsum(1 - y)][::-1][0] / max(1, (1 - y).sum())
             - np.r_[0, np.cumsum(1 - y)] / max(1, (1 - y).sum()))
    edge = np.r_[z[0] - 2, (z[1:] + z[:-1]) / 2, z[-1] + 2]
    wrong[1:-1][z[1:] == z[:-1]] = np.inf  # equal scores cannot be cut apart
    best = np.flatnonzero(wrong == wrong.min())
    return math.log(threshold / (1 - threshold)) - float(edge[best].mean())


def ranked_right(z: np.ndarray, y: np.ndarray) -> float:
    """The share of pairs of both classes that ``z`` puts in the right order."""
    rank = np.empty(len(z))
    rank[np.argsort(z, kind="stable")] = np.arange(len(z))
    ones = y.sum()
    return (rank[y == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(y) - ones))


def drawn(texts: list[bytes], most: int = ORDINARY_MOST) -> list[bytes]:
    """All windows of all texts, from begin to end; of more than ``most``, those whose
    running numbers have the smallest hashes."""
    numbered = ((xxhash.xxh3_64_intdigest(struct.pack("<Q", n)), n, w)
                for n, w in enumerate(w for text in texts for w in windows(text)) if len(w) >= 8)
    kept = heapq.nsmallest(most, numbered)
    return [w for _, _, w in sorted(kept, key=lambda e: e[1])]


def dictionaries(data: list[tuple[bytes, int]], whole: bool) -> Model:
    plain = drawn([text for text, label in data if not label])
    marked = marked_passages(data, whole)
    return Model(_trained(ORDINARY_SIZE, plain), _with_left_out(_trained(TOXIC_SIZE, marked, k=16, d=6), marked))


def train(sample: list[tuple[str, int]]) -> Model:
    data = list(dict.fromkeys((_bytes(t), y) for t, y in sample))  # copies count once
    y = np.array([y for _, y in data], dtype=float)
    if not len(y) or y.min() == y.max():
        return Model(b"", b"", None, float(y.mean()) if len(y) else 0.0)
    # each half is measured with the dictionaries of the other, as unseen text will be;
    # the way of marking passages that tells the classes apart better is taken
    halves = (np.arange(len(y)) % 2).astype(bool)
    best = None
    for whole in (False, True):
        x = np.empty((len(y), FEATURES))
        for half in (halves, ~halves):
            other = dictionaries([data[k] for k in np.flatnonzero(~half)], whole)
            x[half] = [other.features(data[k][0]) for k in np.flatnonzero(half)]
        w = rising_logistic(x, y)
        good = ranked_right(x @ w, y)
        if best is None or good > best[0]:
            best = (good, whole, x, w)
    _, whole, x, w = best
    model = dictionaries(data, whole)
    w[0] += shift_to_threshold(x @ w, y, THRESHOLD)
    model.weights = w.tolist()
    return model


def score_column(text: str, model: Model):
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([model.score(t) for t in s], dtype="float64")

    apply.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(apply, "double")(F.col(text))


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score``, ``predicted``."""
    model = train(labelled_sample(docs, labels, "toxic", MODULUS, HELD, per_class))
    return (docs.select("doc_id", fold(F.col("doc_id"), MODULUS, HELD).alias("held_out"),
                        score_column("text", model).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
