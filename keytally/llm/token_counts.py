"""Token counts of a byte-level byte-pair vocabulary, by heap-and-linked-list merging.

Only the number of tokens is wanted, so no identifiers are made.  A text is cut at the
vocabulary's special strings (one token each) and then into words by the vocabulary's
pattern.  A word starts as one symbol a byte, held in a linked list; a heap holds the
adjacent pairs that may merge, lowest rank first, leftmost first among equals.  Each
popped pair that still stands is merged, and its two new neighbours enter the heap.  A
word's tokens are its bytes minus its merges.  Word counts met lately are remembered.

The vocabulary file is given, never trained; only its merges travel to the workers.

Defined cases: a null text counts as empty (no bytes, no tokens); an empty table gives
an empty result; repeated rows are counted alike; a column of the name of a result is
replaced, all others stay.
"""

from __future__ import annotations

import json
from heapq import heapify, heappop, heappush

import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from keytally.llm.common import table

FILE = "byte_bpe_50k.json"
LIMIT = 512
REMEMBERED = 1_000_000  # words whose counts a worker remembers
SHORT = 48  # longer words hardly come again
#: Fixed value: how a byte-level vocabulary cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_POSITION = (1 << 40) - 1


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary file stands for: the
    printable ones of Latin-1 for themselves, the others, in order, from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class TokenCounter(dict):
    """Word -> number of its tokens, filled as words come."""

    def __init__(self, merges: list[tuple[bytes, bytes]], specials: list[str]):
        super().__init__()
        self.merges, self.specials = merges, specials
        self._ready = False

    @classmethod
    def from_file(cls, path: str | None = None) -> TokenCounter:
        """Read a ``tokenizers`` file (on the driver only)."""
        with open(path or public_tokenizers.path(FILE), encoding="utf-8") as f:
            spec = json.load(f)
        cut, model = spec["pre_tokenizer"], spec["model"]
        plain = (cut["type"] == "ByteLevel" and not cut["add_prefix_space"] and cut["use_regex"]
                 and spec["normalizer"] is None and model["type"] == "BPE" and not model["ignore_merges"])
        if not plain or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("not a plain byte-level vocabulary")
        code = byte_of_character()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        return cls([tuple(bytes(code[c] for c in side) for side in pair) for pair in pairs],
                   [t["content"] for t in spec["added_tokens"]])

    def __reduce__(self):  # what is remembered stays where it is
        return TokenCounter, (self.merges, self.specials)

    def _build(self) -> None:
        symbol = {bytes([b]): b for b in range(256)}
        #: (left << 32 | right) -> rank, and the symbol that a rank makes
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for r, (a, b) in enumerate(self.merges):
            left, right = (symbol.setdefault(s, len(symbol)) for s in (a, b))
            self.rank.setdefault(left << 32 | right, r)
            self.made.append(symbol.setdefault(a + b, len(symbol)))
        self.words = regex.compile(WORDS).findall
        longest_first = sorted(self.specials, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, longest_first)) or r"(?!)")
        self._ready = True

    def merged(self, word: bytes) -> int:
        """Number of symbols of ``word`` once no adjacent pair can merge."""
        rank, made = self.rank.get, self.made
        symbols = list(word)
        n = left = len(symbols)
        heap = []
        for i in range(n - 1):
            r = rank(symbols[i] << 32 | symbols[i + 1])
            if r is not None:
                heap.append(r << 40 | i)
        if not heap:
            return n
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            top = heappop(heap)
            i = top & _POSITION
            j = after[i]
            # a pair that has changed since it was pushed is out of date
            if j >= n or rank(symbols[i] << 32 | symbols[j]) != top >> 40:
                continue
            s = symbols[i] = made[top >> 40]
            symbols[j] = 1 << 31  # merged away: no pair has it
            k = after[i] = after[j]
            left -= 1
            if k < n:
                before[k] = i
                r = rank(s << 32 | symbols[k])
                if r is not None:
                    heappush(heap, r << 40 | i)
            k = before[i]
            if k >= 0:
                r = rank(symbols[k] << 32 | s)
                if r is not None:
                    heappush(heap, r << 40 | k)
        return left

    def __missing__(self, word: str) -> int:
        count = self.merged(word.encode())
        if len(word) <= SHORT:
            if len(self) >= REMEMBERED:  # the older half goes
                for old in list(self)[:REMEMBERED // 2]:
                    del self[old]
            self[word] = count
        return count

    def count(self, text: str | None) -> int:
        if not self._ready:
            self._build()
        if not text:
            return 0
        pieces = self.special.split(text)
        return len(pieces) - 1 + sum(sum(map(self.__getitem__, self.words(p))) for p in pieces)


_HERE: dict[int, TokenCounter] = {}  # a worker's counter outlives its tasks


def _kept(counter: TokenCounter) -> TokenCounter:
    key = hash((len(counter.merges), tuple(counter.merges[-50:]), tuple(counter.specials)))
    return _HERE.setdefault(key, counter)


def token_count(text: Column, counter: TokenCounter) -> Column:
    """Number of tokens of ``text`` (0 for a null)."""

    @F.pandas_udf(LongType())
    def count(texts: pd.Series) -> pd.Series:
        own = _kept(counter)
        return pd.Series([own.count(t) for t in texts], dtype="int64")

    return count(text)


def token_counts(docs: DataFrame, text_col: str = "text", limit: int = LIMIT,
                 counter: TokenCounter | None = None) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit``
    tokens)."""
    counter = counter or TokenCounter.from_file()
    text = F.col(text_col)
    return (docs.withColumns({"n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"),
                              "n_tokens": token_count(text, counter)})
            .withColumn("over_limit", F.col("n_tokens") > F.lit(limit)))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of every whole document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")
