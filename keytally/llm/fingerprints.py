"""Document fingerprints: SimHash with weighted terms, and a search through permuted
block tables for all fingerprints within a Hamming radius.

Terms are pairs of neighbouring words (white space separates words, A-Z are
lower-cased; a text of one word is one term).  A term weighs 1 + ln(its count) and
votes with that weight for or against each of the 64 bits of its hash; a bit is set
if the votes for it prevail.  No words: fingerprint zero.

``edited_fingerprints`` also fingerprints each text with its last third replaced by
the beginning of the next document (descending id, the first after the last).  The
texts are range-sorted by id once; only the two texts at the ends of a partition are
carried to the neighbouring one.

Defined cases: a null text is empty; equal texts have equal fingerprints; a null id
comes last in the order, equal ids follow the order of a hash of their texts; a table of one
row is its own next document; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keytally.llm.common import stored, table
from keytally.llm.hamming import near_counts

RADIUS = 3


class _Hashes(dict):
    """Hashes of the words met lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 7)
        return h


_hashes = _Hashes()


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def weighted_simhash(text: str | None) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    h = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    terms = _mix(h[:-1] * np.uint64(3) + h[1:] * np.uint64(0x9E3779B97F4A7C15)) if len(h) > 1 else _mix(h)
    terms, count = np.unique(terms, return_counts=True)
    weight = (1 + np.log(count)).astype(np.float32)
    votes = np.zeros(64, dtype=np.float64)
    for r in range(0, len(terms), 1 << 14):  # a very long text takes no more memory
        bits = np.unpackbits(terms[r:r + 16384].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += weight[r:r + 16384] @ bits.astype(np.float32)
    return int(np.packbits(2 * votes > weight.sum(dtype=np.float64), bitorder="little").view("<u8")[0])


def likeness(a: int, b: int) -> float:
    """The share of bits that agree."""
    return 1 - (a ^ b).bit_count() / 64


def edited(text: str, following: str) -> str:
    """The last floor(n/3) code points replaced by the first as many of ``following``."""
    m = len(text) // 3
    return text[:len(text) - m] + following[:m]


def _row(part: int, doc_id, text: str, fp: int, following: str, following_fp: int) -> dict:
    new = edited(text, following)
    new_fp = weighted_simhash(new)
    return {"part": part, "end": 0, "id": doc_id, "text": None, "n_chars": len(text),
            "edited_sha256": hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
            "fp": fp, "edited_fp": new_fp, "near_edited": likeness(fp, new_fp),
            "near_next": likeness(fp, following_fp)}


def _end(part: int, end: int, doc_id, text: str, fp: int) -> dict:
    return {"part": part, "end": end, "id": doc_id, "text": text, "n_chars": len(text), "edited_sha256": None,
            "fp": fp, "edited_fp": None, "near_edited": None, "near_next": None}


def _signed(x: int | None) -> int | None:
    return x if x is None or x < 1 << 63 else x - (1 << 64)


def _frame(rows: list[dict]) -> pd.DataFrame:
    out = {c: [r[c] for r in rows] for c in rows[0]}
    for c in ("fp", "edited_fp"):  # nullable whole numbers, never by way of floats
        out[c] = pd.array([_signed(x) for x in out[c]], dtype="Int64")
    out["id"] = pd.Series(out["id"], dtype=object)
    return pd.DataFrame(out)


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each row of a sorted partition with the row after it; the partition's first
    row (end 1) and last row (end 2) are passed on with their texts."""
    part, held = TaskContext.get().partitionId(), None
    for pdf in batches:
        out = []
        for doc_id, text in zip(pdf["id"], pdf["text"], strict=True):
            doc_id = None if pd.isna(doc_id) else doc_id
            fp = weighted_simhash(text)
            out.append(_end(part, 1, doc_id, text, fp) if held is None else _row(part, *held, text, fp))
            held = (doc_id, text, fp)
            if len(out) >= 1000:
                yield _frame(out)
                out = []
        if out:
            yield _frame(out)
    if held is not None:
        yield _frame([_end(part, 2, *held)])


def _join_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        if len(pdf):
            yield _frame([_row(r.part, None if pd.isna(r.id) else r.id, r.text, int(r.fp) % (1 << 64),
                               r.next_text, int(r.next_fp) % (1 << 64)) for r in pdf.itertuples()])


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        radius: int = RADIUS) -> DataFrame:
    """One row per document: id, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next`` and ``n_near``, the number of
    other documents whose fingerprints are equal or within ``radius`` bits."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["id"]
    schema = (f"part int, end int, id {kind}, text string, n_chars long, edited_sha256 string, fp long, "
              "edited_fp long, near_edited double, near_next double")
    walked = stored(rows.repartitionByRange(F.col("id").desc_nulls_last(), F.xxhash64("text"))
                    .sortWithinPartitions(F.col("id").desc_nulls_last(), F.xxhash64("text"), "text")
                    .mapInPandas(_walk, schema), "fingerprints")
    done = walked.where("end = 0")
    first = walked.where("end = 1").select("part", F.col("text").alias("next_text"), F.col("fp").alias("next_fp"))
    # the partition after each one that has rows; the first after the last
    parts = walked.where("end = 2").select("part")
    after = (parts.withColumn("next", F.lead("part").over(Window.orderBy("part")))
             .withColumn("next", F.coalesce("next", F.min("part").over(Window.partitionBy()))))
    ends = (walked.where("end = 2").select("part", "id", "text", "fp").join(after, "part")
            .join(first.withColumnRenamed("part", "next"), "next"))
    all_rows = done.unionByName(ends.mapInPandas(_join_ends, schema))
    fps = walked.where("end <> 1").groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    near = fps.join(near_counts(fps, radius), "fp", "left") \
              .select("fp", (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("n_near"))
    text16 = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return all_rows.join(near, "fp").select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", text16("fp").alias("fingerprint"),
        text16("edited_fp").alias("edited_fingerprint"), "near_edited", "near_next", "n_near")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))
