"""SimHash near-duplicates: pigeonhole blocks, a join on blocks, Hamming distance.

Texts are lower-cased (A-Z only), cut into words ``[^\\x20\\x09-\\x0D]+`` and
``shingle``-word shingles, repeats included, joined by one space; a text of fewer
words is one shingle, a text of none has fingerprint zero.  Each shingle's XXH64
(UTF-8, seed 42) votes on 64 bits; a bit is set if more than half the hashes have
it.  Fingerprints that differ in at most ``radius`` bits are linked, and documents
are grouped by the closure of the links.

The documents' texts never leave the scan: only (id, fingerprint) is shuffled, and
the search runs on distinct fingerprints, so a group of exact copies is one row.

Defined cases: null and empty texts have fingerprint zero and are linked like any
other; a null id keeps its row, and its component is the smallest id that is not
null (null if there is none); repeated ids and rows stay as they are; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keytally.llm.common import free_name, stored, table
from keytally.llm.graph import components
from keytally.llm.hamming import near_links

SEED = 42
SHINGLE = 4
RADIUS = 4
AGREE = 2


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text, as an unsigned integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - shingle + 1)
    at = [0, *ends[:n - 1].tolist()]
    to = (ends[len(words) - n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, dtype=np.int64)
    for r in range(0, n, 1 << 16):  # a very long text takes no more memory
        h = np.array([digest(line[a:b], SEED) for a, b in zip(at[r:r + 65536], to[r:r + 65536], strict=True)],
                     dtype="<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: str, shingle: int = SHINGLE):
    """The signed long that holds the fingerprint of column ``text``."""
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in s], dtype=np.uint64).view(np.int64))

    apply.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(apply, "long")(F.col(text))


def classes(fps: DataFrame, radius: int = RADIUS, agree: int = AGREE) -> DataFrame:
    """(fp, class_fp) for every fingerprint of ``fps`` (column ``fp``) that has a link."""
    distinct = fps.groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    found = components(near_links(distinct, radius, agree))
    return found.select(F.col("node").alias("fp"), F.col("component").alias("class_fp"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   radius: int = RADIUS, agree: int = AGREE) -> DataFrame:
    """One row per document: the id, ``fingerprint`` (16 hex digits), ``component_id``."""
    fps = stored(docs.select(F.col(id_col).alias("id"), fingerprint_column(text_col, shingle).alias("fp")),
                 "simhash")
    least = (fps.groupBy("fp").agg(F.min("id").alias("least"))
             .join(classes(fps, radius, agree), "fp", "left")
             .withColumn("class_fp", F.coalesce("class_fp", "fp")))
    per_class = least.groupBy("class_fp").agg(F.min("least").alias("component_id"))
    named = least.join(per_class, "class_fp").select("fp", "component_id")
    return (fps.join(named, "fp")
            .select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id"))


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       radius: int = RADIUS, agree: int = AGREE) -> DataFrame:
    """``docs`` with one row of each group left: the smallest id (a null id last),
    among equal ids the smallest text.  The columns stay as they are."""
    cols = docs.columns
    fp, cls = free_name(docs, "fp"), free_name(docs, "class_fp")
    # written beside its row: the fingerprint is computed once and read twice
    marked = stored(docs.withColumn(fp, fingerprint_column(text_col, shingle)), "simhash")
    found = classes(marked.select(F.col(fp).alias("fp")), radius, agree)
    found = found.select(F.col("fp").alias(fp), F.col("class_fp").alias(cls))
    whole = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)])
    order = F.struct(F.col(id_col).isNull(), F.col(id_col), F.col(text_col))
    best = (marked.join(found, fp, "left").groupBy(F.coalesce(F.col(cls), F.col(fp)).alias("g"))
            .agg(F.min_by(whole, order).alias("row")))
    return best.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(cols)])


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))
