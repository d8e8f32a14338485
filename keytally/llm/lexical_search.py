"""Ranked lexical search: MaxScore with pair bounds.

A document's score for an item is the sum of its terms' impacts (integers that fall with
the document's length and the term's frequency in the corpus).  The work is four passes,
none of which moves a document between tasks:

1. terms: every document's length and its counts of the items' terms, stored;
2. corpus counts: documents, terms, and documents holding each of the items' terms;
3. index: documents are taken in shards.  A shard holds, for each term, its list of
   (document, impact) and the greatest impact in each block of documents, and, for each
   pair of terms that an item puts side by side, the intersection of their two lists:
   the greatest *joint* impact in each block where both occur in one document;
4. answers: in each shard an item's terms are taken two by two.  The bound of a pair in
   a block is the greatest of the two single maxima and the joint maximum, which is less
   than their sum wherever the two do not peak together, or do not meet at all.  Pairs
   are scored from the greatest bound down; a document is left as soon as its score so
   far and the bounds still to come in its block stay below the ``k``-th best score.

The best ``k`` of every shard meet in one ranking per item.

Items are taken in groups of about ``at_once`` terms, each a pass over the documents:
only a group's terms, pairs and counts are sent to the tasks, so that is the bound of
what travels.  Documents, lists and candidates never reach the driver.

Defined cases: a null text has no terms (and is no document of the counts); an item
without terms, or whose terms no document has, gets no rows; rows of one ``item_id``,
a null one included, are one item with the terms of all its texts; rows of ``docs``
repeated whole are documents of their own, each with its row and rank; a null ``doc_id``
comes after the others among equal scores; empty tables give an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keytally.llm.common import stored, table

K = 10
AT_ONCE = 1_000_000  # terms of the items that one pass looks for
SHARD_DOCS = 16_384
SHARD_POSTINGS = 1_000_000
BLOCK = 256  # documents of a block
#: Terms are runs of ASCII letters and digits and of everything beyond ASCII.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, in order, repeats included, A-Z in lower case."""
    return text.encode().translate(_FOLD).split() if text else []


class Items:
    """The items of one group: their terms as numbers, and the pairs they put side by
    side.  ``weights`` come once the corpus is counted."""

    def __init__(self, rows: list[tuple[int | None, bytes]]):
        self.words = sorted({w for _, w in rows})
        self.number = {w: k for k, w in enumerate(self.words, 1)}  # 0 is no term
        of: dict = {}
        for item, word in rows:
            of.setdefault(item, set()).add(self.number[word])
        self.ids = sorted(of, key=lambda i: (i is None, i or 0))
        self.terms = [sorted(of[i]) for i in self.ids]

    def weigh(self, holding: dict[int, int], documents: int) -> None:
        """Weights from the documents holding each term; an item's terms are then paired
        by falling weight: terms of like weight have the most to gain from each other."""
        self.weights = np.zeros(len(self.words) + 1, np.int64)
        for t in range(1, len(self.words) + 1):
            self.weights[t] = math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(t, 0) + 1)))
        self.groups, found = [], set()
        for terms in self.terms:
            known = sorted((t for t in terms if holding.get(t)), key=lambda t: (-self.weights[t], t))
            groups = [tuple(sorted(known[k:k + 2])) for k in range(0, len(known), 2)]
            self.groups.append(groups)
            found.update(g for g in groups if len(g) == 2)
        self.pairs = sorted(found)


def counted_terms(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, unknown, n, terms, tfs) of every document with at least one term: its
    length and the numbers and counts of the items' terms in it, packed as int32.  A null
    id is 0 and ``unknown``."""
    number = items.number

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = number.get
        for pdf in batches:
            rows = []
            for doc, unknown, text in zip(pdf["doc_id"], pdf["unknown"], pdf["text"]):
                words = terms_of(text)
                if words:
                    tf = Counter(filter(None, map(get, words)))
                    terms = np.fromiter(tf.keys(), np.int32, len(tf))
                    rows.append((doc, unknown, len(words), terms.tobytes(),
                                 np.fromiter(tf.values(), np.int32, len(tf)).tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "unknown", "n", "terms", "tfs"])

    doc = F.col("doc_id").cast("long")
    rows = docs.where("text is not null").select(F.coalesce(doc, F.lit(0)).alias("doc_id"),
                                                 doc.isNull().alias("unknown"), "text")
    return rows.mapInPandas(count, "doc_id long, unknown boolean, n long, terms binary, tfs binary")


def holding_counts(vectors: DataFrame, n_terms: int) -> dict[int, int]:
    """Documents holding each term: one row a term and task, summed; the driver gets one
    row a term of the group."""

    def held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(n_terms + 1, np.int64)
        for pdf in batches:
            total += np.bincount(np.frombuffer(b"".join(pdf["terms"]), np.int32), minlength=n_terms + 1)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"term": some, "docs": total[some]})

    rows = vectors.select("terms").mapInPandas(held, "term long, docs long").groupBy("term").agg(F.sum("docs"))
    return {int(t): int(d) for t, d in rows.collect()}


def block_maxima(docs: np.ndarray, impacts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(block, greatest impact) of the blocks that ``docs`` (ascending) fall in."""
    if not len(docs):
        return np.empty(0, np.int32), np.empty(0, np.int64)
    blocks = docs // BLOCK
    first = np.flatnonzero(np.diff(blocks, prepend=-1))
    return blocks[first].astype(np.int32), np.maximum.reduceat(impacts, first)


class Shard:
    """Lists of one shard's documents, numbered 0, 1, ... by ascending id."""

    LISTS = ["ids", "unknown", "terms", "term_ends", "docs", "impacts", "block_ends", "blocks", "maxima",
             "pair_ends", "pair_blocks", "pair_maxima"]
    KINDS = [np.int64, np.bool_, np.int32, np.int64, np.int32, np.int64, np.int64, np.int32, np.int64,
             np.int64, np.int32, np.int64]

    @classmethod
    def build(cls, items: Items, documents: int, words: int, ids, unknown, lengths, terms, tfs) -> Shard:
        self = cls()
        ids, unknown = np.asarray(ids, np.int64), np.asarray(unknown, bool)
        order = np.lexsort((ids, unknown))
        self.ids, self.unknown = ids[order], unknown[order]
        lengths = np.asarray(lengths, np.int64)[order]
        widths = np.array([len(terms[o]) // 4 for o in order])
        t = np.frombuffer(b"".join(terms[o] for o in order), np.int32)
        f = np.frombuffer(b"".join(tfs[o] for o in order), np.int32).astype(np.int64)
        d = np.repeat(np.arange(len(order), dtype=np.int32), widths)
        m = 100 - 90 + 90 * lengths * documents // words
        impact = items.weights[t] * (1_000_000_000 * f // (1000 * f + 8 * m[d]))
        by_term = np.argsort(t, kind="stable")
        t, self.docs, self.impacts = t[by_term], d[by_term], impact[by_term]
        first = np.flatnonzero(np.diff(t, prepend=0))
        self.terms, self.term_ends = t[first], np.append(first[1:], len(t)) if len(first) else first
        singles = [block_maxima(*self.list_of(k)) for k in range(len(self.terms))]
        self.block_ends, self.blocks, self.maxima = self._chained(singles)
        self._number()
        dense, joint = np.zeros(len(self.ids), np.int64), []
        for a, b in items.pairs:
            if a not in self.at or b not in self.at:
                joint.append((np.empty(0, np.int32), np.empty(0, np.int64)))
                continue
            docs, impacts = self.list_of(self.at[a])
            dense[docs] = impacts
            other, theirs = self.list_of(self.at[b])
            both = dense[other] > 0
            joint.append(block_maxima(other[both], theirs[both] + dense[other[both]]))
            dense[docs] = 0
        self.pair_ends, self.pair_blocks, self.pair_maxima = self._chained(joint)
        return self

    @staticmethod
    def _chained(lists):
        ends = np.cumsum([len(b) for b, _ in lists], dtype=np.int64)
        blocks = np.concatenate([b for b, _ in lists] or [np.empty(0, np.int32)])
        return ends, blocks, np.concatenate([m for _, m in lists] or [np.empty(0, np.int64)])

    def _number(self):
        self.at = {int(t): k for k, t in enumerate(self.terms)}

    def pack(self) -> tuple:
        return tuple(np.ascontiguousarray(getattr(self, n), k).tobytes() for n, k in zip(self.LISTS, self.KINDS))

    @classmethod
    def unpack(cls, row) -> Shard:
        self = cls()
        for name, kind in zip(cls.LISTS, cls.KINDS):
            setattr(self, name, np.frombuffer(getattr(row, name), kind))
        self._number()
        return self

    def list_of(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        s = slice(self.term_ends[k - 1] if k else 0, self.term_ends[k])
        return self.docs[s], self.impacts[s]

    def _maxima(self, ends, blocks, maxima, k, width):
        out, s = np.zeros(width, np.int64), slice(ends[k - 1] if k else 0, ends[k])
        out[blocks[s]] = maxima[s]
        return out

    def best(self, groups, pair_at: dict, k: int, use_pairs: bool = True) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores) of the ``k`` best for the groups of one or two terms, and
        how many list entries were read.  Without ``use_pairs`` a pair's bound is the sum
        of its two maxima (plain MaxScore)."""
        n, width = len(self.ids), -(-len(self.ids) // BLOCK)
        parts, limits = [], []
        for g in groups:
            here = [self.at[t] for t in g if t in self.at]
            if not here:
                continue
            single = [self._maxima(self.block_ends, self.blocks, self.maxima, h, width) for h in here]
            if len(here) == 2 and use_pairs:
                joint = self._maxima(self.pair_ends, self.pair_blocks, self.pair_maxima, pair_at[g], width)
                limits.append(np.maximum(np.maximum(*single), joint))
            else:
                limits.append(sum(single))
            parts.append(here)
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.int64), 0
        order = np.argsort([-int(b.max()) for b in limits], kind="stable")
        limits = np.array([limits[o] for o in order])
        to_come = np.vstack([np.cumsum(limits[::-1], axis=0)[::-1], np.zeros(width, np.int64)])
        block_of, scores = np.arange(n) // BLOCK, np.zeros(n, np.int64)
        least, read = 1, 0
        for step, o in enumerate(order):
            live = scores + to_come[step][block_of] >= least
            some = np.flatnonzero(live)
            if not len(some):
                break
            for h in parts[o]:
                docs, impacts = self.list_of(h)
                if 8 * len(some) < len(docs):  # few are left: look them up
                    spot = np.searchsorted(docs, some)
                    spot[spot == len(docs)] = 0
                    hit = docs[spot] == some
                    scores[some[hit]] += impacts[spot[hit]]
                    read += len(some)
                else:
                    on = live[docs]
                    scores[docs[on]] += impacts[on]
                    read += len(docs)
            if n > k:
                least = max(least, int(np.partition(scores, n - k)[n - k]))
        found = np.flatnonzero(scores >= least)
        found = found[np.lexsort((found, -scores[found]))][:k]
        return found, scores[found], read


def index(vectors: DataFrame, items: Items, documents: int, words: int, shard_docs: int = SHARD_DOCS,
          shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """One row a shard, its lists packed; a task cuts the documents it reads into shards."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, number = TaskContext.get().partitionId(), 0
        held, postings = [], 0

        def shard():
            nonlocal number, held, postings
            made = Shard.build(items, documents, words, *map(list, zip(*held)))
            out = pd.DataFrame([((task << 32) + number, *made.pack())], columns=["shard", *Shard.LISTS])
            number, held, postings = number + 1, [], 0
            return out

        for pdf in batches:
            for row in pdf.itertuples(index=False, name=None):
                width = len(row[3]) // 4
                if not width:  # holds no term of an item
                    continue
                if held and (len(held) >= shard_docs or postings + width > shard_postings):
                    yield shard()
                held.append(row)
                postings += width
        if held:
            yield shard()

    return vectors.mapInPandas(build, "shard long, " + ", ".join(f"{n} binary" for n in Shard.LISTS))


def answers(shards: DataFrame, items: Items, k: int) -> DataFrame:
    """(item, item_id, doc_id, score): the best ``k`` of each item in each shard."""
    pair_at = {p: n for n, p in enumerate(items.pairs)}

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                shard = Shard.unpack(row)
                out = []
                for number, groups in enumerate(items.groups):
                    found, scores, _ = shard.best(groups, pair_at, k)
                    out.extend((number, items.ids[number], None if shard.unknown[d] else shard.ids[d], s)
                               for d, s in zip(found, scores))
                yield pd.DataFrame(out, columns=["item", "item_id", "doc_id", "score"]).astype(
                    {"item": "int64", "item_id": "Int64", "doc_id": "Int64", "score": "int64"})

    return shards.mapInPandas(answer, "item long, item_id long, doc_id long, score long")


def item_terms(queries: DataFrame) -> DataFrame:
    """(item_id, term): the distinct terms of each item."""

    @F.pandas_udf("array<binary>")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sorted(set(terms_of(t))))

    return queries.select(F.col("item_id").cast("long").alias("item_id"), F.explode(cut("text")).alias("term")).distinct()


def search(docs: DataFrame, queries: DataFrame, k: int = K, at_once: int = AT_ONCE,
           shard_docs: int = SHARD_DOCS, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring documents of each row of
    ``queries`` (item_id, text), equal scores by ascending ``doc_id``."""
    wanted = stored(item_terms(queries), "search-items")
    groups = max(1, -(-wanted.count() // at_once))
    found = None
    for g in range(groups):
        rows = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == F.lit(g)).collect()
        items = Items([(r["item_id"], bytes(r["term"])) for r in rows])
        vectors = stored(counted_terms(docs, items), "search-terms")
        documents, words = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        items.weigh(holding_counts(vectors, len(items.words)), documents)
        shards = stored(index(vectors, items, documents, words, shard_docs, shard_postings), "search-index")
        part = answers(shards, items, k).withColumn("group", F.lit(g))
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("group", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item of ``benchmark`` against all documents."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Every document against every item, in DuckDB.
ORACLE = r"""
with d as (select row_number() over () as r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[0-9a-z\x{80}-\x{10FFFF}]+') as terms
  from documents where text is not null),
e as (select r, doc_id, len(terms) as n from d where len(terms) > 0),
c as (select count(*) as documents, sum(n) as words from e),
tf as (select r, term, count(*) as tf from (select r, unnest(terms) as term from d) group by r, term),
q as (select distinct item_id, unnest(
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[0-9a-z\x{80}-\x{10FFFF}]+')) as term from benchmark),
w as (select term, cast(floor(1000 * ln(cast(2 * documents + 2 as double) / (2 * count(*) + 1))) as bigint) as w
  from tf, c where term in (select term from q) group by term, documents),
s as (select q.item_id, e.r, e.doc_id, cast(sum(w.w * ((1000000000 * tf.tf) //
    (1000 * tf.tf + 8 * (100 - 90 + cast((90 * e.n * c.documents) // c.words as bigint))))) as bigint) as score
  from q join w on w.term = q.term join tf on tf.term = q.term join e on e.r = tf.r, c
  group by q.item_id, e.r, e.doc_id),
k as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from k where rank <= 10
"""
