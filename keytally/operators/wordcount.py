"""Word count: lower-case, split into words, re-key by word, count per word.

Plan shape (batch): scan -> Generate(explode) -> partial HashAggregate ->
Exchange hashpartitioning(word) -> final HashAggregate.  The partial aggregate
sends one row per distinct word per task over the shuffle, so a very common
word ("the") costs the same as a rare one; no salting is needed.

Streams: the same functions work on a streaming DataFrame; the aggregate then
keeps its counts in the state store and emits changed words per micro-batch.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keytally.functions.text import UNICODE_WORD_SEPARATOR, WORD_SEPARATOR, with_tokens
from keytally.operators.changelog import BUCKET, DATA, Cuts, order_cuts, with_bucket

# Characters of text in a bucket of the word log, about, and at most where it is counted
# as one group in memory.
BUCKET_CHARS = 16 << 20
GROUP_CHARS = 4 * BUCKET_CHARS
# rows of a record batch that a group gives back
BATCH = 1 << 16


def _sep(unicode: bool) -> str:
    return UNICODE_WORD_SEPARATOR if unicode else WORD_SEPARATOR


def words(lines: DataFrame, value: str = "value", unicode: bool = False) -> DataFrame:
    """One row per word (``word`` column); null lines carry no words.
    ``unicode=True`` treats letters of every script as word characters (the
    reference's ``\\W`` is ASCII-only)."""
    # explode_outer + a null filter, not explode: for explode Catalyst infers a
    # ``size(tokens) > 0`` filter and pushes it (with the whole split) below the
    # repartition, onto the coarse scan.  Tokens are never null, so this is exact.
    toks = with_tokens(lines, value, "_toks", separator=_sep(unicode))
    return toks.select(F.explode_outer("_toks").alias("word")).where(F.col("word").isNotNull())


def word_count(lines: DataFrame, value: str = "value", unicode: bool = False) -> DataFrame:
    """(word, count) over all lines; ``""`` is a word when a line is empty or
    starts with a separator, as in the reference."""
    return (words(lines.where(F.col(value).isNotNull()), value, unicode)
            .groupBy("word").agg(F.count(F.lit(1)).alias("count")))


def line_tokens(lines: DataFrame, value: str = "value", order: str = "offset",
                unicode: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """(offset, pos, word): the words of each line with their position, and the columns
    ``keep`` of the line."""
    src = lines.where(F.col(value).isNotNull())
    toks = with_tokens(src, value, "_toks", keep=[order, *keep], separator=_sep(unicode))
    return (toks.select(F.col(order), *keep, F.posexplode_outer("_toks").alias("pos", "word"))
            .where(F.col("pos").isNotNull())
            .withColumn("pos", F.col("pos").cast("long")))


def line_cuts(lines: DataFrame, value: str = "value", order: str = "offset", buckets: int | None = None) -> Cuts:
    """Cuts of the line order that leave about equally many words between them, judged
    by the lines' lengths: a line counts once for every 1,000 characters begun."""
    weight = F.ceil(F.greatest(F.lit(1), F.length(value)) / F.lit(1000)).cast("int")
    weighed = lines.where(F.col(value).isNotNull()).select(order, F.explode(F.sequence(F.lit(1), weight)))
    return order_cuts(weighed, order, buckets, BUCKET_CHARS // 1000)


def _flat_tokens(lines: pa.Table) -> tuple[pa.Array, np.ndarray]:
    """All words of the lines, and each line's number of words."""
    toks = lines["_toks"].combine_chunks()
    return toks.flatten(), pc.list_value_length(toks).to_numpy(zero_copy_only=False).astype(np.int64)


def _word_totals(lines: pa.Table) -> pa.Table:
    """(bucket, word, n) of the distinct words of a bucket's lines."""
    counted = _flat_tokens(lines)[0].value_counts()
    bucket = pa.array(np.full(len(counted), lines[BUCKET][0].as_py(), np.int64))
    return pa.table({BUCKET: bucket, "word": counted.field("values"), "_n": counted.field("counts")})


def _running_counts(order: str):
    """Counts of every word so far in a bucket's lines, from those before the bucket."""
    def counts(lines: pa.Table, carry: pa.Table) -> pa.Table:
        at = lines[order].to_numpy()
        by_order = np.argsort(at, kind="stable")
        lines, at = lines.take(pa.array(by_order)), at[by_order]
        words, size = _flat_tokens(lines)
        line = np.repeat(np.arange(len(at)), size)
        pos = np.arange(len(line)) - np.repeat(np.cumsum(size) - size, size)
        if (at[1:] == at[:-1]).any():  # lines that share their place are read position by position
            read = np.lexsort((pos, at[line]))
            words, line, pos = words.take(pa.array(read)), line[read], pos[read]
        known = carry["word"].combine_chunks()
        coded = pa.concat_arrays([known, words]).dictionary_encode()
        code = coded.indices.to_numpy()
        before = np.zeros(len(coded.dictionary), np.int64)
        before[code[:len(known)]] = carry["_n"].to_numpy()
        # codes and places in one number: sorted, a word's occurrences follow each other
        key = code[len(known):].astype(np.uint64) << np.uint64(32) | np.arange(len(line), dtype=np.uint64)
        key.sort()
        place, own = (key & np.uint64(0xFFFFFFFF)).astype(np.int64), (key >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]][:len(own)])
        rank = np.arange(len(own)) - np.repeat(first, np.diff(np.r_[first, len(own)]))
        count = np.empty(len(own), np.int64)
        count[place] = rank + 1 + before[own]
        out = pa.table({order: lines[order].take(pa.array(line)), "pos": pos, "word": words, "count": count})
        return pa.Table.from_batches(out.to_batches(max_chunksize=BATCH), out.schema)

    return counts


def running_word_count(lines: DataFrame, value: str = "value", order: str = "offset", *,
                       bounds: Cuts | tuple[int, ...] | None = None, buckets: int | None = None,
                       group_chars: int = GROUP_CHARS) -> DataFrame:
    """The word-count changelog: for every word occurrence, in read order
    (line order, then position), the count of that word so far.

    Two-level (see :mod:`keytally.operators.changelog`): buckets of line order,
    so a common word is spread over many tasks.  The lines are shuffled once, by bucket;
    a bucket gives a row of totals per distinct word, and is counted from the prefix of
    those totals, as one group of Arrow rows.  Words are not sorted or shuffled one by one.

    Buckets beyond ``group_chars`` characters (one place holds very many lines, or a line
    is very long) and lines without a place never become one group: their words are
    windowed one by one per (word, bucket), from the same prefix.
    """
    src = lines.where(F.col(value).isNotNull()).select(order, value)
    if bounds is None:
        bounds = line_cuts(src, value, order, buckets)
    dealt = with_bucket(src, order, bounds, buckets)
    # one row per bucket that is no group, none as a rule
    big = (dealt.groupBy(BUCKET).agg(F.sum(F.length(value) + 1).alias("n"), F.count(F.lit(1)).alias("all"),
                                     F.count(order).alias("placed"))
           .where((F.col("n") > group_chars) | (F.col("all") > F.col("placed"))).select(BUCKET).collect())
    odd = F.col(BUCKET).isNull() | F.col(BUCKET).isin([r[BUCKET] for r in big if r[BUCKET] is not None])

    whole = with_tokens(dealt.where(~odd).repartition(BUCKET), value, "_toks", keep=[BUCKET, order])
    totals = whole.groupBy(BUCKET).applyInArrow(_word_totals, f"{BUCKET} long, word string, _n long")
    if big:
        single = line_tokens(dealt.where(odd), value, order, keep=[BUCKET])
        totals = totals.unionByName(single.groupBy(BUCKET, "word").agg(F.count(F.lit(1)).alias("_n")))
    before = Window.partitionBy("word").orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carry = (totals.select(BUCKET, "word", F.sum("_n").over(before).alias("_n"))
             .where(F.col("_n").isNotNull()))  # a word's first bucket has nothing before it
    kind = src.schema[order].dataType.simpleString()
    out = whole.groupBy(BUCKET).cogroup(carry.where(~odd).groupBy(BUCKET)).applyInArrow(
        _running_counts(order), f"`{order}` {kind}, pos long, word string, count long")
    if big:
        both = single.select("*", F.lit(1).cast("long").alias("_n"), F.lit(1).alias(DATA)).unionByName(
            carry.where(odd).select("*", F.lit(0).alias(DATA)), allowMissingColumns=True)
        upto = (Window.partitionBy("word", BUCKET).orderBy(DATA, order, "pos")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        out = out.unionByName(both.select(order, "pos", "word", F.sum("_n").over(upto).alias("count"), DATA)
                              .where(F.col(DATA) == F.lit(1)).drop(DATA))
    return out
