"""Mixing sources to target weights by cube-method balanced sampling.

A document's size is its number of words ``[^\\x20\\x09-\\x0D]+``.  Sources, in code
point order with null last, weigh 1, 2, 3, repeating, and share the total of all
sizes; a target stops at ``cap`` times its source's size and the excess is shared
again by weight among the others.  A source with target / size = r takes every
document floor(r) times and once more with inclusion probability r - floor(r).

The extra copies are drawn by the cube method: probabilities move along the null
space of the constraints (sum of sizes, number of documents) until they reach 0 or
1, so both totals stay as they are at every step.  A source is dealt by a hash to
groups of about ``group`` documents; each group's flight ends with two or fewer
documents undecided, and these of all groups meet in the next round.  In a source's last
group ``RESERVE`` documents of sizes spread over all of them do not fly; they and the two
that are left are landed together: of all choices the one that misses the words least,
then the documents.  Choices are drawn from a hash of the rows, so reruns agree.

Rows that are repeated whole are one class with a count.  The copies of a class are drawn
as documents of their own, but only how many of them are taken is kept, so no list of
copies is ever gathered and which of them is which does not matter.

Defined cases: a null text has size 0 and is taken 0 times its size; a null source
is a source, last in order; documents of size 0 take no part in the draw (taken 0);
repeated ids and rows are separate documents; with no words at all targets are 0; an
empty table gives an empty result; other columns are kept by ``mixed`` (where they tell
rows apart) and ignored by ``mix_sizes``.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keytally.llm.common import free_name, stored, table

CAP = 3
GROUP = 2000
RESERVE = 14  # documents that are landed with the undecided ones
TOGETHER = 10_000  # copies of a class that are numbered in one task
WORDS = r"[^\x20\x09-\x0D]+"
SEED = 42
_EPS = 1e-9


def flight(size: list[float], p: list[float], rng: random.Random) -> list[float]:
    """Move ``p`` until two or fewer entries lie strictly between 0 and 1, keeping
    the sums of ``p`` and of ``size * p``."""
    p = list(p)
    todo = iter(range(len(p)))
    live: list[int] = []
    while True:
        while len(live) < 3:
            i = next(todo, None)
            if i is None:
                break
            if _EPS < p[i] < 1 - _EPS:
                live.append(i)
            else:
                p[i] = round(p[i])
        if len(live) == 3:
            a, b, c = (size[i] for i in live)
            u = [b - c, c - a, a - b]
            if not any(u):
                u = [1.0, -1.0, 0.0]
        elif len(live) == 2 and size[live[0]] == size[live[1]]:
            u = [1.0, -1.0]
        else:
            return p
        up = min((1 - p[i]) / d if d > 0 else p[i] / -d for i, d in zip(live, u, strict=True) if d)
        down = min(p[i] / d if d > 0 else (1 - p[i]) / -d for i, d in zip(live, u, strict=True) if d)
        step = up if rng.random() * (up + down) < down else -down
        for i, d in zip(live, u, strict=True):
            p[i] += step * d
            if p[i] < _EPS:
                p[i] = 0.0
            elif p[i] > 1 - _EPS:
                p[i] = 1.0
        live = [i for i in live if 0.0 < p[i] < 1.0]


def land(size: list[float], p: list[float]) -> list[float]:
    """Round the few entries that are left so that the miss in words is least, and of
    such choices the miss in documents."""
    left = [i for i, x in enumerate(p) if 0.0 < x < 1.0]
    words, docs = np.zeros(1), np.zeros(1)
    for i in left:  # bit k of a choice says whether the k-th is taken
        words, docs = np.concatenate([words, words + size[i]]), np.concatenate([docs, docs + 1])
    miss = np.abs(words - sum(size[i] * p[i] for i in left))
    far = np.abs(docs - sum(p[i] for i in left))
    best = int(np.lexsort((np.arange(len(miss)), far, np.round(miss)))[0])
    for k, i in enumerate(left):
        p[i] = float(best >> k & 1)
    return p


def _draw(pdf: pd.DataFrame) -> pd.DataFrame:
    # largest first: the documents that stay undecided, and the miss they leave, are small
    pdf = pdf.sort_values(["size", "h", "k"], ascending=[False, True, True], ignore_index=True)
    rng = random.Random(f"{SEED}-{pdf['h'].iat[0]}-{len(pdf)}")
    size, p = pdf["size"].astype(float).to_numpy(), pdf["p"].to_numpy().copy()
    if pdf["last"].iat[0]:
        # one of every so many by size, the smallest among them
        kept = np.unique(np.linspace(0, len(pdf) - 1, min(RESERVE, len(pdf))).astype(int))
        fly = np.setdiff1d(np.arange(len(pdf)), kept)
        p[fly] = flight(size[fly].tolist(), p[fly].tolist(), rng)
        p = land(size.tolist(), p.tolist())
    else:
        p = flight(size.tolist(), p.tolist(), rng)
    pdf["p"] = p
    return pdf[["source", "size", "cls", "k", "h", "p"]]


def targets(sizes: DataFrame, cap: int = CAP) -> DataFrame:
    """(source, docs, source_size, target) from (source, size): weights 1, 2, 3 in
    order, capped at ``cap`` times the source's size with the excess shared again.

    With sources in ascending order of cap per weight, a source is capped if what
    the capped ones before it leave, shared by weight, exceeds its own cap; the last
    capped source therefore fixes the share of all that follow.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                      F.sum((F.col("size") > 0).cast("long")).alias("docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double")
    per = per.withColumn("weight", w).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per = (per.withColumn("left", F.sum("source_size").over(everything)
                          - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
           .withColumn("weights", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
           .withColumn("level", F.col("left") / F.col("weights")))
    free = F.col("level") * F.col("weight") < F.col("most")
    # the first source that is not capped sets the share of all after it
    first = per.withColumn("k", F.row_number().over(order)).withColumn("free", free)
    share = F.min(F.when(F.col("free"), F.struct("k", "level"))).over(everything)
    first = first.withColumn("share", share)
    target = F.when(F.col("share").isNotNull() & (F.col("k") >= F.col("share.k")),
                    F.least(F.col("share.level") * F.col("weight"), F.col("most"))).otherwise(F.col("most"))
    return first.select("source", "docs", "source_size", target.alias("target"))


def _words(text_col: str):
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).cast("long")


def _class(df: DataFrame, cols: list[str]):
    """A hash of a row's columns (maps have none and tell no rows apart)."""
    kinds = dict(df.dtypes)
    return F.xxhash64(*[F.col(f"`{c}`") for c in cols if "map<" not in kinds[c]])


def _decided(rows: DataFrame, cap: int, group: int) -> DataFrame:
    """(id, source, size, cls) rows -> one row per class: how many copies there are, how
    often each is taken at least (``whole``), and how many once more (``extra``)."""
    rows = stored(rows.groupBy("id", "source", "size", "cls").agg(F.count(F.lit(1)).alias("copies")), "sizes")
    goal = stored(targets(rows.select("source", (F.col("size") * F.col("copies")).alias("size")), cap), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = (rows.join(goal.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
             .withColumn("whole", F.floor(rate)).withColumn("p", rate - F.col("whole")))
    rated = stored(rated, "rated")
    drawn = (F.col("size") > 0) & (F.col("p") > _EPS) & (F.col("p") < 1 - _EPS)
    left = (_copies(rated.where(drawn).select("source", "size", "cls", "copies", "p"))
            .select("source", "size", "cls", "k", F.xxhash64("cls", "size", "k", F.lit(SEED)).alias("h"), "p"))
    extra = None
    for level in range(40):
        per = left.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / F.lit(group)).cast("int").alias("groups"))
        per = per.withColumnRenamed("source", "s")
        dealt = (left.join(per, F.col("source").eqNullSafe(F.col("s"))).drop("s")
                 .withColumn("g", F.pmod(F.xxhash64("h", F.lit(level)), F.col("groups")).cast("int"))
                 .withColumn("last", F.col("groups") == 1))
        done = stored(dealt.groupBy("source", "g").applyInPandas(
            _draw, "source " + dict(rows.dtypes)["source"] + ", size long, cls long, k long, h long, p double"), "draw")
        chosen = done.where("p = 1").groupBy("source", "size", "cls").agg(F.count(F.lit(1)).alias("extra"))
        extra = chosen if extra is None else extra.unionByName(chosen)
        left = done.where("p > 0 and p < 1")
        if left.isEmpty():
            break
    extra = (extra.groupBy("source", "size", "cls").agg(F.sum("extra").alias("extra"))
             .toDF("xsource", "xsize", "xcls", "extra"))
    both = rated.join(extra, F.col("source").eqNullSafe(F.col("xsource")) & (F.col("size") == F.col("xsize"))
                      & (F.col("cls") == F.col("xcls")), "left")
    sure = F.when(F.col("p") >= 1 - _EPS, F.col("copies")).otherwise(F.lit(0))
    return both.select("id", "source", "size", "cls", "copies", "source_size", "target",
                       F.least("whole", F.lit(cap)).cast("int").alias("whole"),
                       F.when(F.col("whole") >= cap, F.lit(0)).otherwise(F.coalesce("extra", sure)).cast("long").alias("extra"))


def _copies(classes: DataFrame) -> DataFrame:
    """A row for each copy of a class, numbered ``k``.  A class of very many copies is cut
    before it is expanded, so its copies are made in many tasks."""
    part = (classes.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / TOGETHER))))
            .repartition("cls", "part"))
    first = F.col("part") * TOGETHER
    return part.withColumn("k", F.explode(F.sequence(first, F.least(first + TOGETHER, F.col("copies")) - 1))).drop("part")


def mix_sizes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
              cap: int = CAP, group: int = GROUP) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target``, ``taken``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), _words(text_col).alias("size"),
                       _class(docs, [id_col, source_col, text_col]).alias("cls"))
    times = F.col("whole") + (F.col("k") < F.col("extra")).cast("int")
    return _copies(_decided(rows, cap, group)).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), F.col("size").alias("size"), "source_size",
        "target", (times * F.col("size")).cast("long").alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
          cap: int = CAP, group: int = GROUP) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it is taken, columns as
    they are.  Documents of no words weigh nothing in the mix and are kept once.

    Where only some copies of a class are taken once more, the class is brought to one
    row and that row repeated: its copies are equal in every column."""
    cols = docs.columns
    cls, total, copies, row = (free_name(docs, f"mix_{c}") for c in ("cls", "total", "copies", "row"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), _words(text_col).alias("size"),
                       _class(docs, cols).alias("cls"))
    once = F.when(F.col("size") > 0, F.col("whole")).otherwise(F.lit(1))
    decided = stored(_decided(rows, cap, group).groupBy("cls").agg(
        F.sum(once * F.col("copies") + F.col("extra")).alias(total), F.sum("copies").alias(copies)), "decided")
    taken = docs.withColumn(cls, _class(docs, cols)).join(decided.withColumnRenamed("cls", cls), cls)
    even = F.col(total) % F.col(copies) == 0
    same = (taken.where(even & (F.col(total) > 0))
            .withColumn(row, F.explode(F.sequence(F.lit(1), (F.col(total) / F.col(copies)).cast("int")))))
    some = (taken.where(~even).groupBy(cls).agg(F.first(F.struct(*[F.col(f"`{c}`") for c in cols])).alias(row),
                                                F.first(total).alias("copies")).withColumnRenamed(cls, "cls"))
    return same.select(*[F.col(f"`{c}`") for c in cols]).unionByName(_copies(some).select(f"{row}.*"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sizes(table(spark, sf_dir, "documents")).drop("source")
