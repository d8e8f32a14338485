"""Connected components of a link table, as Spark joins and groupings.

Alternating large-star and small-star steps (Kiveris et al., 2014): each node is
re-linked to the smallest node it sees until every link is a star around the
smallest node of its component.  No list of links ever reaches one task or the
driver; a hub's links are rows of a skew-splittable join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keytally.llm.common import stored


def _to_smallest(links: DataFrame) -> DataFrame:
    """(a, b) -> (a, b, least): the smallest neighbour of a, itself included."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    return links.join(least, "a").select("a", "b", F.least("a", "least").alias("least"))


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """One row (node, component) per node that occurs in ``links``.

    ``component`` is the smallest node reachable.  Links may repeat, point either
    way or join a node with itself; rows with a null end are ignored.  An empty
    table gives an empty result.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    own = links.where("a = b").select("a", "b")
    big = stored(links.where("a <> b")
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    for _ in range(max_rounds):
        # large star: neighbours above a node move to the node's smallest neighbour
        both = big.unionByName(big.select(F.col("b").alias("a"), F.col("a").alias("b")))
        star = (_to_smallest(both).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
                .where("a <> b").distinct())
        # small star: a node and its smaller neighbours move to the smallest of them
        near = _to_smallest(star)
        moved = near.select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("least").alias("y")),
                                              F.struct(F.col("b").alias("x"), F.col("least").alias("y")))).alias("p"))
        big = stored(moved.select(F.col("p.x").alias("a"), F.col("p.y").alias("b")).where("a <> b").distinct(),
                     "links")
        now = tuple(big.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = big.select(F.col("b").alias("node"), F.col("b").alias("component"))
    alone = own.select(F.col("a").alias("node"), F.col("a").alias("component"))
    members = big.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.unionByName(roots).unionByName(alone).groupBy("node").agg(F.min("component").alias("component"))
