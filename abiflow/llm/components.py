"""Connected components of a graph of links, by alternating stars.

Each round links every node's larger neighbours to its smallest one and then
its smaller neighbours to their smallest; edges end as one star per
component after a number of rounds that grows with the logarithm of the
graph's size.  Rounds are joins and aggregates over the edges, whose
per-node minimum combines before the shuffle; a round's edges are cut from
their lineage by ``checkpoint()`` in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _towards_least(e: DataFrame) -> DataFrame:
    """e(u, v) with the least v of each u, and of u itself, as m."""
    least = e.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("x")).select("k", F.least("k", "x").alias("m"))
    return e.join(least, F.col("u") == F.col("k")).select("u", "v", "m")


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
    return _towards_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    out = _towards_least(down)
    star = out.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return star.where("u <> v").distinct()


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): every node of an edge and the least node it reaches.
    Self-loops and null ends are ignored; nodes without edges aren't listed."""
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    e = checkpointed(e)
    state = _state(e)
    while state[0]:
        e = checkpointed(_small_star(_large_star(e)))
        before, state = state, _state(e)
        if state == before:
            break
    # every edge now joins a node to the least of its component
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
