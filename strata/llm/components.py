"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import keep

#: Edges beyond which no neighbours are broadcast, and what a task takes of fewer, about: in so small a round tasks cost more than rows.
EDGES, TOGETHER = 200_000, 10_000


def gathered(rows: DataFrame, tasks: int | None) -> DataFrame:
    """`rows`, counted to be few, in so many tasks; None leaves them as they are. After a shuffle, whose partitions a task then reads together."""
    return rows.coalesce(tasks) if tasks else rows


def _split(least: DataFrame, few: int | None) -> DataFrame:
    """The smallest neighbour of each node, in the form in which a hub's edges don't all meet in one task to get it: broadcast where the
    edges, of which there are at least as many, were counted to be few; else a written table, so that adaptive execution can split the hub."""
    return F.broadcast(gathered(least, few)) if few else keep(least, "least").hint("merge")


def _large_star(edges: DataFrame, few: int | None) -> DataFrame:
    """Every node sends its larger neighbours to the smallest node it knows."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = _split(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), few)
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, few: int | None) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = gathered(down.groupBy("u").agg(F.min("v").alias("m")), few)
    met = down.join(_split(least, few), "u")
    return met.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))


def components(edges: DataFrame) -> DataFrame:
    """Columns `node` and `root`, the smallest node of its component, for every node of an edge.

    edges: columns a and b of one orderable type; direction, repetition and loops don't matter. Alternating star contraction:
    in each round nodes hang on the smallest neighbour known, until every edge leads from a node to its root. The number
    of rounds grows with the logarithm of the largest component. Each round is written to the shared folder. No edges: no rows.
    """
    now = keep(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    seen = now.count()
    few = 1 + seen // TOGETHER if seen <= EDGES else None  # tasks of a round; rounds never add edges
    now = gathered(now, few)
    before = None
    while True:
        now = keep(gathered(_small_star(_large_star(now, few), few).filter("a <> b").distinct(), few), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return gathered(leaves.union(now.select("b", "b")).distinct(), few)
