"""Connected components of a link table by alternating stars, as joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.tables import materialize

BROADCAST_LINKS = 50_000


def _large_star(edges: DataFrame, few: bool) -> DataFrame:
    """At most a row per link; repeated rows are merged with those of the small star."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(F.broadcast(least) if few else least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, few: bool) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(F.broadcast(least) if few else least, "u").filter("v <> m").select("v", "m")
    return moved.union(least.select("u", "m")).toDF("a", "b").distinct()


def _unsettled(edges: DataFrame) -> tuple[int, int]:
    """Ids that are linked to several smaller ones, or to smaller and larger ones; and the number of links."""
    ends = edges.select("a", F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    each = ends.groupBy("a").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    found = each.agg(F.count_if(F.expr("up > 1 OR up > 0 AND down > 0")), F.sum("up")).first()
    return found[0], found[1] or 0


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id in ``links`` (a, b) that is not itself the smallest.

    Each round replaces the links by ones to smaller neighbours, until every id has one link to the smallest and the
    smallest has none of its own: about log(n) rounds, none if the links are like that. Up to ``BROADCAST_LINKS`` links,
    the smallest neighbours are broadcast, which spares a round its shuffled joins. Rounds are written to the shared
    folder, so a lost executor costs no earlier round. Null ids and links of an id to itself are left out.
    """
    edges = materialize(links.toDF("a", "b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    while True:
        unsettled, n = _unsettled(edges)
        if not unsettled:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
        few = n <= BROADCAST_LINKS
        edges = materialize(_small_star(_large_star(edges, few), few), "links")
