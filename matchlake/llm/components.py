"""Connected components of a link table, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.storing import discard, stored


def star_links(links: DataFrame) -> DataFrame:
    """``a`` and ``b`` for every linked node but the smallest of its component: the node and that smallest one.

    ``links`` has long columns ``a`` and ``b``; direction, loops and repetition do not matter, rows with a NULL end are
    ignored. Alternates two star steps until every component is a star: every neighbour above a node is tied to the smallest
    neighbour, then the same for those below. The number of links never grows, the number of rounds goes with the
    logarithm of the longest path; links that are such stars already take no round. Each round is written to the shared
    folder; neighbourhoods are reduced with map-side combination and joined, never collected.
    """
    def tied(pairs: DataFrame, large: bool) -> DataFrame:
        ends = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
        sides = ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else ends
        least = sides.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        ties = sides.join(least, "u")
        if large:
            out = ties.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            # The node itself is tied to its smallest neighbour as well.
            out = ties.select("v", "m").unionByName(least.select(F.col("u").alias("v"), "m")).select(F.col("v").alias("a"), F.col("m").alias("b"))
        return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def are_stars(pairs: DataFrame) -> bool:
        """Whether every upper end has one link only. Pairs are distinct, with the greater end as ``a``."""
        roles = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.lit(1).alias("above")), F.struct(F.col("b").alias("u"), F.lit(0).alias("above")))).alias("end"))
        ends = roles.groupBy("end.u").agg(F.max("end.above").alias("above"), F.count("*").alias("n"))
        return ends.agg(F.count_if(F.expr("above = 1 AND n > 1"))).first()[0] == 0

    now = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not are_stars(now):
        last, now = now, stored(tied(tied(now, large=True), large=False))
        discard(last)
    return now


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component_id``, the smallest node it can be reached from, for every node that has a link; see ``star_links``."""
    tied = star_links(links)
    return tied.select(F.col("a").alias("node"), F.col("b").alias("component_id")).unionByName(
        tied.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct(),
    )
