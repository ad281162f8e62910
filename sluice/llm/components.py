"""Connected components by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sluice.sources.workspace import new_folder, remove, write_table


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return hung.union(least.select("u", F.col("m").alias("v"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs below one other node that hangs below none; nothing is left to do then."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    roles = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return roles.filter("below > 1 OR below + above > 1").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component, the smallest node that it reaches, of every node in ``links``; links may stand either way round.

    Every turn hangs all neighbours of a node below the smallest one, until every component is a star. Nodes with many
    neighbours aren't gathered: their smallest neighbour is found by partial aggregation and joined back, where adaptive
    execution splits a hot key. Each turn is written to the shared folder, so a lost executor costs at most a turn.
    The result is a table there.
    """
    spark = links.sparkSession
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    folder = new_folder(spark, "components")
    edges = write_table(edges, folder)
    while not _are_stars(edges):
        old, folder = folder, new_folder(spark, "components")
        edges = write_table(_small(_large(edges)), folder)
        remove(spark, old)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
