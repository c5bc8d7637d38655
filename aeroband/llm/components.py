"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroband.session import written_once


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it is connected to, for every node of ``edges`` (``u``, ``v``) with one.

    Each round is written to the shared folder, which cuts the lineage and outlives executors. The minimum per node is
    combined before the exchange, so a node with very many neighbours sends one row per task; the join that hands the
    minimum back is one whose large partitions Spark splits. Edges from a node to itself are left out.
    """
    links = written_once(_oriented(edges.select("u", "v")).distinct())
    state = None
    while True:
        found = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == state:
            break
        state = found
        links = written_once(_small_star(_large_star(links)))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _oriented(links: DataFrame) -> DataFrame:
    """From the greater to the lesser node."""
    return links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    links = _oriented(links)
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
