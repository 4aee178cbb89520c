"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavelake.llm.common import kept

EDGES_OF_A_TASK = 200_000


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node that has a link; the component is its smallest node.

    Links with a null end or with equal ends are passed over. Each step aggregates before it joins, so a node with
    very many links costs one partial minimum per task; only counts and a checksum reach the driver.
    """
    edges = kept(links.where(f"{a} <> {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    tasks = 1 + edges.count() // EDGES_OF_A_TASK  # edges never become more; few need few files for each shuffle
    edges, seen = edges.coalesce(tasks), None
    while True:
        mark = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == seen:
            break
        seen = mark
        if not mark["n"]:
            break
        edges = kept(_small_star(_large_star(edges).coalesce(tasks)).coalesce(tasks))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
