"""Connected components of an edge table by alternating large and small stars; nothing is gathered on the driver but
one count a round."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.llm.common import written


def _linked(pairs: DataFrame) -> DataFrame:
    return pairs.where("hi <> lo").select(F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it sees."""
    both = edges.select(F.col("hi").alias("node"), F.col("lo").alias("other")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("hi").alias("other")))
    least = both.groupBy("node").agg(F.min("other").alias("seen")).select("node", F.least("node", "seen").alias("root"))
    return _linked(both.where("other > node").join(least, "node").select(F.col("other").alias("hi"), F.col("root").alias("lo")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("root"))
    handed = edges.join(least, "hi").select(F.col("lo").alias("hi"), F.col("root").alias("lo"))
    return _linked(handed.unionByName(least.select("hi", F.col("root").alias("lo"))))


def settled(edges: DataFrame) -> bool:
    """Whether all components are stars around their smallest node: no node has two smaller neighbours, or a smaller and a
    larger one."""
    ends = edges.select(F.col("hi").alias("node"), F.lit(1).alias("as_hi")).unionByName(
        edges.select(F.col("lo").alias("node"), F.lit(0).alias("as_hi")))
    by_node = ends.groupBy("node").agg(F.sum("as_hi").alias("smaller"), F.min("as_hi").alias("least"))
    return by_node.where("smaller > 1 OR smaller = 1 AND least = 0").count() == 0


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """node, root: for each node of an edge table (columns hi, lo) the smallest node it can reach, itself included.

    Only aggregates and joins on nodes are used: the star of a large component is a column of rows that the joins may
    split, never one row or group. Each round is written to the shared folder, which ends the lineage.
    """
    now = written(spark, _linked(edges), "components")
    while not settled(now):
        now = written(spark, _small_star(_large_star(now)), "components")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
