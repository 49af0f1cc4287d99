"""Connected components of a graph given by its edges, by alternating star contractions.

A large star joins the larger neighbours of every node to its smallest one, a small star the smaller
ones; repeated, every component becomes one star around its smallest node. Edges never meet in one
task by more than a bounded share, and every round is written, so a lost executor costs one round.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm.tables import attach
from playlake.scratch import scratch_dir, stage


def components(edges: DataFrame) -> DataFrame:
    """node, root of every node that has an edge other than itself; `edges` are (a, b) in any direction.

    `root` is the smallest node that can be reached. Rows with a null and self-loops are ignored.
    """
    work = scratch_dir(edges.sparkSession)
    clean = edges.where("a != b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    stars = stage(clean.distinct(), f"{work}/0")
    step = 0
    while not _is_done(stars):
        step += 1
        large = _star(stars.unionByName(stars.selectExpr("root AS node", "node AS root")), f"{work}/{step}/low")
        large = stage(large.where("root > node").select(F.col("root").alias("node"), F.col("low").alias("root")).distinct(), f"{work}/{step}/large")
        small = _star(large, f"{work}/{step}/lower")
        kept = small.where("root != low").select(F.col("root").alias("node"), F.col("low").alias("root"))
        kept = kept.unionByName(small.select("node", F.col("low").alias("root")))
        stars = stage(kept.distinct(), f"{work}/{step}/small")
    return stars


def _star(edges: DataFrame, path: str) -> DataFrame:
    """Every edge with the smallest of its node and the node's neighbours."""
    low = edges.groupBy("node").agg(F.min("root").alias("low"), F.count(F.lit(1)).alias("n"))
    low = stage(low.withColumn("low", F.least("low", "node")), path)
    return attach(edges, low, "node", "n")


def _is_done(stars: DataFrame) -> bool:
    """Whether every node has one root, and no root is a node of another."""
    several = stars.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not several.isEmpty():
        return False
    roots = stars.select(F.col("root").alias("node")).distinct()
    return stars.join(roots, "node", "left_semi").isEmpty()
