"""Connected components of a graph of integer nodes by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.session import stage


def _star(edges: DataFrame, low: str, high: str) -> DataFrame:
    """Hang the neighbours of a node on the smallest node around it.

    ``high`` is the centre of each edge, ``low`` its neighbour. Minima are combined before
    the shuffle and written, so the join back is a plain equi-join that can be split.
    """
    around = edges.select(F.col(high).alias("centre"), F.col(low).alias("near"))
    least = stage(around.groupBy("centre").agg(
        F.least("centre", F.min("near")).alias("least")), "star-least")
    return around.join(least, "centre")


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _summary(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) to (node, root): root is the smallest node that can be reached.

    Nodes without a link to another node do not appear. The rounds grow with the logarithm of
    the longest chain; each round is written to the shared folder.
    """
    edges = stage(links.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    before = None
    while (now := _summary(edges)) != before:
        before = now
        large = _star(_both(edges), "b", "a").where("near > centre").select(
            F.col("least").alias("a"), F.col("near").alias("b"))
        large = stage(large.where("a <> b").distinct(), "edges-large")
        small = _star(large, "a", "b")
        small = small.select(F.col("least").alias("a"), F.col("near").alias("b")).union(
            small.select(F.col("least").alias("a"), F.col("centre").alias("b")))
        edges = stage(small.where("a <> b").distinct(), "edges-small")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
