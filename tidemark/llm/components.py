"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import discard, materialize


def _stars(edges: DataFrame) -> bool:
    """Whether every component is a star around its smallest node: no upper end has a second edge."""
    ends = F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up"))))
    nodes = edges.select(ends.alias("x")).groupBy("x.node").agg(F.sum("x.up").alias("ups"), F.count("*").alias("n"))
    return nodes.where("ups > 0 AND n > 1").agg(F.count("*")).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the smallest node reachable.

    Each round writes its edges to the shared folder, so lineage stays short and lost executors
    cost one round. Minima are partial sums; only the edges themselves are shuffled. No round is
    run once all components are stars. Links to NULL or to the node itself add nothing. Empty in, empty out.
    """
    links = links.where(F.col("a") != F.col("b"))
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars")
    while not _stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where((F.col("v") > F.col("u")) & (F.col("v") != F.col("m")))
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u")
        small = small.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        before = edges
        edges = materialize(small.union(lowest.select("u", F.col("m").alias("v"))).distinct(), "stars")
        discard(before)
    return edges.select(
        F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("label")), F.struct(F.col("v").alias("node"), F.col("v").alias("label")))).alias("x")
    ).select("x.*").distinct()
