"""Connected components of an undirected graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.session import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """`node`, `root` for every node of the edges `a`, `b` (long); root is the smallest node.

    Rounds of large and small stars: every node ties its larger neighbours to the smallest
    one it knows, then its smaller ones, until nothing moves. A round is two combinable
    minima and two joins; it is written to the shared folder, so a lost executor costs one
    round at most. The driver sees one checksum a round. Null ends are no edges; an empty
    table gives an empty result.
    """
    now = materialise(_pairs(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))), "stars")
    mark = _checksum(now)
    while True:
        now = materialise(_small_star(_large_star(now)), "stars")
        last, mark = mark, _checksum(now)
        if mark == last:
            break
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _pairs(edges: DataFrame) -> DataFrame:
    """Each edge once, the larger end first."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _checksum(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), total).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root"))
    larger = edges.select(F.col("b").alias("a"), F.col("a").alias("v"))
    return _pairs(larger.join(least, "a").select(F.col("v").alias("a"), F.col("root").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("root"))
    smaller = edges.join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return _pairs(smaller.unionByName(least.select("a", F.col("root").alias("b"))))
