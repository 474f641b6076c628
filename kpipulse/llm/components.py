"""Connected components of an edge table by alternating star operations.

Each round sends every neighbour of a node to the smallest node it knows;
edges become stars around the smallest node of each component in a number of
rounds logarithmic in the size of the component. Groups are pre-aggregated to
one minimum per node; nothing but a row count and a checksum per round
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``a, b``, longs): the
    label is the smallest node of its component."""
    star = stored(_ordered(edges.select("a", "b")), "cc-edges")
    before = _print(star)
    while True:
        star = stored(_small(stored(_large(star), "cc-large")), "cc-small")
        after = _print(star)
        if after == before:
            break
        before = after
    hubs = star.select(F.col("b").alias("node")).distinct()
    return star.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(hubs.select("node", F.col("node").alias("label")))


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, ``a > b``."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large(star: DataFrame) -> DataFrame:
    both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _ordered(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small(star: DataFrame) -> DataFrame:
    least = star.groupBy("a").agg(F.min("b").alias("m"))
    joined = star.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _ordered(joined.unionByName(least.select("a", F.col("m").alias("b"))))


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
    return row["n"], row["s"]
