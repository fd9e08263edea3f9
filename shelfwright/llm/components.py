"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwright.session import durable

GATHERED_ROWS = 250_000  # rows of a narrow table that one task takes


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in as many partitions as its rows ask for, if that is fewer: small tables make no tiny files."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // GATHERED_ROWS)))


def settled(df: DataFrame) -> DataFrame:
    """A durable copy in as many partitions as its rows ask for."""
    df = durable(df)
    return gathered(df, df.count())


def _large(edges: DataFrame, rows: int) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest one around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("c")).agg(F.min("b").alias("m")).select("c", F.least("c", "m").alias("m"))
    moved = gathered(both.filter("b > a").join(least, F.col("a") == F.col("c")), rows)
    return gathered(moved.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), rows)


def _small(edges: DataFrame, rows: int) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy(F.col("a").alias("c")).agg(F.min("b").alias("m"))
    moved = gathered(edges.join(least, F.col("a") == F.col("c")), rows).select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("c").alias("a"), F.col("m").alias("b"))
    return gathered(moved.filter("a <> b").unionByName(gathered(own, rows)).distinct(), rows)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for each node of an edge: the smallest node that can be reached from it.

    ``edges`` has columns a and b. Each round is cut in the shared folder; the number of rounds grows with the
    logarithm of the longest path. Repeated edges, loops and NULL ends are allowed, the latter two without effect.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = settled(now), None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if mark == before or not mark["n"]:
            break
        before = mark
        now = durable(_small(_large(now, mark["n"]), mark["n"]))
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.unionByName(labels.select(F.col("label").alias("node"), "label")).distinct()
