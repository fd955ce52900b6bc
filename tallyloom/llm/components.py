"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import written


def _around(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest of them and itself."""
    near = _around(links)
    least = near.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("_a"), F.least("a", "m").alias("m"))
    return near.where("b > a").join(least, F.col("a") == F.col("_a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of these."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least.withColumnRenamed("a", "_a"), F.col("a") == F.col("_a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for all nodes of links (a, b); component: its smallest node.

    Each round is written to the shared folder.  Stars halve the depth of what hangs
    together, so a chain of n nodes needs about log n rounds; minima are aggregated
    before the shuffle, so a node with very many links is no hot group.
    """
    links = links.select("a", "b").where("a <> b")
    before = None
    while True:
        links = written(_small_star(_large_star(links)), "links")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
