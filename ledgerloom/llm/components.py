"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from ledgerloom.llm.common import materialise


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """A set of links, written and read back, with its size and order-free digest, taken by the job that writes it."""
    seen = Observation()
    stored = materialise(
        edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")), "links")
    return stored, (seen.get["n"], seen.get["x"] or 0)


def connected_components(links: DataFrame) -> DataFrame:
    """Smallest reachable node of every linked node.

    ``links`` has two columns of one ordered type, nodes that are linked; direction, repeats and loops do not matter.
    Every round points neighbours at the smallest node around (large star, then small star) until nothing changes;
    the number of rounds grows with the logarithm of the longest chain. The links of a round are written to the shared
    folder, so a lost executor costs no more than that round. Only two numbers a round come to the driver.

    Returns ``node``, ``component`` for nodes other than their own component; all others are their own.
    """
    a, b = links.columns
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    edges, before = _stored(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges, after = _stored(small.unionByName(lowest.withColumnRenamed("low", "b")).distinct())
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
