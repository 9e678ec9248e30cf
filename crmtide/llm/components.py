"""Connected components of links by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmtide.llm.common import remove, saved


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (a, b); component is the smallest node reachable.

    Every round points the neighbours of a node at the smallest of them, once
    among its larger and once among its smaller ones. The rounds needed grow
    with the logarithm of the number of nodes, a node with many neighbours is
    combined before the shuffle, and no list of neighbours is ever built. Each
    round is written to the shared folder, which cuts lineage. NULL nodes have
    no links.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = saved(links.filter("a <> b").distinct(), "links")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = saved(large.distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                    F.struct(F.col("a"), F.col("m").alias("b")),
                )
            ).alias("e")
        )
        after = saved(small.select("e.*").filter("a <> b").distinct(), "links")
        remove(large)
        remove(now)
        now, last, state = after, state, _state(after)
        if state == last:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
