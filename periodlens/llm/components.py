"""Connected components of a graph given as links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodlens.session import pin


def connected_components(links: DataFrame, left: str, right: str, max_rounds: int = 60) -> DataFrame:
    """``node`` and ``component``, the smallest node it is linked with, for every node that has a link.

    A round lets each node hang its larger neighbours on the smallest
    neighbour, then its smaller ones; the number of rounds grows with the
    logarithm of the longest chain. Each round is written to the shared folder,
    so its lineage is short. Neighbours are reduced to a minimum map-side; none
    is ever listed, so a node may have any number of them. Links with a null
    end or from a node to itself are left out.
    """
    ends = F.struct(F.greatest(left, right).alias("high"), F.least(left, right).alias("low"))
    edges = pin(
        links.where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right)))
        .select(ends.alias("e"))
        .select("e.high", "e.low")
        .distinct(),
        "links",
    )
    print_before = None
    for _ in range(max_rounds):
        lowest = edges.groupBy("low").agg(F.min("high").alias("_any")).select(F.col("low").alias("node"), F.col("low").alias("best"))
        lowest = (
            edges.select(F.col("high").alias("node"), F.col("low").alias("best"))
            .unionByName(lowest)
            .groupBy("node")
            .agg(F.min("best").alias("best"))
        )
        # The neighbours above a node move to the smallest node known to it.
        large = edges.join(lowest, F.col("low") == F.col("node")).select("high", F.col("best").alias("low")).distinct()
        smallest = large.groupBy("high").agg(F.min("low").alias("best"))
        # All neighbours below a node, and the node, move to the smallest of them.
        small = (
            large.join(smallest.withColumnRenamed("high", "node"), F.col("high") == F.col("node"))
            .where(F.col("low") > F.col("best"))
            .select(F.col("low").alias("high"), F.col("best").alias("low"))
            .unionByName(smallest.select("high", F.col("best").alias("low")))
            .distinct()
        )
        edges = pin(small, "links")
        print_now = edges.agg(
            F.count("*"), F.bit_xor(F.xxhash64("high", "low")), F.count_if(F.col("high") <= F.col("low"))
        ).first()
        if print_now == print_before:
            break
        print_before = print_now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
    roots = edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return nodes.unionByName(roots)
