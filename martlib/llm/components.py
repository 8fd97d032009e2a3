"""Connected components of a link table, by alternating large-star and small-star steps.

Every step aggregates a minimum per node before it joins, so a node with many
links is a partial aggregate and one skewed inner join, which adaptive
execution splits. Nothing is collected: the driver sees one row of counts a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlib.session import cut_lineage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node that has a link to another; the component is its smallest node.

    Null ends, self links and repeated links are ignored; without links the
    result is empty.
    """
    edges = links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"), (F.col(a).isNotNull() & F.col(b).isNotNull()).alias("ok"))
    edges = cut_lineage(edges.where("ok and hi <> lo").select("hi", "lo").distinct())
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).unionByName(least.select("hi", F.col("m").alias("lo")))
        edges = cut_lineage(small.distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
