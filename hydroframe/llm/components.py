"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a partial minimum per node and a join back, so a hub's edges are split like any
skewed join, and the edge table, written after each round, never meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydroframe.llm.common import written


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(both).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _lowest(down)
    rest = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node with an edge; a component is named by its smallest node."""
    stars = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(),
                    "edges")
    state = None
    while True:
        print_of = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if print_of == state:
            break
        state = print_of
        stars = written(_small_star(_large_star(stars)), "stars")
    low = stars.select("u", "v")
    return low.unionByName(low.select(F.col("v").alias("u"), "v")).distinct().select(
        F.col("u").alias("node"), F.col("v").alias("component"))
