"""Connected components of an edge table, by alternating star contractions.

Every round replaces each vertex's links by links to its smallest neighbour
("large star" over all neighbours, "small star" over the smaller ones) until
the edges are stars around the smallest vertex of each component.  A round
is two partial aggregations and two sort-merge joins (AQE splits the join
partition of a hot centre); rounds are written to the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popstats.llm._spark import materialise


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(e: DataFrame) -> tuple:
    row = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(u, v) edges over ordered values -> (vertex, root): every vertex that is not its component's smallest."""
    e = materialise(_small_star(edges.select("u", "v")))
    before = _state(e)
    while True:
        e = materialise(_small_star(_large_star(e)))
        after = _state(e)
        if after == before:
            return e.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
        before = after
