"""Connected components of an edge table by large-star / small-star rounds.

Every round moves each node's links to the smallest node it sees: only
grouped minima and equi-joins, never the neighbours of one node in one task.
A hot centre's join is split by adaptive execution, its minimum is
pre-aggregated. Lineage is cut with ``checkpoint()`` in the shared folder
each round, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mlframe.session import ensure_checkpoint_dir


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an undirected edge table; component is its smallest node.

    Loops, repeated and reversed edges are allowed; edges with a null end are
    ignored; an empty table gives an empty table. Runs until nothing moves.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).isNotNull() & F.col(b).isNotNull())
         .toDF("u", "v", "whole").filter("whole AND u > v").select("u", "v").distinct().checkpoint())
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u > v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        moved = large.join(low, F.col("u") == F.col("k"))
        e = (moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(moved.select("u", F.col("m").alias("v")))
             .filter("u > v").distinct().checkpoint())
        now = _state(e)
        if now == state:
            break
        state = now
    leaves = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)
