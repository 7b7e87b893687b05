"""Hierarchy roll-up (M29): push readings from children to every ancestor.

Vertices are peeled layer by layer: a vertex is complete once all its children are, then its total goes up its edges and
the vertex leaves the table of open ones. Rounds follow the longest path, whatever the number of vertices, and each round
joins the edges with complete vertices only. Each round is a written table in the cluster's shared folder: a lost executor
recomputes one round at most, and the plan stays one join and one grouped sum long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mlframe.session import scratch_dir


def rollup(vertices: DataFrame, edges: DataFrame, id_col: str = "id", reading: str = "reading") -> DataFrame:
    """Totals per vertex: own reading (null = 0) plus the readings of every
    descendant, once per path, however long the paths are; negative readings are carried, too.

    Repeated vertices add up, a repeated edge is a path of its own, edges without a source are ignored. An end of an edge
    that is no vertex passes readings on and has a row of its own if its total is not 0. When no open vertex is
    complete, the edges hold a cycle: a ``ValueError`` is raised after as many rounds as the longest path that leads
    to it has vertices."""
    spark = vertices.sparkSession
    root = scratch_dir(spark, "rollup")
    e = edges.where(F.col("src").isNotNull()).select("src", "dst")
    zero = F.lit(0.0).alias("total")
    parts = (vertices.select(F.col(id_col).alias("id"), F.coalesce(F.col(reading).cast("double"), F.lit(0.0)).alias("total"),
                             F.lit(0).cast("long").alias("waits"), F.lit(True).alias("known"))
             .unionByName(e.select(F.col("src").alias("id"), zero, F.lit(0).cast("long").alias("waits"), F.lit(False).alias("known")))
             .unionByName(e.select(F.col("dst").alias("id"), zero, F.lit(1).cast("long").alias("waits"), F.lit(False).alias("known"))))
    done = F.col("waits") == 0
    number = 0
    while True:
        # `waits`: edges into the vertex that have not delivered yet
        (parts.groupBy("id").agg(F.sum("total").alias("total"), F.sum("waits").alias("waits"), F.max("known").alias("known"))
         .write.parquet(f"{root}/round={number}"))
        state = spark.read.parquet(f"{root}/round={number}")
        complete, n_open = state.agg(F.count_if(done), F.count_if(~done)).first()
        if not n_open:
            break
        if not complete:
            raise ValueError("the edges of the hierarchy hold a cycle")
        sent = (state.where(done).select(F.col("id").alias("src"), "total").join(e, "src")
                .select(F.col("dst").alias("id"), "total", F.lit(-1).cast("long").alias("waits"), F.lit(False).alias("known")))
        parts = state.where(~done).unionByName(sent)
        number += 1
    return spark.read.schema(state.schema).parquet(*[f"{root}/round={i}" for i in range(number + 1)]).where(
        done & (F.col("known") | (F.col("total") != 0))).select("id", "total")
