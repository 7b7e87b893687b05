"""Written tables in the shared folder that cut a job's lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlframe.session import scratch_dir
from mlframe.sources.tables import _remove as delete

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under ``spark.checkpoint.dir`` and read it back.

    Several consumers then share one computation, and a lost executor costs
    no more than the tasks that read its files again. Nobody reads the write's
    shuffles again, so they go with its end.
    """
    conf = df.sparkSession.conf
    path, before = f"{scratch_dir(df.sparkSession, name)}/t", conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Delete the files of materialized tables that nothing reads any more."""
    for t in tables:
        for path in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            delete(t.sparkSession, path)


def boxed(columns: list[str]) -> Column:
    """The caller's columns as one struct ``_own``, so that none of their names meets one of ours; ``_own.*`` gives them back."""
    return F.struct(*([F.col(f"`{c}`") for c in columns] or [F.lit(True).alias("_none")])).alias("_own")


def unboxed(columns: list[str]) -> list[str]:
    return ["_own.*"] if columns else []


def in_corpus_order(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """``docs`` with a unique long _doc in corpus order: the id itself (True), or a number written with the table (False)."""
    if isinstance(docs.schema[id_col].dataType, (T.LongType, T.IntegerType)):
        repeated = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col(id_col).isNull())
        if repeated.isEmpty():
            return docs.withColumn("_doc", F.col(f"`{id_col}`").cast("long")), True
    order = [F.col(f"`{id_col}`").asc_nulls_last(), F.col(f"`{text_col}`").asc_nulls_last()]
    ordered = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ordered.withColumn("_doc", F.monotonically_increasing_id()), "numbered"), False
