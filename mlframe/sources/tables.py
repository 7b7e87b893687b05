"""Batch table sources and sinks."""

from __future__ import annotations

import os
import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mlframe.session import scratch_dir

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(d: str, name: str) -> str:
    return os.path.join(d, f"{name}.parquet")


def read(spark: SparkSession, d: str, name: str, cols=None) -> DataFrame:
    """Read one named parquet table; ``cols`` prunes the scan's ReadSchema."""
    df = spark.read.parquet(table_path(d, name))
    return df.select(*cols) if cols else df


def read_csv(spark: SparkSession, path: str, schema=None, key: str | None = None) -> DataFrame:
    """Headered CSV, one file or a glob. A fixed schema avoids the extra
    inference pass over the data; ``inferSchema`` is used only without one."""
    r = spark.read.option("header", "true")
    r = r.schema(schema) if schema is not None else r.option("inferSchema", "true")
    df = r.csv(path)
    return df.where(F.col(key).isNotNull()) if key else df


def write_split(df: DataFrame, path: str, files: int = 4, mode: str = "overwrite") -> str:
    """S3: write with a bounded file count for an outside consumer.

    ``repartition(files)`` rather than ``coalesce`` so the upstream stage keeps
    its parallelism and only the final write is narrowed.
    """
    df.repartition(files).write.mode(mode).parquet(path)
    return path


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Per-row source path from the file-source metadata column."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def write_table(df: DataFrame, path: str, mode: str = "overwrite", merge_schema: bool = False,
                partition_by=None, fmt: str = "parquet") -> str:
    """Replace / append / append-with-schema-merge to a path table."""
    w = df.write.mode(mode).format(fmt)
    if merge_schema:
        w = w.option("mergeSchema", "true")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)
    return path


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    r = spark.read
    if merge_schema:
        r = r.option("mergeSchema", "true")
    return r.parquet(path)


def write_partitioned(df: DataFrame, path: str, ts_col: str, date_col: str = "event_date") -> str:
    """Derive a date and write one folder per date; dynamic overwrite
    (a writer option, the session stays as it is) only replaces the dates
    present in ``df``."""
    out = df.withColumn(date_col, F.to_date(ts_col))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(path)
    return path


def upsert(target: DataFrame, updates: DataFrame, keys, check_unique: bool = True) -> DataFrame:
    """Matched rows replaced, new rows inserted, the rest kept. Null keys
    match null keys, so a replay changes nothing.

    Expressed as anti-join + union so it runs on any file table (built-in
    parquet tables have no MERGE). Updates must be unique per key, or a
    ``ValueError`` is raised; the caller writes the result to a new path and
    swaps (single writer).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if check_unique and not updates.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"updates are not unique on {keys}")
    u = updates.select(*[F.col(k).alias(f"_u{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & target[k].eqNullSafe(u[f"_u{i}"])
    return target.join(u, same, "left_anti").unionByName(updates.select(*target.columns))


def write_keyed(df: DataFrame, path: str, keys, parts: int = 64) -> str:
    """A table laid out for ``upsert_keyed``: one folder per hash part of the key. Choose ``parts`` so that
    a part is a few hundred MB; the table keeps its number (it is in the folders' names)."""
    name = f"_of{parts}"
    _in_parts(df, keys, name).repartition(name).write.mode("overwrite").partitionBy(name).parquet(path)
    return path


def _in_parts(df: DataFrame, keys, name: str) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.withColumn(name, F.pmod(F.xxhash64(*keys), F.lit(int(name[3:]))).cast("int"))


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.drop(_part_column(df))


def _part_column(df: DataFrame) -> str:
    return next(c for c in reversed(df.columns) if re.fullmatch(r"_of\d+", c))


def upsert_keyed(spark: SparkSession, path: str, updates: DataFrame, keys) -> list[int]:
    """S11 on a table of ``write_keyed``, in place: only the parts that the updates' keys fall into are read and
    rewritten; all other files stay as they are. Returns the parts that were written (single writer).

    The new parts are written to ``_pending`` first, a folder that readers of the table skip, and moved in by a dynamic
    partition overwrite only when they are whole. A call that finds whole pending parts of a writer that was lost
    moves them in before its own; repeating a lost call changes nothing more."""
    pending = f"{path}/_pending"

    def move_in():
        name = _part_column(spark.read.parquet(pending))
        (spark.read.parquet(pending).repartition(name).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(name).parquet(path))
        _remove(spark, pending)

    if exists(spark, f"{pending}/_SUCCESS"):
        move_in()
    current = spark.read.parquet(path)
    name = _part_column(current)
    updates = _in_parts(updates.select(*[c for c in current.columns if c != name]), keys, name)
    touched = sorted(r[0] for r in updates.select(name).distinct().collect())  # at most the number of parts
    if not touched:
        return touched
    merged = upsert(current.where(F.col(name).isin(touched)), updates, keys)
    merged.repartition(name).write.mode("overwrite").partitionBy(name).parquet(pending)
    move_in()
    return touched


def create_as(spark: SparkSession, name: str, sql: str, path: str | None = None) -> DataFrame:
    """Create-or-replace a table from a SELECT (CTAS).

    The rows are written to a new folder first; only then does the name move
    to it, so a failing query leaves the old table as it is, and readers that
    opened the old one keep its files. With equal columns the name moves in one
    statement; other columns need a drop and a create, between which the name is gone."""
    root = path or f"{scratch_dir(spark, name)}/t"
    target = f"{root}/v={time.time_ns()}"
    df = spark.sql(sql)
    df.write.parquet(target)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    if spark.catalog.tableExists(name) and [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in df.schema]:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{target}'")
        return spark.table(name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{target}'")
    return spark.table(name)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path`` in any file system that Spark reads; none if it does not exist."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(hadoop) if st.isDirectory())


def _remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def file_rows(df: DataFrame) -> DataFrame:
    """Every data file behind ``df`` with its size, ISO modification time and the rows read from it."""
    meta = F.col("_metadata")
    return (df.select(meta["file_path"].alias("path"), meta["file_size"].alias("length"), meta["file_modification_time"].alias("m"))
            .groupBy("path", "length").agg(F.count(F.lit(1)).alias("n_rows"), F.max("m").alias("m"))
            .select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "length",
                    F.date_format("m", "yyyy-MM-dd'T'HH:mm:ss").alias("modified_iso"), "n_rows"))


def landed_files(spark: SparkSession, d: str, glob: str = "*") -> DataFrame:
    """List landed files with size and ISO modification time.

    The binaryFile source is pruned to metadata columns, so no file content
    is read.
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", "true").load(d))
    return df.select(
        F.col("path"), F.col("length"),
        F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss").alias("modified_iso"))
