"""Streaming sources (S4, S6, S7, S8, S16) and landing helpers.

Every stream timestamp is cast from ``timestamp_ntz`` to ``timestamp``
before a watermark (``withWatermark`` rejects NTZ columns).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlframe.sources.tables import folders

RESCUE_COL = "_rescued_data"
# text formats keep full microsecond precision (the default writes millis)
TS_OPTS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
           "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def rescue_json(value, schema: T.StructType, parsed) -> Column:
    """What the fixed schema cannot hold, as JSON: fields outside it, fields
    whose value does not fit their type, and a line that is no JSON object as
    a whole (under ``_corrupt_record``). Null if nothing is left over."""
    v, p = (F.col(c) if isinstance(c, str) else c for c in (value, parsed))
    raw = F.from_json(v, "map<string,string>")
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    misfits = F.array(*[F.when(p[f.name].isNull() & F.element_at(raw, F.lit(f.name)).isNotNull(), F.lit(f.name)) for f in schema.fields])
    misfits = F.filter(misfits, lambda x: x.isNotNull())
    extra = F.map_filter(raw, lambda k, x: ~F.array_contains(known, k) | F.array_contains(misfits, k))
    broken = raw.isNull() & (F.length(F.trim(v)) > 0)
    return (F.when(broken, F.to_json(F.struct(v.alias("_corrupt_record"))))
            .when(F.size(extra) > 0, F.to_json(extra)))


def bronze_json_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None,
                       rescue: bool = True) -> DataFrame:
    """Incremental newline-JSON ingest; only new files are read (file
    offsets live in the query checkpoint). What does not fit ``schema`` is
    kept in ``_rescued_data`` (:func:`rescue_json`), plus ingest time and
    source file."""
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    raw = r.load(path)
    parsed = raw.select(F.col("value").alias("_line"), F.from_json("value", schema, TS_OPTS).alias("_p"),
                        F.col("_metadata.file_path").alias("_source_file"), F.current_timestamp().alias("_ingested_at"))
    cols = [rescue_json("_line", schema, "_p").alias(RESCUE_COL)] if rescue else []
    return parsed.select("_p.*", *cols, "_source_file", "_ingested_at")


def table_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None,
                 fmt: str = "parquet") -> DataFrame:
    """Read a landing table folder as a stream with a fixed schema."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def csv_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Incremental ingest of headered CSV files."""
    r = spark.readStream.option("header", "true").options(**TS_OPTS).schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.csv(path)


def rate_stream(spark: SparkSession, rows_per_second: int = 10) -> DataFrame:
    """Generator stream renamed to (tx_id, tx_time)."""
    return (spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
            .select(F.col("value").alias("tx_id"), F.col("timestamp").alias("tx_time")))


# ---- message bus envelope (S8) ---------------------------------------------

def decode(df: DataFrame, schema: T.StructType) -> DataFrame:
    """bytes -> string -> struct -> columns, with the message's key and the
    broker's arrival time where the frame has them."""
    own = [F.col("key").cast("string").alias("key")] if "key" in df.columns else []
    own += [F.col("timestamp").alias("arrival_ts")] if "timestamp" in df.columns else []
    m = df.select(F.from_json(F.col("value").cast("string"), schema).alias("m"), *own)
    return m.select(*[c for c in ("key",) if c in m.columns], "m.*", *[c for c in ("arrival_ts",) if c in m.columns])


def encode(df: DataFrame, key: str, cols) -> DataFrame:
    """(key, JSON value) pair ready for a bus sink."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*cols)).alias("value"))


AUTH_KINDS = ("plain", "sasl_plain", "sasl_ssl", "scram_sha_256", "scram_sha_512", "mtls", "iam")


def bus_options(auth: str, servers: str, topic: str | None = None, **secrets) -> dict:
    """Connector options by authentication kind (:data:`AUTH_KINDS`).

    ``sasl_plain``, ``sasl_ssl`` and the SCRAM kinds take ``user`` and
    ``password``; ``mtls`` takes keystore and truststore locations and
    passwords; ``iam`` signs with the cloud identity of the process. Secrets
    are passed in by the caller, never stored here. An unknown kind or a
    missing secret is an error: nothing falls back to a weaker kind."""
    if auth not in AUTH_KINDS:
        raise ValueError(f"unknown authentication kind {auth!r}; known: {', '.join(AUTH_KINDS)}")

    def need(*names):
        missing = [n for n in names if not secrets.get(n)]
        if missing:
            raise ValueError(f"{auth} needs {', '.join(missing)}")
        return [secrets[n] for n in names]

    opts = {"kafka.bootstrap.servers": servers}
    if topic:
        opts["subscribe"] = topic
    if auth in ("sasl_plain", "sasl_ssl", "scram_sha_256", "scram_sha_512"):
        user, password = (v.replace("\\", "\\\\").replace('"', '\\"') for v in need("user", "password"))
        scram = auth.startswith("scram")
        module = "scram.ScramLoginModule" if scram else "plain.PlainLoginModule"
        opts["kafka.sasl.mechanism"] = auth.upper().replace("_", "-") if scram else "PLAIN"
        opts["kafka.sasl.jaas.config"] = (f"org.apache.kafka.common.security.{module} required "
                                          f'username="{user}" password="{password}";')
        opts["kafka.security.protocol"] = "SASL_PLAINTEXT" if auth == "sasl_plain" else "SASL_SSL"
    elif auth == "mtls":
        names = ("keystore_location", "keystore_password", "truststore_location", "truststore_password")
        for name, value in zip(names, need(*names)):
            opts["kafka.ssl." + name.replace("_", ".")] = value
        opts["kafka.security.protocol"] = "SSL"
    elif auth == "iam":
        opts.update({"kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "AWS_MSK_IAM",
                     "kafka.sasl.jaas.config": "software.amazon.msk.auth.iam.IAMLoginModule required;",
                     "kafka.sasl.client.callback.handler.class": "software.amazon.msk.auth.iam.IAMClientCallbackHandler"})
    return opts


def bus_stream(spark: SparkSession, options: dict) -> DataFrame:
    """Kafka source when the connector jar is on the classpath."""
    return spark.readStream.format("kafka").options(**options).load()


# ---- landing (writing given tables as files for a stream to pick up) --------

FILES = 4  # files of one landing step; a stream with maxFilesPerTrigger=FILES reads one step per trigger


def land(df: DataFrame, path: str, part_col: str, parts, fmt: str = "parquet", header: bool = True, files: int = FILES) -> int:
    """Append ``df`` to ``path`` as ``files`` files per value of ``part_col``,
    in the given order, so a file stream with ``maxFilesPerTrigger=files``
    sees them as successive arrivals (the file source orders new files by
    modification time and skips ``_``-prefixed marker files).

    The source is read once, into a folder per value beside ``path``; each
    step is then written by ``files`` tasks."""
    staged = f"{path}-staged-{os.urandom(4).hex()}"
    df.where(F.col(part_col).isin(*parts)).write.partitionBy(part_col).parquet(staged)
    have = set(folders(df.sparkSession, staged))
    schema = df.drop(part_col).schema
    for v in parts:
        if f"{part_col}={v}" not in have:
            continue
        w = df.sparkSession.read.schema(schema).parquet(f"{staged}/{part_col}={v}").repartition(files).write.mode("append").options(**TS_OPTS)
        if fmt == "csv":
            w.option("header", str(header).lower()).csv(path)
        elif fmt == "json":
            w.json(path)
        else:
            w.parquet(path)
    return len(parts)
