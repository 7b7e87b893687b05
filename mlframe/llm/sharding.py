"""Two-pass external shuffle into shards.

Pass one scatters records uniformly into memory-sized buckets by a seeded
hash; pass two brings each bucket into one task, Fisher-Yates shuffles it
and writes it. The buckets in order, each in its shuffled order, are one
random permutation of the table; shard s holds the positions
[s * n // shards, (s + 1) * n // shards), so counts differ by one at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlframe.llm.tables import boxed, unboxed
from mlframe.session import scratch_dir


def _bucket(key: str, seed: int, buckets: int):
    return F.pmod(F.xxhash64(F.lit(seed), F.col(f"`{key}`")), F.lit(buckets)).cast("int")


def plan_buckets(docs: DataFrame, key: str, text_col: str, seed: int, bucket_bytes: int, least: int) -> np.ndarray:
    """Where each bucket's positions start, and the row count at the end (buckets + 1 values, 8 bytes each)."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text_col).cast("long")), F.lit(0))).first()[0]
    buckets = max(least, -(-total // bucket_bytes), 1)
    counts = docs.select(_bucket(key, seed, buckets).alias("b")).groupBy("b").count().collect()
    sizes = np.zeros(buckets + 1, np.int64)
    for b, n in counts:
        sizes[b + 1] = n
    return np.cumsum(sizes)


def shuffled(docs: DataFrame, starts: np.ndarray, shards: int, key: str = "doc_id", seed: int = 0) -> DataFrame:
    """``docs`` with shard int and slot long (gapless from 0 in each shard); rows of a task come bucket by bucket.

    Each bucket is put into a fixed order (by a second hash, then by every
    orderable column) before its own generator shuffles it, so a task that
    runs again gives the same rows the same places.
    """
    buckets, total = len(starts) - 1, int(starts[-1])
    cols = [c for c in docs.columns if c not in ("shard", "slot")]
    firsts = np.array([s * total // shards for s in range(shards + 1)], np.int64)

    def finish(held: list[pa.RecordBatch], bucket: int):
        rows = pa.Table.from_batches(held).combine_chunks()
        order = np.arange(rows.num_rows)
        np.random.Generator(np.random.PCG64([seed, bucket])).shuffle(order)  # Fisher-Yates
        place = starts[bucket] + np.arange(len(order))
        shard = np.searchsorted(firsts[1:], place, side="right")
        rows = rows.drop_columns(["_bucket"]).take(order)
        rows = rows.append_column("shard", pa.array(shard.astype(np.int32))).append_column("slot", pa.array(place - firsts[shard]))
        yield from rows.to_batches(max_chunksize=4096)

    def run(batches):
        held, now = [], None
        for batch in batches:
            own = batch.column("_bucket").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
            for a, b in zip(cuts, cuts[1:]):
                if b <= a:
                    continue
                if held and own[a] != now:
                    yield from finish(held, now)
                    held = []
                now = int(own[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield from finish(held, now)

    kinds = (T.MapType, T.VariantType)
    ties = [F.col(f"_own.`{c}`") for c in cols if not isinstance(docs.schema[c].dataType, kinds)]
    scattered = docs.select(boxed(cols), _bucket(key, seed, buckets).alias("_bucket"))
    schema = T.StructType([scattered.schema["_own"], T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    return (scattered.repartition(buckets, "_bucket")
            .sortWithinPartitions("_bucket", F.xxhash64(F.lit(seed + 1), F.col(f"_own.`{key}`")), *ties)
            .mapInArrow(run, schema).select(*unboxed(cols), "shard", "slot"))


def shard_records(docs: DataFrame, shards: int, seed: int = 0, key: str = "doc_id", text_col: str = "text",
                  bucket_bytes: int = 32 << 20, path: str | None = None) -> DataFrame:
    """Write all of ``docs``, shuffled, to ``path`` (a folder ``shard=<s>`` each) and return that table.

    All columns stay; ``shard`` and ``slot`` are added and replace columns of
    these names. ``key`` should be unique: rows with equal keys share a
    bucket. Null keys and texts are values like any other. There are as many
    buckets as ``bucket_bytes`` of text ask for, and at least
    spark.sql.shuffle.partitions; the same seed, table and bucket count give
    the same order. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    starts = plan_buckets(docs, key, text_col, seed, bucket_bytes, int(spark.conf.get("spark.sql.shuffle.partitions")))
    out = shuffled(docs, starts, shards, key, seed)
    path = path or f"{scratch_dir(spark, 'shards')}/t"
    out.write.partitionBy("shard").parquet(path)
    return spark.read.schema(out.schema).parquet(path)
