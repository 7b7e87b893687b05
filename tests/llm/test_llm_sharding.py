"""Sharding: a permutation of all rows, counts one apart, the same on every run."""

import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from mlframe.llm.queries import op4_sharding
from mlframe.llm.sharding import plan_buckets, shard_records, shuffled


def places(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    return {s: sorted(x) for s, x in by.items()}


def test_query(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op4_sharding(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    by = places(rows)
    assert all(slots == list(range(len(slots))) for slots in by.values())
    assert sorted(by) == list(range(16)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    for r in rows:
        raw = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)


def test_same_seed_same_order_and_another_order_for_another_seed(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    order = lambda df, seed: {r["doc_id"]: (r["shard"], r["slot"]) for r in shard_records(df, 4, seed, bucket_bytes=2000).collect()}
    one = order(docs, 1)
    assert one == order(docs.repartition(7), 1)
    other = order(docs, 2)
    assert sum(one[k] == other[k] for k in one) < 100
    # near or far in the input, rows land anywhere
    position = [one[i][0] * 750 + one[i][1] for i in range(3000)]
    near = sum(abs(a - b) < 300 for a, b in zip(position, position[1:])) / 2999
    assert 0.12 < near < 0.27


def test_buckets_are_bounded_and_shuffled_whole(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("x" * 100).alias("text"))
    starts = plan_buckets(docs, "doc_id", "text", 3, 1000, 1)
    assert len(starts) == 51 and starts[-1] == 500
    assert shuffled(docs, starts, 3, seed=3).select("doc_id").distinct().count() == 500


def test_nulls_repeats_clashing_columns_and_empty_tables(spark):
    rows = [(None, None), (None, "a"), (1, "a"), (1, "a"), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("slot", F.lit("mine")).withColumn("extra", F.array(F.lit(1)))
    out = shard_records(docs, 2).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=str) == sorted(rows, key=str)
    assert {s: len(x) for s, x in places(out).items()} in ({0: 2, 1: 3}, {0: 3, 1: 2})
    assert all(r["extra"] == [1] for r in out)
    assert shard_records(docs.limit(0), 2).count() == 0
