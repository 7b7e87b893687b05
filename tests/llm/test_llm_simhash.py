"""SimHash components against brute force; the hash kernels against the xxhash library."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from mlframe.llm._text import xxh64
from mlframe.llm.components import connected_components
from mlframe.llm.queries import op8_simhash
from mlframe.llm.simhash import ball_links, bit_majority, fingerprints_of, simhash_components


def print_of(text, shingle=3):
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    parts = [b" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def classes(prints, radius=2):
    """Smallest id reachable over links of at most ``radius`` bits, per id."""
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in ids}


def test_xxh64_of_all_lengths():
    data = np.random.default_rng(1).integers(0, 256, 4000, np.uint8)
    start, size = np.arange(200), np.arange(200)
    got = xxh64(data, start, size, 42)
    assert got.tolist() == [xxhash.xxh64_intdigest(data[a:a + n].tobytes(), 42) for a, n in zip(start, size)]


def test_fingerprints_of_odd_texts():
    texts = [None, "", " \t\n", "One", "one TWO", "a\x0bb  c\r\nd", "É é É", "x" * 5000 + " y z w", " ".join(map(str, range(70_000)))]
    got = fingerprints_of(pa.array(texts), 3)
    assert [int(x) for x in got] == [print_of(t) for t in texts]


def test_majority_counts_more_than_16_bits():
    h = np.concatenate([np.full(70_000, 5, np.uint64), np.full(69_999, 2, np.uint64)])
    assert bit_majority(h, np.array([0, 0, len(h)])).tolist() == [0, 5]


def test_query_equals_brute_force(spark, sf_dir):
    docs = {r["doc_id"]: print_of(r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = classes(docs)
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in op8_simhash(spark, sf_dir).collect()}
    assert got == {i: (docs[i], want[i]) for i in docs}


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_links_keep_every_connection(spark, radius):
    rng = random.Random(radius)
    prints = [rng.getrandbits(64) for _ in range(20)]
    for p in list(prints):
        q = p
        for _ in range(12):
            q ^= sum(1 << rng.randrange(64) for _ in range(rng.choice([1, 2, 3])))
            q &= (1 << 64) - 1
            prints.append(q)
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(set(prints))]
    rows = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    links = ball_links(rows, radius)
    assert all(bin((r["a"] ^ r["b"]) & ((1 << 64) - 1)).count("1") <= radius for r in links.collect())
    found = {r["node"]: r["component"] for r in connected_components(links).collect()}
    want = classes({p: p & ((1 << 64) - 1) for p in signed}, radius)
    assert {p: found.get(p, p) for p in signed} == want


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        ball_links(spark.createDataFrame([(1,)], "fingerprint long"), 3)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(5, "a b c d", "x"), (5, "a b c d", "y"), (2, None, "z"), (9, "", None), (None, "a b c d", "n"), (None, "only one here", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").withColumn("component_id", F.lit(7))
    got = sorted((r["doc_id"] if r["doc_id"] is not None else 99, r["component_id"] if r["component_id"] is not None else 99)
                 for r in simhash_components(docs).collect())
    assert got == [(2, 2), (5, 5), (5, 5), (9, 2), (99, 5), (99, 99)]
    assert simhash_components(docs.limit(0)).count() == 0


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(3, 3), (None, 4), (101, 100)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}
