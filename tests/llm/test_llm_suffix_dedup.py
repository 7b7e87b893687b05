"""Suffix-array dedup against a brute-force dictionary of all 100-byte strings."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from mlframe.llm.queries import op7_suffix_dedup
from mlframe.llm.suffix_dedup import remove_repeats


def brute(texts, length):
    """Per text (in corpus order): kept bytes, bytes removed, number of removed runs."""
    seen, out = set(), []
    for text in texts:
        raw = (text or "").encode()
        hit = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            s = raw[p:p + length]
            if s in seen:
                hit[p:p + length] = b"\1" * length
            seen.add(s)
        runs = sum(1 for i, h in enumerate(hit) if h and not (i and hit[i - 1]))
        out.append((bytes(b for b, h in zip(raw, hit) if not h), sum(hit), runs))
    return out


def corpus(seed, n=60, words=40):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 9))) for _ in range(words)]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randint(5, 60))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(vocabulary, k=rng.randint(1, 40)))
                 for _ in range(rng.randint(1, 5))]
        text = " ".join(parts)
        if rng.random() < 0.3 and len(text) > 10:  # an edit
            i = rng.randrange(len(text))
            text = text[:i] + rng.choice("xyz") + text[i + 1:]
        texts.append(text)
    return texts + [None, "", "a" * 99, "a" * 100, "a" * 500, "ab" * 300, "ab" * 300, texts[0], texts[0]]


@pytest.mark.parametrize("seed,length,hot", [(1, 100, 10**9), (2, 40, 10**9), (3, 40, 1), (4, 100, 1)])
def test_equals_brute_force(spark, seed, length, hot):
    texts = corpus(seed)
    docs = spark.createDataFrame([(3 * i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in remove_repeats(docs, length, hot_contexts=hot, hot_in_task=2).collect()}
    assert len(got) == len(texts)
    for i, (text, (kept, removed, runs)) in enumerate(zip(texts, brute(texts, length))):
        r = got[3 * i]
        assert (bytes(r["kept"] or b""), r["n_removed"], r["n_spans"]) == (kept, removed, runs), i
        assert r["n_bytes"] == len((text or "").encode())
        assert sum(s["b"] - s["a"] for s in r["spans"]) == removed


def test_repeated_and_null_ids_come_in_text_order(spark):
    long = "".join(random.Random(9).choices("abcdefgh", k=150))
    rows = [(None, long), (5, long), (5, long), (5, None), (1, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("mine")).withColumn("tag", F.lit(1))
    got = sorted(((r["doc_id"] or 99, r["n_removed"], r["tag"]) for r in remove_repeats(docs).collect()))
    assert got == [(1, 0, 1), (5, 0, 1), (5, 0, 1), (5, 150, 1), (99, 150, 1)]


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    want = {d["doc_id"]: (removed, runs, hashlib.sha256(kept).hexdigest())
            for d, (kept, removed, runs) in zip(docs, brute([d["text"] for d in docs], 100))}
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in op7_suffix_dedup(spark, sf_dir).collect()}
    assert got == want
