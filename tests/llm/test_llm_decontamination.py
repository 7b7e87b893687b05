"""Decontamination against a brute-force scan of all windows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from mlframe.llm.decontamination import contamination, is_contaminated
from mlframe.llm.queries import op9_decontamination


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, n=13):
    windows = {}
    for item, text in items:
        w = words(text)
        if item is not None:
            for i in range(max(len(w) - n, 0) + 1 if w else 0):
                windows.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for i in range(len(w)):
            for m in range(1, n + 1):
                got = windows.get(tuple(w[i:i + m])) if i + m <= len(w) else None
                if got:
                    hit.update(range(i, i + m))
                    found |= got
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in df.collect()), key=str)


def case(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "a", "né", "x1", *(f"w{i}" for i in range(30))]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 12, 13, 14, 40])))) for i in range(25)]
    items += [(100, items[0][1]), (101, None), (102, "?!"), (None, "the of a"), (3, items[5][1]), (103, "a a a a a a a a a a a a a a a")]
    docs = []
    for d in range(80):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 3)):
            text = rng.choice(items)[1] or ""
            a = rng.randint(0, max(0, len(text) - 60))
            parts += [text[a:a + rng.randint(20, 200)].upper(), " ".join(rng.choices(vocabulary, k=rng.randint(0, 9)))]
        docs.append((d, ", ".join(parts)))
    return docs + [(1000, None), (1001, ""), (1002, "a " * 3000), (5, "the of a"), (None, items[2][1])], items


@pytest.mark.parametrize("seed,block", [(1, 200_000), (2, 40)])
def test_equals_brute_force(spark, seed, block):
    docs, items = case(seed)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    i = spark.createDataFrame(items, "item_id long, text string")
    assert got(contamination(d, i, block_windows=block)) == brute(docs, items)


def test_query_against_brute_force(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    out = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
                  for r in op9_decontamination(spark, sf_dir).collect()), key=str)
    want = [(d, n, h, len(f), hashlib.sha256(",".join(f).encode()).hexdigest(), h > 0 and 20 * h >= n) for d, n, h, f in brute(docs, items)]
    assert out == sorted(want, key=str)
    assert any(w[-1] for w in want)


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "some words here")], "doc_id long, text string").withColumn("n_hit", F.lit("x")).withColumn("spans", F.lit(1))
    items = spark.createDataFrame([(1, "words here")], "item_id long, text string")
    assert contamination(docs.limit(0), items).count() == 0
    assert got(contamination(docs, items.limit(0))) == [(1, 3, 0, [])]
    row = contamination(docs, items, keep_text=True).withColumn("c", is_contaminated()).first()
    assert (row["text"], row["n_hit"], [tuple(s) for s in row["spans"]], row["c"]) == ("some words here", 2, [(1, 3)], True)
