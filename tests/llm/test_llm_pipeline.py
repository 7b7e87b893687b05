"""The pipeline's stages against brute force on their own inputs, and all of them together."""

import re

import pytest
from pyspark.sql import functions as F
from test_llm_decontamination import brute as windows
from test_llm_packing import check as packed
from test_llm_simhash import classes, print_of
from test_llm_suffix_dedup import brute as repeats

import corpus_pipeline as P

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_near_dedup_keeps_the_first_of_each_component(spark, docs, sf_dir):
    want = classes({r["doc_id"]: print_of(r["text"]) for r in docs.collect()})
    got = P.near_dedup(spark, docs, sf_dir)
    assert got.columns == list(P.COLUMNS)
    assert set(rows_of(got)) == {i for i, c in want.items() if i == c}


def test_suffix_dedup_cuts_texts(spark, docs, sf_dir):
    before = rows_of(docs)
    order = sorted(before)
    got = rows_of(P.suffix_dedup(spark, docs, sf_dir))
    for i, (kept, removed, _) in zip(order, repeats([before[i]["text"] for i in order], 100)):
        text = kept.decode("utf-8", "ignore")
        if removed and not re.search(r"[^\x20\x09-\x0D]", text):
            assert i not in got
        else:
            assert got[i]["text"] == text
            assert got[i]["n_chars"] == (len(text) if removed else before[i]["n_chars"])


def test_decontamination_drops_only_contaminated(spark, docs, sf_dir):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    bad = {d for d, n, h, _ in windows([(r["doc_id"], r["text"]) for r in docs.collect()], items) if h and 20 * h >= n}
    got = rows_of(P.decontamination(spark, docs, sf_dir))
    assert bad and set(got) == set(rows_of(docs)) - bad


def test_language_id_rejects_texts_without_letters(spark, docs, sf_dir):
    odd = spark.createDataFrame([(9001, None, None, "s", 0), (9002, "", "en", "s", 0), (9003, "12 !", "en", "s", 4), (None, "and the with", None, None, None)], SCHEMA)
    both = docs.select(*P.COLUMNS).unionByName(odd).withColumn("score", F.lit("mine"))
    got = P.language_id(spark, both, sf_dir).collect()
    before = rows_of(docs)
    assert {r["doc_id"] for r in got} == {*before, None}
    assert all(r["text"] == before[r["doc_id"]]["text"] and r["lang"] == before[r["doc_id"]]["lang"] for r in got if r["doc_id"] is not None)
    assert next(r["lang"] for r in got if r["doc_id"] is None) is not None


def test_nulls_repeats_and_empty_tables_in_every_stage(spark, sf_dir):
    long = "A sentence that is long enough to be found again, word for word, in every copy of it that follows later on, and some more."
    rows = [(1, long, "en", "s", len(long)), (1, long, "en", "s", len(long)), (None, long, None, None, None), (2, None, None, "s", None),
            (3, "", "en", None, 0), (4, "é" * 300, "fr", "s", 300)]
    odd = spark.createDataFrame(rows, SCHEMA).withColumn("_doc", F.lit(1)).withColumn("kept", F.lit("x"))
    counts = [f(spark, odd, sf_dir).count() for _, f in P.STAGES]
    # language: without null and empty; near: one per text; suffix: the first copy only; the rest keep all
    assert counts == [4, 3, 4, 6, 6]
    for _, f in P.STAGES:
        assert f(spark, odd.limit(0), sf_dir).count() == 0


def test_run_equals_brute_force(spark, docs, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if re.search(r"[^\W\d_]", r["text"] or "")}
    near = classes({i: print_of(t) for i, t in texts.items()})
    texts = {i: t for i, t in texts.items() if near[i] == i}
    order = sorted(texts)
    cut = {i: (k.decode("utf-8", "ignore"), n) for i, (k, n, _) in zip(order, repeats([texts[i] for i in order], 100))}
    texts = {i: t for i, (t, n) in cut.items() if not n or t.strip(" \t\n\x0b\x0c\r")}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    bad = {d for d, n, h, _ in windows(list(texts.items()), items) if h and 20 * h >= n}
    texts = {i: t for i, t in texts.items() if i not in bad}
    assert packed(P.run(spark, sf_dir).collect(), texts, 1024) > 0.95


def test_stages_are_named_and_in_order():
    assert [n for n, _ in P.STAGES] == ["language ID", "SimHash near-dedup", "suffix-array dedup", "benchmark decontamination", "packing"]
