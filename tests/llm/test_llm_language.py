"""Language ID: held-out accuracy, mixtures, and defined results for odd texts."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mlframe.llm import language
from mlframe.llm.queries import op1_language


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op1_language(spark, sf).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.98 * len(held)


def brute_em(loglik, rounds):
    p, share = np.exp(loglik), np.full(loglik.shape[1], 1 / loglik.shape[1])
    for _ in range(rounds):
        r = p * share
        share = (r / r.sum(axis=1, keepdims=True)).mean(axis=0)
    return share, np.log((p * share).sum(axis=1))


def test_em_equals_one_text_at_a_time():
    rng = np.random.default_rng(0)
    texts = [rng.normal(0, 2, (n, 3)) for n in (1, 5, 40)]
    first = np.cumsum([0, 1, 5])
    share, each = language.expectation_maximisation(np.concatenate(texts), first, np.ones((3, 3), bool), 15)
    for k, t in enumerate(texts):
        want, own = brute_em(t, 15)
        assert np.allclose(share[k], want)
        assert np.allclose(each[first[k]:first[k] + len(t)], own)


def test_ngrams_are_those_of_the_lower_case_words():
    code, before = language.gram_codes(pa.array(["Ab, c!", None, "12", "ab c", "x"]), 3, 1 << 16)
    assert before.tolist() == [0, 4, 4, 4, 8, 9]
    assert code[:4].tolist() == code[4:8].tolist()


@pytest.fixture(scope="module")
def model(spark):
    de, en = "der die und das nicht ist ein schon wirklich werden", "the and with that this from have would there which"
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice((en if i % 2 else de).split(), 60)), "en" if i % 2 else "de") for i in range(60)]
    return language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_mixture_and_odd_texts(spark, model):
    en, de = "the and with that this from have would there which " * 30, "der die und das nicht ist ein schon wirklich werden " * 10
    rows = [(1, en), (2, de), (3, en + de), (4, None), (5, ""), (6, "123 ?!"), (7, "—…"), (8, "é"), (9, en * 300), (None, de), (1, en)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("lang_pred", F.lit(1))
    out = language.identify(docs, model).collect()
    got = [(r["doc_id"], r["lang_pred"]) for r in out]
    assert sorted(got, key=str) == sorted([(1, "en"), (2, "de"), (3, "en"), (4, "und"), (5, "und"), (6, "und"), (7, "und"),
                                           (8, next(p for d, p in got if d == 8)), (9, "en"), (None, "de"), (1, "en")], key=str)
    assert dict(got)[8] in ("de", "en")
    mixed = next(r["lang_shares"] for r in out if r["doc_id"] == 3)
    assert 0.6 < mixed["en"] < 0.9 and 0.1 < mixed["de"] < 0.4
    assert list(next(r["lang_shares"] for r in out if r["doc_id"] == 1)) == ["en"]
    assert all(r["score"] == 0 for r in out if r["lang_pred"] == "und")


def test_empty_tables(spark, model):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language.identify(docs, model).count() == 0
    empty = language.fit(docs)
    one = language.identify(spark.createDataFrame([(1, "text")], "doc_id long, text string"), empty).first()
    assert (one["lang_pred"], one["score"]) == ("und", 0.0)
