"""Non-negative PU learning: risk behaviour, held-out quality, odd texts."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mlframe.llm import toxicity
from mlframe.llm.queries import op2_toxicity


def corpus(n=1500, seed=0):
    rng = random.Random(seed)
    plain = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(5, 60))
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["zorkwit", "QUAXOL", "vlimpen"]))
        rows.append((i, " ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    known = spark.createDataFrame([(i,) for i, _, t in rows if t and i % 2], "doc_id long")  # half of the toxic ones are confirmed
    return toxicity.fit(docs, known, 0.15)


def test_finds_unconfirmed_toxic_texts(spark, fitted):
    rows = corpus(seed=5)
    out = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), fitted).collect()}
    toxic, clean = [out[i] for i, _, t in rows if t], [out[i] for i, _, t in rows if not t]
    assert np.mean(np.array(toxic) >= 0.3) >= 0.95
    assert np.mean(np.array(clean) >= 0.3) <= 0.03


def test_risk_is_kept_from_going_negative():
    """With features that only single positives have, plain PU risk goes far below zero; the corrected one stays near it."""
    n_pos, n_unl = 50, 200
    rows, cols = np.arange(n_pos), np.arange(n_pos)  # every positive has a feature of its own, unlabelled texts have none
    positive = np.arange(n_pos + n_unl) < n_pos
    w, b = toxicity.nnpu(rows, cols, positive, 0.2, n_pos, strength=0.0)
    f = np.concatenate([w, np.zeros(n_unl)]) + b
    loss = np.logaddexp(0, f)
    assert loss[~positive].mean() - 0.2 * loss[positive].mean() > -0.1
    assert w.max() < 10


def test_odd_texts_and_columns(spark, fitted):
    rows = [(1, None), (2, ""), (3, "12 !"), (4, "zorkwit " * 20_000), (None, "abc"), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("mine"))
    out = toxicity.score(docs, fitted).collect()
    assert len(out) == 6 and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (1, 2, 3)}) == 1
    assert toxicity.score(docs.limit(0), fitted).count() == 0


def test_without_positives_the_prior_is_the_score(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    model = toxicity.fit(docs, docs.select("doc_id").limit(0), 0.25)
    assert toxicity.score(docs, model).first()["score"] == pytest.approx(0.25)
    empty = toxicity.fit(docs.limit(0), docs.select("doc_id").limit(0), 0.0)
    assert toxicity.score(docs, empty).first()["score"] < 0.01


def test_features_are_different_ngrams_once():
    row, bucket = toxicity.text_features(pa.array(["abcd abcd", None, "12", "ABCD"]), 5)
    assert set(row) == {0, 3}
    assert set(bucket[row == 3]) <= set(bucket[row == 0])
    assert len(set(bucket[row == 0])) == (row == 0).sum()


def test_query(spark, sf_dir):
    out = op2_toxicity(spark, sf_dir).collect()
    assert len(out) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in out)
