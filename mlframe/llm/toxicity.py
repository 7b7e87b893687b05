"""Toxicity by non-negative positive-unlabelled learning.

Positives are confirmed toxic texts; unlabelled text is drawn from all rows,
so it holds toxic texts in the share of the class prior. The risk of calling
unlabelled text toxic is corrected by that share of the positives' risk and
kept from going below zero (Kiryo et al. 2017), which is what stops a
flexible model from overfitting the few positives. Several numpy classifiers
are trained on different parts of a bounded sample, one task each, and their
probabilities are averaged.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mlframe.llm._text import SPACE, slices, squeezed
from mlframe.llm.language import NOT_LETTER
from mlframe.llm.tables import boxed, materialize, unboxed

_BITS = 22
BUCKETS = 1 << _BITS


@dataclass
class ToxicityModel:
    """Linear models over chosen n-gram buckets; ``feature`` maps a bucket to its number or -1. Bounded by BUCKETS."""

    feature: np.ndarray
    weights: np.ndarray  # [models, features]
    bias: np.ndarray
    gram: int


def text_features(column: pa.Array, gram: int, feature: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket or feature number) of every different letter n-gram of each text; n-grams run over word ends."""
    text, start, end, first = squeezed(column, NOT_LETTER)
    has = np.flatnonzero(first[1:] > first[:-1])
    if not len(has):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.concatenate([[SPACE], text, np.full(gram, SPACE)]).astype(np.uint32)
    code = np.zeros(len(text) - gram + 1, np.uint32)
    for k in range(gram):
        code = code * np.uint32(0x01000193) + text[k:k + len(code)] * np.uint32(0x9E3779B1)
    code ^= code >> np.uint32(15)
    code = (code * np.uint32(0x85EBCA6B)) >> np.uint32(32 - _BITS)
    a = start[first[:-1][has]]
    n = np.maximum(end[first[1:][has] - 1] - a + 3 - gram, 1)
    at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    owner, value = np.repeat(has, n), code[at].astype(np.int64)
    if feature is not None:
        value = feature[value].astype(np.int64)
        known = value >= 0
        owner, value = owner[known], value[known]
    both = np.unique(owner << 32 | value)
    return both >> 32, both & 0xFFFFFFFF


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def nnpu(rows: np.ndarray, cols: np.ndarray, positive: np.ndarray, prior: float, n_features: int, rounds: int = 300,
         rate: float = 0.05, strength: float = 0.2, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic classifier under the non-negative PU risk, by full-batch Adam.

    ``rows``/``cols`` list the features present in each text, ``positive``
    marks the positives. While the corrected unlabelled risk is below zero,
    steps go the other way. ``strength`` is a weight penalty worth that many
    positives. The logistic loss makes the sigmoid a probability.
    """
    n_texts = len(positive)
    n_pos, n_unl = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    theta = np.concatenate([np.random.default_rng(seed).normal(0, 0.01, n_features), [np.log(prior / (1 - prior))]])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        f = np.bincount(rows, weights=theta[cols], minlength=n_texts) + theta[-1]
        p, as_negative = _sigmoid(f), np.logaddexp(0.0, f)
        corrected = as_negative[~positive].sum() / n_unl - prior * as_negative[positive].sum() / n_pos
        # d loss(+1) / df = p - 1, d loss(-1) / df = p
        unlabelled = np.where(positive, -prior * p / n_pos, p / n_unl)
        g = np.where(positive, prior * (p - 1.0) / n_pos, 0.0) + unlabelled if corrected >= 0 else -unlabelled
        grad = np.concatenate([np.bincount(cols, weights=g[rows], minlength=n_features) + strength / n_pos * theta[:-1], [g.sum()]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta - rate * (1 - 0.9 * t / rounds) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return theta[:-1], float(theta[-1])


def choose_features(pos: np.ndarray, unl: np.ndarray, n_pos: int, n_unl: int, most: int, sure: float = 6.0, ratio: float = 2.0) -> np.ndarray:
    """Bucket -> feature number or -1: buckets whose share of texts is surely (in standard errors) and by ``ratio`` higher among positives."""
    p, u = pos / max(1, n_pos), unl / max(1, n_unl)
    both = (pos + unl) / max(1, n_pos + n_unl)
    spread = np.sqrt(both * (1 - both) * (1 / max(1, n_pos) + 1 / max(1, n_unl))) + 1e-9
    z = np.where((pos >= 5) & (p > ratio * u), (p - u) / spread, 0.0)
    top = np.argsort(-z, kind="stable")[:most]
    top = np.sort(top[z[top] > sure])
    feature = np.full(BUCKETS, -1, np.int32)
    feature[top] = np.arange(len(top))
    return feature


def fit(docs: DataFrame, toxic_ids: DataFrame, prior: float, max_positive: int = 10_000, max_unlabelled: int = 20_000,
        max_features: int = 8_192, models: int = 3, gram: int = 5, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Train on about ``max_positive`` of the confirmed ids and ``max_unlabelled`` of all rows (both chosen by hash).

    ``toxic_ids`` has the confirmed ids (column ``id_col``); ``prior`` is the
    share of toxic texts. Without a positive or an unlabelled text the model
    scores the prior for everything.
    """
    spark = docs.sparkSession
    unit = F.pmod(F.xxhash64(F.lit("toxicity"), id_col), F.lit(1_000_000))
    toxic = toxic_ids.select(id_col).filter(F.col(id_col).isNotNull()).distinct()
    n_toxic, n_all = toxic.count(), docs.count()
    chosen = toxic.filter(unit < 1_000_000 * min(1.0, max_positive / max(1, n_toxic))).withColumn("_positive", F.lit(True))
    rate = min(1.0, max_unlabelled / max(1, n_all))
    # at most about max_positive ids: their bound is what makes the broadcast safe
    marked = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col, "left")
    # unlabelled text is drawn from all rows, confirmed ones too: it must hold toxic texts in the share of the prior
    roles = F.filter(F.array(F.when(F.col("_positive"), F.lit(True)), F.when(unit < 1_000_000 * rate, F.lit(False))), lambda x: x.isNotNull())
    sample = materialize(marked.select(id_col, text_col, F.explode(roles).alias("_positive")), "toxicity")

    def counted(batches):
        total, texts = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for part in slices(batch, text_col):
                label = part.column("_positive").to_numpy(zero_copy_only=False).astype(np.int64)
                row, bucket = text_features(part.column(text_col), gram)
                total += np.bincount(label[row] * BUCKETS + bucket, minlength=2 * BUCKETS).reshape(2, -1)
                texts += np.bincount(label, minlength=2)
        flat = np.concatenate([total.ravel(), texts])
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], names=["cell", "n"])

    sums = sample.select("_positive", text_col).mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    flat = np.zeros(2 * BUCKETS + 2, np.int64)
    flat[sums.column("cell").to_numpy()] = sums.column("n").to_numpy()
    n_unl, n_pos = int(flat[-2]), int(flat[-1])
    feature = choose_features(flat[BUCKETS:2 * BUCKETS], flat[:BUCKETS], n_pos, n_unl, max_features)
    n_features = int(feature.max()) + 1
    if not n_pos or not n_unl or not n_features:
        flat_bias = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
        return ToxicityModel(np.full(BUCKETS, -1, np.int32), np.zeros((1, 1)), np.array([flat_bias]), gram)
    shared = spark.sparkContext.broadcast(feature)

    def listed(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                row, number = text_features(part.column(text_col), gram, shared.value)
                ends = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(number.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(id_col), part.column("_positive"), lists], names=["id", "positive", "features"])

    kind = docs.schema[id_col].dataType.simpleString()
    texts = sample.mapInArrow(listed, f"id {kind}, positive boolean, features array<int>")
    # model k leaves out every k-th part, so each sees a different bounded sample in a task of its own
    parts = texts.withColumn("model", F.explode(F.array(*[F.lit(k) for k in range(models)])))
    if models > 1:
        parts = parts.filter(F.pmod(F.xxhash64(F.lit("bag"), "id"), F.lit(2 * models)) != F.col("model"))

    def train(key, table):
        rows = table.sort_by([("positive", "ascending"), ("id", "ascending")]).combine_chunks()
        lists = rows.column("features").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        text, number = np.repeat(np.arange(len(sizes)), sizes), lists.flatten().to_numpy().astype(np.int64)
        positive = rows.column("positive").to_numpy(zero_copy_only=False).astype(bool)
        w, b = nnpu(text, number, positive, prior, n_features, seed=key[0].as_py())
        return pa.table({"model": pa.array([key[0].as_py()], pa.int32()), "weights": pa.array([w], pa.list_(pa.float64())), "bias": pa.array([b])})

    fitted = parts.groupBy("model").applyInArrow(train, "model int, weights array<double>, bias double").orderBy("model").collect()
    return ToxicityModel(feature, np.array([r["weights"] for r in fitted]), np.array([r["bias"] for r in fitted]), gram)


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with score (double, 0 to 1): the models' mean probability that a text is toxic.

    The whole text counts; null and empty texts have no feature and get the
    bias alone. A column named score is replaced.
    """
    own = [c for c in docs.columns if c not in (text_col, "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            for part in slices(batch, "_text"):
                row, number = text_features(part.column("_text"), m.gram, m.feature)
                total = np.zeros(part.num_rows)
                for w, b in zip(m.weights, m.bias):
                    f = np.bincount(row, weights=w[number], minlength=part.num_rows) + b
                    total += _sigmoid(f)
                yield pa.RecordBatch.from_arrays([part.column("_own"), pa.array(total / len(m.bias))], names=["_own", "score"])

    work = docs.select(boxed(own), F.col(f"`{text_col}`").alias("_text"))
    return work.mapInArrow(run, work.select("_own", F.lit(0.0).alias("score")).schema).select(*unboxed(own), "score")
