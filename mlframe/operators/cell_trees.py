"""Many trees grown on the counted cells of one table (M11, M17), one task for several trees.

Where the rows of a table fall into few cells (``boosting``), its whole content is a few megabytes of bin numbers and counts.
Each task gets all of it and grows whole trees by the rules of Spark's, so no tree level is a job of its own and nothing is
shuffled. What a parameter means for rows (a bootstrap, a row sample, the least rows of a leaf) it means for the counts:
a cell's rows are equal, so how many of them are drawn is all that matters, and that number has a known distribution."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mlframe.operators.boosting import SEED, count_cells
from mlframe.session import scratch_dir

CELLS_MOST = 2_000_000  # cells up to which a task holds them all (some 30 bytes each); tables with more are fitted on their rows
TREE_PARAMS = {"maxDepth", "maxIter", "stepSize", "subsamplingRate", "minInstancesPerNode"}  # parameters of boosted trees that ``boost`` knows
EPSILON = 2.0 ** -52  # impurity of a pure node, as in Spark


@dataclass
class Cells:
    """``bins`` (features, cells): bin numbers; ``counts`` (classes, cells): rows; ``n_bins`` per feature. Ordered by the bins."""

    bins: np.ndarray
    counts: np.ndarray
    n_bins: list[int]


def collect_cells(df: DataFrame, label: str, points, part=None) -> dict | None:
    """The cells of ``df`` between ``points``, by the value of the boolean column ``part`` (one entry under True without it; rows where it is null belong to
    none); None if there are more than ``CELLS_MOST``. Labels are 0, 1, 2, ... as for Spark's classifiers. The rows are read once; the driver gets
    packed cells, never rows."""
    counted = count_cells(df, label, points, by=[] if part is None else [part]).select(
        F.lit(True).alias("part") if part is None else F.col(part).alias("part"), F.col(label).cast("double").alias("label"), "n", "cell").where("part IS NOT NULL").persist()
    try:
        cells, low, high, odd = counted.agg(F.count(F.lit(1)), F.min("label"), F.max("label"), F.count_if(
            F.col("label").isNull() | (F.col("label") != F.floor("label")))).first()
        if cells > CELLS_MOST:
            return None
        if cells and (odd or low < 0):
            raise ValueError(f"labels of {label} must be 0, 1, 2, ...")
        split = [i for i, p in enumerate(points) if p]

        def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    bins = np.stack(b["cell"].to_list()).astype(np.uint8)
                    yield pd.DataFrame({"bins": [bins.tobytes()], "rest": [b[["part", "label", "n"]].to_numpy(np.int64).tobytes()]})

        got = counted.select("part", "label", "n", vector_to_array("cell").alias("cell")).mapInPandas(pack, "bins binary, rest binary").collect()
    finally:
        counted.unpersist()
    rest = np.concatenate([np.frombuffer(r["rest"], np.int64).reshape(-1, 3) for r in got] or [np.zeros((0, 3), np.int64)])
    bins = np.concatenate([np.frombuffer(r["bins"], np.uint8).reshape(-1, max(len(split), 1)) for r in got] or [np.zeros((0, max(len(split), 1)), np.uint8)])
    return {bool(v): _by_bins(bins[rest[:, 0] == v], rest[rest[:, 0] == v], points, split, int(high) + 1) for v in np.unique(rest[:, 0])}


def _by_bins(bins, rest, points, split, classes) -> Cells:
    places, at = np.unique(bins, axis=0, return_inverse=True)
    counts = np.zeros((classes, len(places)), np.int64)
    np.add.at(counts, (rest[:, 1], at.ravel()), rest[:, 2])
    whole = np.zeros((len(points), len(places)), np.uint8)
    if split:
        whole[split] = places.T
    return Cells(whole, counts, [len(p) + 1 for p in points])


# ---- one tree ------------------------------------------------------------------------------


def _gini(s):
    total = np.maximum(s.sum(axis=0), 1)
    return 1.0 - sum((c / total) ** 2 for c in s)


def _variance(s):
    n = np.maximum(s[0], 1)
    return (s[2] - s[1] * s[1] / n) / n


#: Impurity of a node's sums and their number of rows: rows per class, or rows, sum and sum of squares.
KINDS = {"gini": (_gini, lambda s: s.sum(axis=0)), "variance": (_variance, lambda s: s[0])}


@dataclass
class Tree:
    """Nodes by level: ``feature`` (-1: a leaf), last bin of the left side, children, sums, impurity and gain of the split."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    stats: np.ndarray
    impurity: np.ndarray
    gain: np.ndarray

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every column of ``bins``."""
        at = np.zeros(bins.shape[1], np.int32)
        cells = np.arange(bins.shape[1])
        while len(cells):
            cells = cells[self.feature[at[cells]] >= 0]
            now = at[cells]
            at[cells] = np.where(bins[self.feature[now], cells] <= self.split[now], self.left[now], self.right[now])
        return at


def grow(bins, n_bins, stats, kind: str, depth: int, min_rows: int = 1, subset: int | None = None, rng=None) -> Tree:
    """A tree as Spark grows it: by level, at each node the split of the largest gain, the first one of equals, over all
    features or a ``subset`` of so many drawn for the node; a node without a gain, a pure one or one at ``depth`` is a leaf.
    ``stats`` (sums, cells) is what nodes sum up (``KINDS``); cells without rows take no part."""
    impurity_of, rows_of = KINDS[kind]
    cells = np.flatnonzero(rows_of(stats) > 0)
    x, s = bins[:, cells], np.ascontiguousarray(stats[:, cells], dtype=float)
    at = np.zeros(len(cells), np.int64)  # a cell's node among the open ones
    sums = [s.sum(axis=1)[:, None]]
    out = {k: [np.full(1, v)] for k, v in (("feature", -1), ("split", -1), ("left", -1), ("right", -1), ("gain", -1.0))}
    impurity = [impurity_of(sums[0])]
    open_, first = np.arange(1), 0  # open nodes of this level by their place in it; number of the level's first node
    for _ in range(depth):
        a = len(open_)
        if not a or not len(at):
            break
        parent, mine = sums[-1][:, open_], impurity[-1][open_]
        drawn = None
        if subset is not None and subset < len(n_bins):
            drawn = np.argsort(rng.random((a, len(n_bins))), axis=1).argsort(axis=1) < subset  # node x feature
        best = np.full(a, -np.inf)
        feature, split, lefts = np.full(a, -1), np.full(a, -1), np.zeros_like(parent)
        for f, nb in enumerate(n_bins):
            if nb < 2:
                continue
            take = slice(None) if drawn is None else np.flatnonzero(drawn[at, f])
            key = at[take] * nb + x[f, take]
            h = np.stack([np.bincount(key, v[take], a * nb) for v in s]).reshape(len(s), a, nb)
            left = np.cumsum(h, axis=2)
            whole, left = left[:, :, -1:], left[:, :, :-1]
            right = whole - left
            nl, nr = rows_of(left), rows_of(right)
            n = np.maximum(nl + nr, 1)
            gain = mine[:, None] - nl / n * impurity_of(left) - nr / n * impurity_of(right)
            gain[(nl < min_rows) | (nr < min_rows) | (gain < 0)] = -np.inf
            top = gain.argmax(axis=1)
            g = gain[np.arange(a), top]
            if drawn is not None:
                g[~drawn[:, f]] = -np.inf
            better = g > best
            best[better], feature[better], split[better] = g[better], f, top[better]
            lefts[:, better] = left[:, better, top[better]]
        cut = np.flatnonzero(best > 0)
        nodes, after = first + open_[cut], first + sums[-1].shape[1]
        for k, v in (("feature", feature[cut]), ("split", split[cut]), ("gain", best[cut]), ("left", 0), ("right", 0)):
            out[k][-1][nodes - first] = v
        out["left"][-1][nodes - first] = after + 2 * np.arange(len(cut))
        out["right"][-1][nodes - first] = after + 2 * np.arange(len(cut)) + 1
        if not len(cut):
            break
        below = np.empty((len(s), 2 * len(cut)))
        below[:, 0::2], below[:, 1::2] = lefts[:, cut], parent[:, cut] - lefts[:, cut]
        sums.append(below)
        impurity.append(impurity_of(below))
        for k in out:
            out[k].append(np.full(2 * len(cut), -1.0 if k == "gain" else -1))
        # cells go to the children that are not pure
        place = np.full(a, -1)
        place[cut] = np.arange(len(cut))
        stay = place[at] >= 0
        x, s, at = x[:, stay], s[:, stay], at[stay]
        child = 2 * place[at] + (x[feature[at], np.arange(len(at))] > split[at])
        mixed = np.abs(impurity[-1]) >= EPSILON
        open_, first = np.flatnonzero(mixed), after
        place = np.full(len(mixed), -1)
        place[open_] = np.arange(len(open_))
        stay = place[child] >= 0
        x, s, at = x[:, stay], s[:, stay], place[child[stay]]
    return Tree(*[np.concatenate(out[k]) for k in ("feature", "split", "left", "right")], np.concatenate(sums, axis=1),
                np.concatenate(impurity), np.concatenate(out["gain"]))


def prune(t: Tree) -> Tree:
    """Two leaves of one node that predict the same class become that node, from below, as in Spark's classifiers."""
    says = t.stats.argmax(axis=0)
    feature = t.feature.copy()
    for i in range(len(feature) - 1, -1, -1):
        if feature[i] >= 0:
            a, b = t.left[i], t.right[i]
            if feature[a] < 0 and feature[b] < 0 and says[a] == says[b]:
                feature[i] = -1
    there = np.zeros(len(feature), bool)
    there[0] = True
    for i in range(len(feature)):
        if there[i] and feature[i] >= 0:
            there[t.left[i]] = there[t.right[i]] = True
    new = np.cumsum(there) - 1
    inner = feature >= 0
    child = [np.where(inner, new[np.where(inner, c, 0)], -1)[there] for c in (t.left, t.right)]
    return Tree(feature[there], np.where(inner, t.split, -1)[there], *child, t.stats[:, there], t.impurity[there], np.where(inner, t.gain, -1.0)[there])


# ---- M11: a forest -------------------------------------------------------------------------

NODES = ("treeID int, id int, prediction double, impurity double, stats array<double>, rawCount long, gain double, leftChild int, rightChild int, "
         "feature int, threshold array<double>")


def knows_forest(classifier: RandomForestClassifier) -> bool:
    """Whether ``fit_forest`` has all that the classifier asks for: other parameters than number and depth of the trees, their
    rows, and the least rows of a leaf are Spark's defaults."""
    own = {"numTrees", "maxDepth", "seed", "subsamplingRate", "bootstrap", "minInstancesPerNode", "cacheNodeIds", "checkpointInterval",
           "maxMemoryInMB", "featuresCol", "labelCol", "predictionCol", "probabilityCol", "rawPredictionCol"}
    return all(p.name in own or not classifier.isSet(p) or classifier.hasDefault(p) and classifier.getOrDefault(p) == classifier._defaultParamMap[p] for p in classifier.params)


def fit_forest(spark, classifier: RandomForestClassifier, cells: Cells, points) -> RandomForestClassificationModel:
    """``classifier`` (one that ``knows_forest``) fitted on cells: each tree has a bootstrap of the rows (a cell of n rows gives a
    Poisson number of mean n, which is the sum of the rows' own draws) and square-root subsets of the features at each node.
    The trees are written in the format of Spark's models and loaded as one."""
    trees, depth, seed = classifier.getNumTrees(), classifier.getMaxDepth(), classifier.getSeed()
    rate, bootstrap, least = classifier.getSubsamplingRate(), classifier.getBootstrap(), classifier.getMinInstancesPerNode()
    subset = int(np.ceil(np.sqrt(len(points)))) if trees > 1 else None
    held, limits = spark.sparkContext.broadcast(cells), [list(map(float, p)) for p in points]

    def grow_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = held.value
        for ids in batches:
            for i in ids["id"]:
                rng = np.random.Generator(np.random.PCG64([seed, int(i)]))
                drawn = rng.poisson(rate * c.counts) if bootstrap else c.counts if rate >= 1 else rng.binomial(c.counts, rate)
                t = prune(grow(c.bins, c.n_bins, drawn, "gini", depth, least, subset, rng))
                inner = t.feature >= 0
                yield pd.DataFrame({
                    "treeID": i, "id": np.arange(len(inner)), "prediction": t.stats.argmax(axis=0).astype(float), "impurity": t.impurity,
                    "stats": list(t.stats.T), "rawCount": t.stats.sum(axis=0).astype(np.int64), "gain": t.gain, "leftChild": t.left, "rightChild": t.right,
                    "feature": t.feature, "threshold": [[limits[f][s]] if f >= 0 else [] for f, s in zip(t.feature, t.split)]})

    tasks = min(trees, 2 * spark.sparkContext.defaultParallelism)
    nodes = spark.range(0, trees, 1, tasks).mapInPandas(grow_all, NODES).select("treeID", F.struct(
        "id", "prediction", "impurity", F.col("stats").alias("impurityStats"), "rawCount", "gain", "leftChild", "rightChild",
        F.struct(F.col("feature").alias("featureIndex"), F.col("threshold").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories")).alias("split")).alias("nodeData"))
    # a forest of the same parameters on one row per class is the frame that the trees go into
    zeros = Vectors.dense([0.0] * len(points))
    frame = classifier.copy().fit(spark.createDataFrame([(zeros, float(k)) for k in range(len(cells.counts))], [classifier.getFeaturesCol(), classifier.getLabelCol()]))
    root = scratch_dir(spark, "forest")
    frame.write().overwrite().save(root)
    nodes.write.mode("overwrite").parquet(f"{root}/data")
    model = RandomForestClassificationModel.load(root)
    held.unpersist()
    return model


def representatives(df: DataFrame, label: str, points, features: str = "features") -> DataFrame:
    """One row per cell of ``df``: a vector between the same ``points`` and ``rows``, the numbers of its rows by label. A model whose
    thresholds these are gives the vector the score of the cell's rows."""
    cells = count_cells(df, label, points).groupBy("cell").agg(F.collect_list(F.struct(F.col(label).alias("label"), F.col("n").cast("double").alias("n"))).alias("rows"))
    place = {f: j for j, f in enumerate(i for i, p in enumerate(points) if p)}

    def value(f):
        inside = [float(p) for p in points[f]]
        values = F.array(*[F.lit(v) for v in [*inside, float(np.nextafter(inside[-1], np.inf))]])
        return F.element_at(values, vector_to_array("cell")[place[f]].cast("int") + 1)
    return cells.select("rows", array_to_vector(F.array(*[value(f) if f in place else F.lit(0.0) for f in range(len(points))])).alias(features))


# ---- M17: boosted trees --------------------------------------------------------------------


def boost(train: Cells, held: Cells, params: dict) -> np.ndarray:
    """Raw scores of the cells of ``held`` by Spark's ``GBTClassifier`` of two classes: the first tree fits the labels, the
    others the gradients of the log loss, each on its own row sample (of a cell's n rows a binomial number)."""
    rate, step = params.get("subsamplingRate", 1.0), params.get("stepSize", 0.1)
    counts = np.vstack([train.counts, np.zeros((2 - len(train.counts), train.counts.shape[1]), np.int64)])
    f, out = np.zeros(counts.shape[1]), np.zeros(held.bins.shape[1])
    for m in range(params.get("maxIter", 20)):
        n = counts if rate >= 1 else np.random.Generator(np.random.PCG64([SEED, m])).binomial(counts, rate)
        up, down = (4 / (1 + np.exp(2 * f)), -4 / (1 + np.exp(-2 * f))) if m else (np.ones_like(f), -np.ones_like(f))
        stats = np.stack([n[0] + n[1], n[1] * up + n[0] * down, n[1] * up * up + n[0] * down * down])
        t = grow(train.bins, train.n_bins, stats, "variance", params.get("maxDepth", 5), params.get("minInstancesPerNode", 1))
        value = (step if m else 1.0) * t.stats[1] / np.maximum(t.stats[0], 1)
        f, out = f + value[t.leaves(train.bins)], out + value[t.leaves(held.bins)]
    return out


def boost_all(spark, train: Cells, held: Cells, trials: dict) -> DataFrame:
    """One boosted classifier per trial (number -> parameters), each in one task; the distinct scores of ``held`` with their
    labels and rows: trial, score, label, n."""
    both, asked = spark.sparkContext.broadcast((train, held)), sorted(trials)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = both.value
        for places in batches:
            for i in places["id"]:
                score, at = np.unique(boost(a, b, trials[asked[i]]), return_inverse=True)
                for k, counts in enumerate(b.counts):
                    n = np.bincount(at, counts, len(score)).astype(np.int64)
                    yield pd.DataFrame({"trial": asked[i], "score": score[n > 0], "label": float(k), "n": n[n > 0].astype(float)})

    return spark.range(0, len(asked), 1, len(asked)).mapInPandas(run, "trial int, score double, label double, n double")
