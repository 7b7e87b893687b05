"""Boosted regression trees on packed rows (M15), for tables whose cells are about as many as their rows.

Rows are cut once into bin numbers and packed into blocks, a byte per row for a feature or several with few bins. Each tree level is one pass over the
blocks in numpy; a task gives back its sums per node and bin, the driver adds them up and picks the splits by the rules of
Spark's trees. Only the packed blocks are shuffled, once, to lie evenly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mlframe.operators.boosting import split_points
from mlframe.operators.cell_trees import EPSILON, Tree

BLOCK_ROWS = 100_000  # rows of a block
TASK_ROWS = 2_000_000  # rows of a task, whose blocks it may get at once
PACKED = "n long, bytes binary, y binary, f binary"
VALUES = 256  # of a byte


class Layout:
    """Where the bin of a feature is found: features of few bins share a byte, as (byte // stride) % bins."""

    def __init__(self, points):
        self.points = [np.asarray(p, float) for p in points]
        self.n_bins, self.column, self.stride, self.sizes = [len(p) + 1 for p in points], [], [], []
        for n in self.n_bins:
            c = next((c for c, size in enumerate(self.sizes) if size * n <= VALUES), len(self.sizes))
            self.sizes += [1] * (c == len(self.sizes))
            self.column.append(c)
            self.stride.append(self.sizes[c])
            self.sizes[c] *= n

    def bins(self, x: np.ndarray) -> np.ndarray:
        """The bytes (columns, rows) of numbers (rows, features)."""
        out = np.zeros((len(self.sizes), len(x)), np.uint8)
        for i, p in enumerate(self.points):
            if len(p):
                out[self.column[i]] += ((x[:, i] > p[0]) if len(p) == 1 else np.searchsorted(p, x[:, i])).astype(np.uint8) * np.uint8(self.stride[i])
        return out

    def of_feature(self, i: int, column_sums: np.ndarray) -> np.ndarray:
        """Sums (..., bins of feature i) from those by the values of its column."""
        head, n = column_sums.shape[:-1], self.n_bins[i]
        return column_sums.reshape(*head, -1, n, self.stride[i]).sum(axis=(-3, -1))

    def leaves(self, t: Tree, columns: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        nodes, value = np.arange(len(t.feature)), np.arange(VALUES)
        column, after, level = np.zeros(len(nodes), np.int64), np.repeat(nodes[:, None], VALUES, axis=1), np.zeros(len(nodes), int)
        for i in np.flatnonzero(t.feature >= 0):
            f = t.feature[i]
            column[i] = self.column[f]
            after[i] = np.where(value // self.stride[f] % self.n_bins[f] <= t.split[i], t.left[i], t.right[i])
            level[[t.left[i], t.right[i]]] = level[i] + 1
        n = columns.shape[1]
        at, flat, rows = np.zeros(n, np.int64), columns.ravel(), np.arange(n)
        column, after = column * n, after.ravel()
        for step in range(level.max()):
            seen = flat.take(column.take(at) + rows) if step else columns[column[0] // n]
            at = after.take(at * VALUES + seen)
        return at


def pack(df: DataFrame, label: str, lay: Layout, rows: int) -> DataFrame:
    """The rows of ``df`` (vector ``features`` and a number) in blocks: their bins, labels and predictions so far (0). ``rows``
    is about their number; blocks are dealt evenly."""

    def block(x, y):
        return pa.RecordBatch.from_pydict({"n": pa.array([len(y)], pa.int64()), "bytes": [lay.bins(x).tobytes()], "y": [y.tobytes()], "f": [np.zeros(len(y)).tobytes()]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held.append((b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1), b.column(1).to_numpy(zero_copy_only=False)))
                n += b.num_rows
            if n >= BLOCK_ROWS:
                yield block(*map(np.concatenate, zip(*held)))
                held, n = [], 0
        if n:
            yield block(*map(np.concatenate, zip(*held)))

    cores = df.sparkSession.sparkContext.defaultParallelism
    blocks = df.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y")).mapInArrow(run, PACKED)
    return blocks.repartition(cores * -(-rows // (TASK_ROWS * cores)))


def _read(b):
    y = np.frombuffer(b.y, float)
    return np.frombuffer(b.bytes, np.uint8).reshape(-1, len(y)), y, np.frombuffer(b.f, float)


def _target(y, f, first: bool):
    """What a tree is fitted to: the labels, then Spark's gradients of the squared error."""
    return y if first else 2.0 * (y - f)


def _sums(blocks: DataFrame, lay: Layout, tree: Tree, open_, first: bool):
    """Per node of ``open_``: (rows, sum, sum of squares) of the targets, and (rows, sum) per feature and bin."""
    a, edges = len(open_), np.concatenate([[0], np.cumsum(lay.sizes)])
    place = np.full(len(tree.feature), -1)
    place[open_] = np.arange(a)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nodes, sums, some = np.zeros((3, a)), np.zeros((2, a, edges[-1])), False
        for batch in batches:
            for b in batch.itertuples():
                columns, y, f = _read(b)
                t, at, some = _target(y, f, first), place.take(lay.leaves(tree, columns)), True
                if at.min() < 0:
                    keep = np.flatnonzero(at >= 0)
                    columns, t, at = columns[:, keep], t[keep], at[keep]
                for k, w in enumerate((None, t, t * t)):
                    nodes[k] += np.bincount(at, w, a)
                for c, size in enumerate(lay.sizes):
                    key = at * size + columns[c]
                    for k, w in enumerate((None, t)):
                        sums[k, :, edges[c]:edges[c + 1]] += np.bincount(key, w, a * size).reshape(a, size)
        if some:
            yield pd.DataFrame({"nodes": [nodes.tobytes()], "sums": [sums.tobytes()]})

    got = blocks.mapInPandas(run, "nodes binary, sums binary").collect()
    nodes = sum((np.frombuffer(r["nodes"]).reshape(3, a) for r in got), np.zeros((3, a)))
    sums = sum((np.frombuffer(r["sums"]).reshape(2, a, edges[-1]) for r in got), np.zeros((2, a, edges[-1])))
    return nodes, [lay.of_feature(i, sums[:, :, edges[c]:edges[c + 1]]) for i, c in enumerate(lay.column)]


def _leaf() -> Tree:
    return Tree(np.array([-1]), np.array([-1]), np.array([-1]), np.array([-1]), np.zeros((3, 1)), np.zeros(1), np.array([-1.0]))


def _grow(blocks: DataFrame, lay: Layout, depth: int, first: bool) -> Tree:
    """A regression tree by level: at each node the first split of the largest gain in variance; none without a gain, none
    of a node without variance."""
    tree, open_ = _leaf(), np.arange(1)
    for level in range(max(depth, 1)):
        nodes, hists = _sums(blocks, lay, tree, open_, first)
        n, s, q = nodes
        tree.stats[:, open_] = nodes
        variance = (q - s * s / np.maximum(n, 1)) / np.maximum(n, 1)
        tree.impurity[open_] = variance
        best, feature, split, lefts = np.zeros(len(open_)), np.full(len(open_), -1), np.full(len(open_), -1), np.zeros((2, len(open_)))
        for j, h in enumerate(hists if depth else []):
            if lay.n_bins[j] < 2:
                continue
            left = np.cumsum(h, axis=2)[:, :, :-1]
            nl, sl = left
            nr, sr = n[:, None] - nl, s[:, None] - sl
            gain = (sl * sl / np.maximum(nl, 1) + sr * sr / np.maximum(nr, 1) - (s * s / np.maximum(n, 1))[:, None]) / np.maximum(n, 1)[:, None]
            gain[(nl < 1) | (nr < 1) | (np.abs(variance) < EPSILON)[:, None]] = -np.inf
            top = gain.argmax(axis=1)
            g = gain[np.arange(len(open_)), top]
            better = g > best
            best[better], feature[better], split[better] = g[better], j, top[better]
            lefts[:, better] = left[:, better, top[better]]
        cut = np.flatnonzero(feature >= 0)
        if not len(cut):
            break
        parent, after = open_[cut], len(tree.feature)
        tree.feature[parent], tree.split[parent], tree.gain[parent] = feature[cut], split[cut], best[cut]
        tree.left[parent], tree.right[parent] = after + 2 * np.arange(len(cut)), after + 2 * np.arange(len(cut)) + 1
        below = np.zeros((3, 2 * len(cut)))
        below[:2, 0::2], below[:2, 1::2] = lefts[:, cut], nodes[:2, cut] - lefts[:, cut]
        more = 2 * len(cut)
        tree = Tree(*[np.concatenate([v, np.full(more, -1)]) for v in (tree.feature, tree.split, tree.left, tree.right)],
                    np.concatenate([tree.stats, below], axis=1), np.concatenate([tree.impurity, np.zeros(more)]), np.concatenate([tree.gain, np.full(more, -1.0)]))
        open_ = np.arange(after, after + more)
    return tree


def _move(blocks: DataFrame, lay: Layout, tree: Tree, step: float) -> DataFrame:
    """The blocks with the tree's prediction, times ``step``, added."""
    value = step * tree.stats[1] / np.maximum(tree.stats[0], 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in batch.itertuples():
                columns, _, f = _read(b)
                yield pd.DataFrame({"n": [b.n], "bytes": [b.bytes], "y": [b.y], "f": [(f + value.take(lay.leaves(tree, columns))).tobytes()]})

    return blocks.mapInPandas(run, PACKED)


def fit_and_test(train: DataFrame, test: DataFrame, label: str, rows: int, iters: int, depth: int, step: float = 0.1) -> tuple:
    """RMSE and MAE on ``test`` of Spark's ``GBTRegressor`` fitted to ``train``, a table of ``rows`` rows; a test row without a label does not count."""
    odd = train.where(F.col(label).isNull() | F.isnan(F.col(label).cast("double"))).limit(1).count()
    if odd:
        raise ValueError(f"{label} has null or NaN in training rows")
    lay, trees = Layout(split_points(train, rows)), []
    now = pack(train, label, lay, rows).persist()
    try:
        for m in range(iters):
            trees.append((_grow(now, lay, depth, m == 0), step if m else 1.0))
            if m + 1 < iters:
                last, now = now, _move(now, lay, *trees[-1]).persist()
                now.count()
                last.unpersist()
    finally:
        now.unpersist()

    def errors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in batch.itertuples():
                columns, y, f = _read(b)
                for t, w in trees:
                    f = f + (w * t.stats[1] / np.maximum(t.stats[0], 1)).take(lay.leaves(t, columns))
                yield pd.DataFrame({"n": [float(len(y))], "squares": [((f - y) ** 2).sum()], "sizes": [np.abs(f - y).sum()]})

    held = pack(test.where(F.col(label).isNotNull()), label, lay, rows).mapInPandas(errors, "n double, squares double, sizes double")
    return tuple(held.agg(F.sqrt(F.try_divide(F.sum("squares"), F.sum("n"))), F.try_divide(F.sum("sizes"), F.sum("n"))).first())
