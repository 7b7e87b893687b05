"""Exact 1-nearest neighbour with pivots and the triangle inequality.

Training rows lie in cells (their nearest pivot), a cell is cut into rings by the distance to its pivot, and a ring into
blocks of bounded size. A test row first meets the ring around its own distance in its own cell; the best distance found
there rules out every ring that the triangle inequality or the border between two pivots puts further away, and the row
meets only the rings that are left. Nothing is approximate: a ring is skipped only if no row of it can win or tie.

Queries travel in chunks, training rows in blocks, both written once; every chunk is held against every block where they
lie, by a product of their partitions, and only pairs with a ring that a query of the chunk still needs are compared. So what is
shuffled and written grows with the tables, while the reading grows with partitions of the one times rows of the other.

On the driver: the pivots (at most ``MAX_PIVOTS`` of ``PIVOT_SAMPLE`` sampled vectors) and the rings' bounds (at most
``MAX_PIVOTS * RINGS`` numbers), whatever the tables' sizes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mlframe.session import ensure_checkpoint_dir

MAX_PIVOTS, PIVOT_SAMPLE, RINGS = 128, 4096, 64
PART_BYTES = 64 << 20  # of training rows that one task of the product holds
BEST = "qid long, dist double, tid long, pred int"


def _distances(X: np.ndarray, P: np.ndarray) -> np.ndarray:
    """Distances of all rows of X to all of P by one matrix product; ``_slack`` covers its rounding."""
    sq = (X * X).sum(1)[:, None] + (P * P).sum(1)[None, :] - 2.0 * (X @ P.T)
    return np.sqrt(np.maximum(sq, 0.0))


def _slack(X: np.ndarray, P: np.ndarray) -> np.ndarray:
    """More than the rounding error of ``_distances`` per row of X: about sqrt(dim * 2e-16) of the lengths involved."""
    size = np.sqrt((X * X).sum(1)) + np.sqrt((P * P).sum(1).max())
    return 1e-6 * np.sqrt(X.shape[1]) * size


def farthest_first(X: np.ndarray, n: int) -> np.ndarray:
    """At most ``n`` different rows of X, each the furthest from those before it."""
    chosen, far = [0], _distances(X, X[:1])[:, 0]
    while len(chosen) < n and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _distances(X, X[chosen[-1:]])[:, 0])
    return X[np.unique(chosen)]


def _choose_pivots(train: DataFrame, n_train: int, block_rows: int) -> np.ndarray:
    sample = train.orderBy(F.xxhash64("tid"), "tid").limit(PIVOT_SAMPLE).select("v").toArrow()["v"].combine_chunks()
    X = sample.flatten().to_numpy().reshape(len(sample), -1)
    return farthest_first(X, max(1, min(MAX_PIVOTS, n_train // block_rows)))


def _place(df: DataFrame, P: np.ndarray, kept: str) -> DataFrame:
    """The kept columns, the vector as bytes, its cell (nearest pivot) and the distance to that pivot."""
    names = [c.split()[0] for c in kept.split(", ")]

    def run(batches):
        for pdf in batches:
            X = np.vstack(pdf["v"].to_numpy()) if len(pdf) else np.zeros((0, P.shape[1]))
            D = _distances(X, P)
            out = pdf[names].copy()
            out["v"] = [x.tobytes() for x in X]
            out["cell"] = D.argmin(1)
            out["r"] = D.min(1)
            yield out
    return df.mapInPandas(run, f"{kept}, v binary, cell long, r double")


def _matrix(rows: pa.StructArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows.field("v").to_pylist()), dtype=float).reshape(-1, dim)


def _chunks(queries: DataFrame) -> DataFrame:
    """(chunk, qs, rings): the queries of each chunk and the rings that any of them needs; chunks are bounded."""
    n = queries.sparkSession.sparkContext.defaultParallelism
    return queries.repartition(n, "chunk").groupBy("chunk").agg(
        F.collect_list(F.struct("qid", "v", "rings")).alias("qs"), F.array_distinct(F.flatten(F.collect_list("rings"))).alias("rings"))


def _meet(queries: DataFrame, blocks: DataFrame, dim: int) -> DataFrame:
    """Best training row (least distance, then least id) of each query in each block of the rings it names.

    Neither chunks nor blocks are shuffled for it; a pair's payload is bounded."""
    needs = F.filter("qs", lambda q: F.array_contains(q["rings"], F.col("at")))
    pairs = _chunks(queries).join(blocks.hint("shuffle_replicate_nl"), F.array_contains("rings", F.col("at"))).select(
        F.transform(needs, lambda q: F.struct(q["qid"].alias("qid"), q["v"].alias("v"))).alias("qs"), "ts")

    def solve(batches):
        for batch in batches:
            for qs, ts in zip(batch.column("qs"), batch.column("ts")):
                yield nearest(qs.values, ts.values)

    def nearest(qs: pa.StructArray, ts: pa.StructArray) -> pa.RecordBatch:
        Q, X = _matrix(qs, dim), _matrix(ts, dim)
        ids = ts.field("tid").to_numpy()
        rough = (Q * Q).sum(1)[:, None] + (X * X).sum(1)[None, :] - 2.0 * (Q @ X.T)
        room = 1e-12 * dim * ((Q * Q).sum(1) + (X * X).sum(1).max())
        row, col = np.nonzero(rough <= rough.min(1)[:, None] + room[:, None])  # exact distances decide among these
        exact = np.concatenate([((Q[row[i:i + 65536]] - X[col[i:i + 65536]]) ** 2).sum(1) for i in range(0, len(row), 65536)])
        order = np.lexsort((ids[col], exact, row))
        first = order[np.searchsorted(row[order], np.arange(len(Q)))]
        return pa.RecordBatch.from_pydict({"qid": qs.field("qid"), "dist": exact[first], "tid": ids[col[first]],
                                           "pred": ts.field("tl").take(pa.array(col[first]))})
    return pairs.mapInArrow(solve, BEST)


def _search(train: DataFrame, test: DataFrame, id_col: str, vec: str, label: str, block_rows: int):
    """(best rows per query and round, visits (qid, at: a ring), rows per ring, test rows without a vector, counts)."""
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    v = F.col(vec).cast("array<double>").alias("v")
    whole = F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x))
    t = train.select(F.col(id_col).cast("long").alias("tid"), v, F.col(label).cast("int").alias("tl")).where(whole)
    q = test.select(F.col(id_col).cast("long").alias("qid"), v)
    n_train, n_test = t.select(F.lit(0).alias("side")).unionByName(q.where(whole).select(F.lit(1).alias("side"))).agg(
        F.count_if(F.col("side") == 0), F.count_if(F.col("side") == 1)).first()
    if not n_train or not n_test:
        return None, None, None, q.select("qid"), (n_train, n_test)
    P = _choose_pivots(t, n_train, block_rows)
    dim = P.shape[1]

    single = n_train <= block_rows  # one block in one ring: nothing to rule out, nothing is read twice
    placed = _place(t, P, "tid long, tl int")
    placed = placed if single else placed.checkpoint()
    steps = [i / RINGS for i in range(1, RINGS)]
    bounds = {0: ([], 0.0, float("inf"))} if single else {}
    for c in [] if single else placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("r", steps, 1000).alias("q"),
                                        F.min("r").alias("lo"), F.max("r").alias("hi")).collect():
        rings = min(RINGS, -(-c["n"] // block_rows))
        cuts = sorted({c["q"][RINGS * i // rings - 1] for i in range(1, rings)})
        bounds[c["cell"]] = ([b for b in cuts if b < c["hi"]], c["lo"], c["hi"])
    of, low, high, base = [], [], [], {}  # every ring: its cell and the distances to its pivot; the number of a cell's first ring
    for cell, (cuts, lo, hi) in sorted(bounds.items()):
        base[cell] = len(of)
        edges = [lo, *cuts, hi]
        for i in range(len(cuts) + 1):
            of.append(cell), low.append(edges[i]), high.append(edges[i + 1])
    of, low, high = map(np.array, (of, low, high))

    cells = F.broadcast(spark.createDataFrame([(k, base[k], b[0]) for k, b in bounds.items()], "cell long, base int, cuts array<double>"))
    ringed = (placed.join(cells, "cell")
              .select("tid", "tl", "v", (F.col("base") + F.size(F.filter("cuts", lambda b: b < F.col("r")))).alias("at")))
    parts = (ringed.groupBy("at").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("parts", F.ceil(F.col("n") / block_rows)))
    parts = spark.createDataFrame([(0, n_train, 1)], "at int, n long, parts long") if single else parts.checkpoint()
    blocks = (ringed.join(F.broadcast(parts.select("at", "parts")), "at")
              .select("tid", "tl", "v", "at", F.pmod(F.xxhash64("tid"), F.col("parts")).alias("part"))
              .repartition(-(-n_train * (8 * dim + 32) // PART_BYTES), "at", "part").groupBy("at", "part")
              .agg(F.collect_list(F.struct("tid", "tl", "v")).alias("ts")))
    blocks = blocks if single else blocks.checkpoint()

    def home(batches):
        for pdf in batches:
            pdf["at"] = [base[c] + int(np.searchsorted(bounds[c][0], r)) for c, r in zip(pdf["cell"], pdf["r"])]
            yield pdf

    def others(batches):
        for pdf in batches:
            Q = np.frombuffer(b"".join(pdf["v"]), dtype=float).reshape(-1, dim)
            D = _distances(Q, P)
            best = np.sqrt(pdf["dist"].to_numpy()) + 2 * _slack(Q, P)
            nearest = D.min(1)
            rings = []
            for i, d in enumerate(D):
                to = d[of]
                least = np.maximum(np.maximum(low - to, to - high), (to - nearest[i]) / 2)
                keep = least <= best[i]
                keep[pdf["at"].iat[i]] = False
                rings.append(np.flatnonzero(keep).astype(np.int32))
            yield pd.DataFrame({"qid": pdf["qid"], "v": pdf["v"], "chunk": pdf["chunk"], "rings": rings})

    start = _place(q.where(whole), P, "qid long").mapInPandas(home, "qid long, v binary, cell long, r double, at int").drop("cell", "r")
    start = start if single else start.checkpoint()
    crowds = start.groupBy("at").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("chunks"))  # at most one row per ring
    salt = F.pmod(F.xxhash64("qid"), F.col("chunks"))
    start = start.join(F.broadcast(crowds), "at").select(
        "qid", "v", "at", (F.col("at") * F.lit(2 ** 40) + salt).alias("chunk"), F.array("at").alias("rings"))
    # a pivot's own row is in its cell and every bound is a row's distance, so no home ring is empty
    first = _meet(start, blocks, dim).groupBy("qid").agg(F.min(F.struct("dist", "tid", "pred")).alias("b"))
    visits, best = start.select("qid", "at"), first
    if len(of) > 1:
        first = first.checkpoint()
        rest = start.drop("rings").join(first.select("qid", F.col("b.dist").alias("dist")), "qid").mapInPandas(
            others, "qid long, v binary, chunk long, rings array<int>")
        more = _meet(rest, blocks, dim).groupBy("qid").agg(F.min(F.struct("dist", "tid", "pred")).alias("b"))
        best = first.unionByName(more)
        visits = visits.unionByName(rest.select("qid", F.explode("rings").alias("at")))
    return best, visits, parts, q.where(~F.coalesce(whole, F.lit(False))).select("qid"), (n_train, n_test)


def knn1(train: DataFrame, test: DataFrame, id_col: str, vec: str, label: str, block_rows: int = 2048) -> DataFrame:
    """Nearest training row by squared distance; ties go to the lowest training id. (test_id, nn_id, pred, dist).

    Ids must be unique. Training rows whose vector is null or holds a null or NaN are left out; such test rows, and
    all of them if no training row is left, come back with nulls."""
    best, _, _, unplaced, _ = _search(train, test, id_col, vec, label, block_rows)
    none = unplaced.select(F.col("qid").alias("test_id"), F.lit(None).cast("long").alias("nn_id"),
                           F.lit(None).cast("int").alias("pred"), F.lit(None).cast("double").alias("dist"))
    if best is None:
        return none
    found = best.groupBy("qid").agg(F.min("b").alias("b"))
    return found.select(F.col("qid").alias("test_id"), F.col("b.tid").alias("nn_id"), F.col("b.pred").alias("pred"),
                        F.col("b.dist").alias("dist")).unionByName(none)


def knn1_work(train: DataFrame, test: DataFrame, id_col: str, vec: str, label: str, block_rows: int = 2048) -> DataFrame:
    """What ``knn1`` compares: one row (pairs, compared, skipped_share) over training and test rows with a vector."""
    _, visits, parts, _, (n_train, n_test) = _search(train, test, id_col, vec, label, block_rows)
    pairs = F.lit(n_train * n_test).cast("long").alias("pairs")
    if visits is None:
        return train.sparkSession.range(1).select(pairs, F.lit(0).cast("long").alias("compared"), F.lit(0.0).alias("skipped_share"))
    seen = visits.groupBy("at").agg(F.count(F.lit(1)).alias("visits")).join(F.broadcast(parts), "at")
    return seen.agg(F.sum(F.col("visits") * F.col("n")).alias("compared")).select(
        pairs, "compared", (1 - F.col("compared") / F.lit(n_train * n_test)).alias("skipped_share"))
