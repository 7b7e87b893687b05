"""Model fitting and scoring on ``pyspark.ml``.
Fits are distributed estimators; only fitted parameters (never data rows) reach the driver."""

from __future__ import annotations

import json
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.ml.feature import OneHotEncoder, PCA, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mlframe.operators.boosting import CELL_PARAMS, POINT_ROWS, SEED, score_configs, split_points
from mlframe.operators.cell_trees import TREE_PARAMS, boost_all, collect_cells, fit_forest, knows_forest, representatives
from mlframe.operators.metrics import ranking_metrics
from mlframe.operators.packed_trees import fit_and_test
from mlframe.operators.neighbours import knn1, knn1_work  # noqa: F401


def assemble(df: DataFrame, cols, out: str = "features", keep_invalid: bool = False) -> DataFrame:
    """The columns as one vector. For fits rows with a null feature are left
    out; ``keep_invalid`` keeps them, with a null vector, for scoring."""
    whole = F.lit(True)
    for c in cols:
        whole = whole & F.col(c).isNotNull()
    if not keep_invalid:
        return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df.where(whole))
    vec = array_to_vector(F.array(*[F.col(c).cast("double") for c in cols]))
    return df.withColumn(out, F.when(whole, vec))


SPREAD_FROM = 100_000  # rows above which the partitions of a fit are looked at
FIT_ROWS = 10_000  # rows that are worth a task of their own in an iterative fit
CELLS_FROM = 100_000  # training rows above which boosted trees are fitted on counted cells; below, counting takes longer than it saves
SIDE_BY_SIDE_ROWS = 1_000_000  # trials of a search run side by side below this; above it one fit fills the cores and its caches the memory


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over the cores if they lie in a few large partitions (a file of few row groups): each of a
    fit's many passes takes as long as its largest partition. Small or even tables stay as they are. A fit sends
    statistics per partition and tree node, so there are no more partitions than cores."""
    sizes = [r[0] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).select("n").collect()]
    if sum(sizes) <= SPREAD_FROM:
        return df
    parts = min(-(-sum(sizes) // FIT_ROWS), df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(parts) if parts > 1 and max(sizes) * parts > 1.5 * sum(sizes) else df


# ---- M2 ----------------------------------------------------------------------------

def pca_score(df: DataFrame, cols, k: int = 2, name: str = "recon_error"):
    """Top-k PCA on (already standardised) columns; score = mean squared
    reconstruction error, written as a native expression from the d x k
    loading matrix. Returns (scored frame, explained-variance share)."""
    model = PCA(k=k, inputCol="features", outputCol="pc").fit(assemble(df, cols))
    P = model.pc.toArray()  # d x k
    x = [F.col(c) for c in cols]
    proj = [sum(x[i] * float(P[i, j]) for i in range(len(cols))) for j in range(k)]
    recon = [sum(proj[j] * float(P[i, j]) for j in range(k)) for i in range(len(cols))]
    err = sum((x[i] - recon[i]) * (x[i] - recon[i]) for i in range(len(cols))) / len(cols)
    share = float(np.sum(model.explainedVariance.toArray()))
    return df.select("*", *[p.alias(f"pc{j + 1}") for j, p in enumerate(proj)], err.alias(name)), share


# ---- M9 / M10 ------------------------------------------------------------------

def kmeans_sweep(df: DataFrame, features: str = "features", ks=range(2, 11), seed: int = 42) -> DataFrame:
    """Inertia, silhouette, Calinski-Harabasz and Davies-Bouldin per k. The
    per-cluster sums for CH/DB come from one aggregate per k; only k x d
    centroid numbers are combined on the driver."""
    spark = df.sparkSession
    d = df.select(features).cache()
    try:
        rows = [_sweep_point(d, features, k, seed) for k in ks]
    finally:
        d.unpersist()
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double, calinski_harabasz double, davies_bouldin double")


def _sweep_point(d: DataFrame, features: str, k: int, seed: int) -> tuple:
    total_n = d.count()
    xs = vector_to_array(features)
    model = KMeans(k=k, seed=seed, featuresCol=features).fit(d)
    pred = model.transform(d)
    sil = ClusteringEvaluator(featuresCol=features).evaluate(pred)
    cents = np.array([c for c in model.clusterCenters()])
    cent_col = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in cents])
    mine = F.element_at(cent_col, F.col("prediction") + 1)
    dist = F.sqrt(F.aggregate(F.zip_with(xs, mine, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v))
    st = pred.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"), F.avg(dist).alias("s"),
                                        F.sum(dist * dist).alias("ssw")).collect()
    n_c = np.zeros(k)
    s_c = np.zeros(k)
    ssw = 0.0
    for r in st:
        n_c[r["prediction"]], s_c[r["prediction"]] = r["n"], r["s"]
        ssw += r["ssw"]
    g = (cents * n_c[:, None]).sum(axis=0) / max(n_c.sum(), 1)
    ssb = float((n_c * ((cents - g) ** 2).sum(axis=1)).sum())
    ch = (ssb / (k - 1)) / (ssw / (total_n - k)) if ssw > 0 and total_n > k else None
    dm = np.sqrt(((cents[:, None, :] - cents[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(dm, np.inf)
    db = float(np.mean(np.max((s_c[:, None] + s_c[None, :]) / dm, axis=1)))
    return (k, float(model.summary.trainingCost), float(sil), ch, db)


def cluster_table(df: DataFrame, cols, k: int = 4, seed: int = 42, log_cols=None):
    """Labels and two principal coordinates per row (null for a row with a
    null feature); centroids back in original units (``expm1`` of log
    features, rounded)."""
    a = assemble(df, cols)
    km = KMeans(k=k, seed=seed).fit(a)
    pca = PCA(k=2, inputCol="features", outputCol="pc").fit(a)
    names = [c for c in df.columns]
    rest = df.where(" OR ".join(f"`{c}` IS NULL" for c in cols)).select(
        *names, F.lit(None).cast("int").alias("cluster"), *[F.lit(None).cast("double").alias(f"pc{i}") for i in (1, 2)])
    out = pca.transform(km.transform(a)).select("*", vector_to_array("pc")[0].alias("pc1"),
                                                  vector_to_array("pc")[1].alias("pc2")).drop("features", "pc")
    cent = [(i, *[float(v) for v in c]) for i, c in enumerate(km.clusterCenters())]
    cdf = df.sparkSession.createDataFrame(cent, ["cluster"] + list(cols))
    if log_cols:
        cdf = cdf.select("cluster", *[F.round(F.expm1(c), 0).alias(c) if c in log_cols else F.col(c) for c in cols])
    labelled = out.withColumnRenamed("prediction", "cluster").select(*names, "cluster", "pc1", "pc2")
    return labelled.unionByName(rest), cdf


# ---- M11 / M12 / M13 ----------------------------------------------------------------

NODE_IDS = 500_000_000  # rows times trees up to which a forest remembers each row's node (4 bytes) instead of walking from the root at every level


def propensity_pipeline(cat_cols, num_cols, label: str, trees: int = 200, depth: int = 12, seed: int = 42, rows: int | None = None):
    """Indexed and one-hot categories, numerics, a forest. ``rows`` (of the fit) decides how it is grown, not what grows."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in cat_cols]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in cat_cols], outputCols=[f"{c}_ohe" for c in cat_cols])
    va = VectorAssembler(inputCols=[f"{c}_ohe" for c in cat_cols] + list(num_cols), outputCol="features")
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed,
                                cacheNodeIds=rows is not None and rows * trees <= NODE_IDS)
    return Pipeline(stages=[*idx, ohe, va, rf])


def fit_propensity(pipe: Pipeline, train: DataFrame, rows: int):
    """The pipeline fitted on a table of ``rows`` rows, and the split points of its forest if that was grown on counted
    cells, as for more than ``CELLS_FROM`` rows (unless nearly every row has a cell of its own)."""
    forest = pipe.getStages()[-1]
    if rows > CELLS_FROM and knows_forest(forest):
        prepared = Pipeline(stages=pipe.getStages()[:-1]).fit(train)
        x = prepared.transform(train).select(forest.getFeaturesCol(), forest.getLabelCol())
        points = split_points(x, rows)
        cells = collect_cells(x, forest.getLabelCol(), points)
        if cells is not None:
            return PipelineModel([*prepared.stages, fit_forest(train.sparkSession, forest, cells[True], points)]), points
    return pipe.fit(train), None


def held_out_auc(model: PipelineModel, test: DataFrame, label: str, points=None) -> float:
    """ROC-AUC on held-out rows. With the forest's split ``points`` each cell of them is scored once and counts as many rows as it has."""
    ev = BinaryClassificationEvaluator(labelCol=label)
    if points is None:
        return ev.evaluate(model.transform(test))
    cells = representatives(PipelineModel(model.stages[:-1]).transform(test), label, points)
    # scoring takes long and its input is small: dealt over the cores; only the column that is asked for, each would walk all trees again
    forest = model.stages[-1].copy({model.stages[-1].probabilityCol: "", model.stages[-1].predictionCol: ""})
    scored = forest.transform(cells.repartition(test.sparkSession.sparkContext.defaultParallelism))
    return ev.setLabelCol("label").setWeightCol("n").evaluate(scored.select("rawPrediction", F.inline("rows")))


def feature_names(model: PipelineModel, df: DataFrame) -> list[str]:
    """Names of the assembled vector slots (from the ML attribute metadata)."""
    meta = model.transform(df.limit(1)).schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted([a for group in meta.values() for a in group], key=lambda a: a["idx"])
    return [a["name"] for a in slots]


def importances(model: PipelineModel, df: DataFrame, top: int = 15) -> DataFrame:
    names = feature_names(model, df)
    imp = model.stages[-1].featureImportances.toArray()
    rows = sorted(zip(names, map(float, imp)), key=lambda t: (-t[1], t[0]))[:top]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def probability(df: DataFrame, name: str = "score") -> DataFrame:
    return df.withColumn(name, vector_to_array("probability")[1])


def score(df: DataFrame, model, threshold: float = 0.5, keep=None) -> DataFrame:
    """Apply a fitted model to every row, threshold, vector -> array."""
    out = probability(model.transform(df))
    out = out.withColumn("prediction", (F.col("score") >= threshold).cast("int"))
    return out.select(*(keep or df.columns), "score", "prediction")


def save_with_lookup(spark, model: PipelineModel, path: str, lookup_spec: dict) -> str:
    """Persist the model together with its feature lookup spec
    (:func:`lookup_features`), so scoring needs only keys."""
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(lookup_spec),)], "spec string").coalesce(1).write.mode("overwrite").json(f"{path}/spec")
    return path


def load_with_lookup(spark, path: str):
    spec = json.loads(spark.read.json(f"{path}/spec").first()["spec"])
    return PipelineModel.load(f"{path}/model"), spec


def lookup_features(keys: DataFrame, spec: dict, read_table) -> DataFrame:
    """``keys`` with the features that the spec names, read from the tables it names.

    ``spec["sources"]`` are joined in order, each a dict of ``table``, ``on``
    (column so far -> column of the table) and ``columns`` (feature -> SQL
    expression over the table). Later sources may join on earlier features.
    ``read_table(name)`` opens a table. A missing row gives nulls."""
    out = keys
    for src in spec["sources"]:
        names = {theirs: f"_k{i}" for i, theirs in enumerate(src["on"].values())}
        table = read_table(src["table"]).select(*[F.col(c).alias(n) for c, n in names.items()],
                                                *[F.expr(e).alias(f) for f, e in src["columns"].items()])
        on = F.lit(True)
        for ours, theirs in src["on"].items():
            on = on & (F.col(ours) == F.col(names[theirs]))
        out = out.join(table, on, "left").drop(*names.values())
    return out


# ---- M14 / M15 / M17 / M31 -----------------------------------------------------------

def fit_compare(train: DataFrame, test: DataFrame, label: str, configs: dict, weight: str | None = None) -> DataFrame:
    """One GBT per config (optionally class-weighted), ranked by
    average precision on held-out rows (rank 1 is the champion; equal ones
    go by name). The rows of a large table are counted into cells of equal bins
    and the trees fitted on these (``boosting``); a small one, or a config with
    other parameters than ``CELL_PARAMS`` (limits of rows in a leaf and the
    like), is fitted on the rows."""
    spark = train.sparkSession
    out, by_weight, rows = [], {}, train.count()
    for name, params in configs.items():
        p = dict(params)
        w = weight if p.pop("weighted", False) and weight else None
        if rows > CELLS_FROM and set(p) <= CELL_PARAMS:
            by_weight.setdefault(w, {})[name] = p
            continue
        gbt = GBTClassifier(labelCol=label, featuresCol="features", seed=42, **p)
        m = (gbt.setWeightCol(w) if w else gbt).fit(train)
        out.append((name, ranking_metrics(probability(m.transform(test)), label, "score").first()))
    for w, group in by_weight.items():
        out += [(name, ranking_metrics(scored, label, "score", rows="n").first()) for name, scored in score_configs(train, test, label, group, rows, w)]
    best = sorted(((name, float(r["roc_auc"]), float(r["avg_precision"])) for name, r in out), key=lambda r: (-r[2], r[0]))
    return spark.createDataFrame([(i, i == 1, *r) for i, r in enumerate(best, 1)], "rank int, champion boolean, config string, roc_auc double, avg_precision double")


def fit_rating(train: DataFrame, test: DataFrame, label: str, iters: int = 20, depth: int = 5) -> DataFrame:
    """Boosted regression trees; RMSE and MAE on held-out rows. The rows of a large table are packed for it (``packed_trees``)."""
    rows = train.count()
    if rows > CELLS_FROM:
        return train.sparkSession.createDataFrame([fit_and_test(train, test, label, rows, iters, depth)], "rmse double, mae double")
    m = GBTRegressor(labelCol=label, featuresCol="features", maxIter=iters, maxDepth=depth, seed=42).fit(train)
    err = F.col("prediction") - F.col(label)
    row = m.transform(test).agg(F.sqrt(F.avg(err * err)), F.avg(F.abs(err))).first()  # both in one pass over the scored rows
    return train.sparkSession.createDataFrame([tuple(row)], "rmse double, mae double")


def _cells_of(df: DataFrame, part: str, label: str, rows: int):
    """Cells of the training rows of ``df`` (``part`` is true) and of the held-out ones, counted in one pass; split points
    come from the training rows. ``rows`` is their number or more. None if the cells are too many, or there are none of one kind."""
    # the draw comes before what makes ``part``, which drawn rows alone need; split_points takes its number from somewhat more
    drawn = df.where(F.rand(SEED) < min(1.0, 2 * POINT_ROWS / rows)).where(part).select("features").persist()
    try:
        points = split_points(drawn, drawn.count())
    finally:
        drawn.unpersist()
    cells = collect_cells(df, label, points, part)
    return (cells[True], cells[False]) if cells is not None and len(cells) == 2 else None


def _areas(spark, cells, trials: dict, parallelism: int) -> dict:
    """Area under the precision-recall curve per trial (number -> parameters), all fitted at once on cells."""
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", weightCol="n", metricName="areaUnderPR")
    scored = boost_all(spark, *cells, trials).persist()
    try:
        scored.count()  # one job fits them all
        with ThreadPool(parallelism) as pool:
            return dict(zip(trials, pool.map(inheritable_thread_target(lambda t: float(ev.evaluate(scored.where(F.col("trial") == t)))), trials)))
    finally:
        scored.unpersist()


def search(df: DataFrame, label: str, grid: dict, parallelism: int = 4, ratio: float = 0.8, rows: int | None = None) -> DataFrame:
    """Parameter search on a random split. The trials of a large table are fitted on its counted cells (``cell_trees``),
    each in a task; ``rows`` is its number of rows or more, if known. Trials on rows (a small table, other parameters than
    ``TREE_PARAMS``) train in parallel (``parallelism``) while the table is small, one after the other on all cores once it
    is large. Only the metrics are asked for, so no last fit on all rows follows."""
    gbt = GBTClassifier(labelCol=label, featuresCol="features", seed=42)
    b = ParamGridBuilder()
    for k, vals in grid.items():
        b = b.addGrid(getattr(gbt, k), vals)
    maps = b.build()
    trials = {i: {p.name: v for p, v in pm.items()} for i, pm in enumerate(maps)}
    split = df.withColumn("_u", F.rand(42))
    rows, cells, held = df.count() if rows is None else rows, None, []
    if rows > CELLS_FROM and set(grid) <= TREE_PARAMS:
        cells = _cells_of(split.withColumn("_part", F.expr("_u < %r" % ratio)), "_part", label, rows)
    try:
        if cells is None:
            split = spread(df).withColumn("_u", F.rand(42))
            held = [split.where("_u < %r" % ratio).select("features", label).persist(), split.where("_u >= %r" % ratio).select("features", label).persist()]
            ev = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderPR")
            at_once = parallelism if held[0].count() <= SIDE_BY_SIDE_ROWS else 1
            with ThreadPool(at_once) as pool:
                metrics = pool.map(inheritable_thread_target(lambda pm: ev.evaluate(gbt.fit(held[0], pm).transform(held[1]))), maps)
        else:
            areas = _areas(df.sparkSession, cells, trials, parallelism)
            metrics = [areas[i] for i in trials]
    finally:
        for h in held:
            h.unpersist()
    got = [(json.dumps(trials[i]), float(metric)) for i, metric in enumerate(metrics)]
    return df.sparkSession.createDataFrame(got, "params string, area_under_pr double")


# ---- distributions of a random search, and their draws --------------------------------


def randint(low: int, high: int):
    """A whole number from low to high - 1."""
    return lambda rng: int(rng.integers(low, high))


def choice(values):
    """One of the values, each as likely."""
    return lambda rng: values[int(rng.integers(len(values)))]


def uniform(low: float, high: float):
    return lambda rng: float(rng.uniform(low, high))


def loguniform(low: float, high: float):
    """A number whose logarithm is uniform."""
    return lambda rng: float(np.exp(rng.uniform(np.log(low), np.log(high))))


def draw_trials(space: dict, n: int, seed: int) -> list[dict]:
    """``n`` points of a space (name -> distribution); a trial's draw depends on the seed and its number alone."""
    return [{k: space[k](np.random.Generator(np.random.PCG64([seed, i, j]))) for j, k in enumerate(sorted(space))} for i in range(n)]


def random_search(train: DataFrame, valid: DataFrame, label: str, space: dict, trials: int = 10, seed: int = 0, budgets=(4, 8, 16),
                  keep: float = 0.5, parallelism: int = 4, whole: DataFrame | None = None, part: str = "_part") -> DataFrame:
    """Random search with successive halving over boosted-tree parameters.

    All trials are fitted with the first budget (number of trees), the best
    ``keep`` of them (at least one) with the next one, and so on. The trials of
    a rung are fitted on the counted cells of a large table (``cell_trees``),
    each in a task. On rows (a small table, other parameters than
    ``TREE_PARAMS``) they are parallel jobs of one session while the table is small (each fit
    caches the rows anew) and one after the other on all cores once it is large. One row per fit: rung, budget,
    trial, params (JSON), area_under_pr on ``valid``, and whether the trial
    went on; of the last rung the best is marked. Equal metrics go by trial
    number, so a seed gives the same rows again. If ``train`` and ``valid`` are the rows of one frame where
    ``part`` is true and false, ``whole`` is that frame, which is then read once for both.
    """
    spark, drawn = train.sparkSession, draw_trials(space, trials, seed)
    alive, rows = list(range(trials)), []
    ev = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderPR")
    if whole is None:
        whole = train.select("features", label, F.lit(True).alias(part)).unionAll(valid.select("features", label, F.lit(False).alias(part)))
    n, cells, held = whole.count(), None, []
    if n > CELLS_FROM and set(space) <= TREE_PARAMS:
        cells = _cells_of(whole, part, label, n)
    if cells is None:
        held = [spread(d.select("features", label)).persist() for d in (train, valid)]

    def fit(trial: int, budget: int) -> float:
        gbt = GBTClassifier(labelCol=label, featuresCol="features", seed=42, maxIter=budget, **drawn[trial])
        return float(ev.evaluate(gbt.fit(held[0]).transform(held[1])))

    try:
        at_once = 1 if held and held[0].count() > SIDE_BY_SIDE_ROWS else parallelism
        for rung, budget in enumerate(budgets):
            if cells is not None:
                got = _areas(spark, cells, {t: drawn[t] | {"maxIter": budget} for t in alive}, parallelism)
            else:
                with ThreadPool(at_once) as pool:
                    got = dict(zip(alive, pool.map(inheritable_thread_target(lambda t, b=budget: fit(t, b)), alive)))
            best = sorted(alive, key=lambda t: (-got[t], t))
            stay = best[:max(1, int(np.ceil(len(best) * keep)))] if rung + 1 < len(budgets) else best[:1]
            rows += [(rung, budget, t, json.dumps(drawn[t], sort_keys=True), got[t], t in stay) for t in alive]
            alive = sorted(stay)
    finally:
        for d in held:
            d.unpersist()
    return spark.createDataFrame(rows, "rung int, budget int, trial int, params string, area_under_pr double, stays boolean")


def fit_baselines(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Logistic regression and a plain forest (100 trees, depth 6)."""
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC")
    lr = LogisticRegression(labelCol=label, featuresCol="features", maxIter=50).fit(train)
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=100, maxDepth=6, seed=42).fit(train)
    rows = [("logistic_regression", ev.evaluate(lr.transform(test))), ("random_forest", ev.evaluate(rf.transform(test)))]
    return train.sparkSession.createDataFrame(rows, "model string, roc_auc double")
