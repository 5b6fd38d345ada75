"""Classifiers and the linear anomaly detector on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertloom.operators import boosting, forests
from alertloom.operators.distribution import calibrate_threshold, score_anomalies
from alertloom.operators.metrics import weighted_f1
from alertloom.params import (
    BOOSTED_DEPTHS,
    BOOSTED_ITERATIONS,
    BOTTLENECK_LEAST,
    BOTTLENECK_SHARE,
    DEFAULTS,
    FOREST_DEPTHS,
    FOREST_TREES,
    LABEL_COL,
    NORMAL,
)
from alertloom.session import scratch_path, shared_dir


#: Rows of a partition while trees grow, least and most: every level of every tree is a job of its own.
LEAST_TASK_ROWS, MOST_TASK_ROWS = 20_000, 200_000
#: The same for forests, most: every partition sends its counts for every node of every tree, however few its rows.
FOREST_TASK_ROWS = 400_000
#: Rows up to which the engine grows forests; beyond, sending those counts takes most of its time, and tasks grow whole trees.
ENGINE_FOREST_ROWS = 100_000


def task_count(rows: int, fits: int, cores: int, most: int = MOST_TASK_ROWS) -> int:
    """Partitions that fill the cores while ``fits`` run side by side, within the least and most rows of one."""
    fill = min(-(-cores // fits), -(-rows // LEAST_TASK_ROWS))
    return max(1, fill, -(-rows // most))


def _few_tasks(df: DataFrame, fits: int, most: int = MOST_TASK_ROWS) -> DataFrame:
    return df.repartition(task_count(df.count(), fits, df.sparkSession.sparkContext.defaultParallelism, most))


def _forest(trees: int, depth: int, seed: int, weight: str | None) -> RandomForestClassifier:
    rf = RandomForestClassifier(featuresCol="features", labelCol="label", seed=seed, numTrees=trees, maxDepth=depth, cacheNodeIds=True)
    return rf.setWeightCol(weight) if weight else rf


def forest_nodes(model: RandomForestClassificationModel, depths: Sequence[int]) -> dict[str, np.ndarray]:
    """The nodes of all trees as arrays, for walks in blocks of rows.

    ``feature``, ``threshold``, ``left`` and ``right`` (a leaf leads to itself), ``chance`` (class shares), ``root`` by tree;
    ``category`` is the row of ``goes_left`` for splits on categories, else -1. ``end[j]`` holds, for nodes down to
    ``depths[j]``, the leaf a row there ends in when trees stop at that depth and, as the fit does, two leaves of one
    class merge into their parent.
    """
    spark = SparkSession.active()
    path = scratch_path(spark, "nodes")
    model.write().save(path)
    return stored_nodes(spark.read.parquet(f"{path}/data"), depths)


def stored_nodes(data: DataFrame, depths: Sequence[int]) -> dict[str, np.ndarray]:
    """The same from a model's stored nodes."""
    split = F.col("split.leftCategoriesOrThreshold")
    table = data.select("treeID", "nodeData.*").select(
        "treeID", "id", "prediction", "impurityStats", "leftChild", "rightChild", "split.featureIndex", "split.numCategories", split.alias("at")
    ).toArrow()
    table = table.sort_by([("treeID", "ascending"), ("id", "ascending")])
    column = lambda name: table[name].to_numpy()
    here = np.arange(table.num_rows)
    root = np.flatnonzero(column("id") == 0)
    start = root[column("treeID")]
    inner = column("leftChild") >= 0
    left = np.where(inner, start + column("leftChild"), here)
    right = np.where(inner, start + column("rightChild"), here)
    stats = np.asarray(table["impurityStats"].combine_chunks().flatten()).reshape(len(here), -1)
    total = stats.sum(axis=1, keepdims=True)
    chance = np.divide(stats, total, out=np.zeros_like(stats), where=total != 0)
    at, arity = table["at"].to_pylist(), column("numCategories")
    by_category = np.flatnonzero(inner & (arity >= 0))
    category = np.full(len(here), -1)
    category[by_category] = np.arange(len(by_category))
    goes_left = np.zeros((len(by_category), max([1, *arity[by_category]])), bool)
    for k, node in enumerate(by_category):
        goes_left[k, np.asarray(at[node], int)] = True
    threshold = np.array([v[0] if i and c < 0 else np.inf for v, i, c in zip(at, inner, arity, strict=True)])

    levels = [root]
    while len(levels[-1]):
        grown = levels[-1][inner[levels[-1]]]
        levels.append(np.concatenate([left[grown], right[grown]]))
    end = np.tile(here, (len(depths), 1))
    for j, depth in enumerate(depths):
        kept = levels[: depth + 1]
        leaf, said = ~inner, column("prediction").copy()
        leaf[kept[-1]] = True
        for level in reversed(kept[:-1]):
            merged = level[~leaf[level] & leaf[left[level]] & leaf[right[level]] & (said[left[level]] == said[right[level]])]
            leaf[merged], said[merged] = True, said[left[merged]]
        for level in kept[:-1]:
            cut = level[leaf[end[j][level]] & inner[level]]
            end[j][left[cut]] = end[j][right[cut]] = end[j][cut]
    feature = np.where(inner, column("featureIndex"), 0)
    return {
        "feature": feature, "threshold": threshold, "left": left, "right": right, "chance": chance, "root": root,
        "category": category, "goes_left": goes_left, "end": end,
    }


def smaller_forest_counts(
    model: RandomForestClassificationModel, df: DataFrame, trees: Sequence[int], depths: Sequence[int]
) -> DataFrame:
    """Confusion counts on ``df`` of the forest's first ``trees`` trees, cut at ``depths``, for all pairs in one pass.

    Columns ``trees``, ``depth``, ``label``, ``prediction``, ``n``. Votes are added up tree by tree, as the model does.
    """
    return _vote_counts(forest_nodes(model, sorted(set(depths))), model.numClasses, df, trees, depths)


def _vote_counts(
    nodes: dict[str, np.ndarray], classes: int, df: DataFrame, trees: Sequence[int], depths: Sequence[int]
) -> DataFrame:
    steps = sorted(set(depths))
    sizes = set(trees)
    nodes = df.sparkSession.sparkContext.broadcast(nodes)

    def count(batches):
        f = nodes.value
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False).astype(int)
            rows = np.arange(len(label))
            x = np.asarray(batch.column(1).flatten(), np.float64).reshape(len(label), -1)
            votes = np.zeros((len(steps), len(label), classes))
            found = []
            for t in range(max(sizes)):
                node = np.full(len(label), f["root"][t])
                for depth in range(1, steps[-1] + 1):
                    value = x[rows, f["feature"][node]]
                    down = value <= f["threshold"][node]
                    if len(f["goes_left"]):
                        kind = f["category"][node]
                        known = kind >= 0
                        down[known] = f["goes_left"][kind[known], value[known].astype(int)]
                    node = np.where(down, f["left"][node], f["right"][node])
                    if depth in steps:
                        j = steps.index(depth)
                        votes[j] += f["chance"][f["end"][j][node]]
                if t + 1 in sizes:
                    for j, depth in enumerate(steps):
                        pairs, n = np.unique(np.stack([label, votes[j].argmax(axis=1)]), axis=1, return_counts=True)
                        found += [(t + 1, depth, a, b, c) for a, b, c in zip(*pairs.tolist(), n.tolist(), strict=True)]
            names = ["trees", "depth", "label", "prediction", "n"]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*found, strict=True)] or [pa.array([], pa.int64())] * 5, names)

    rows = df.select("label", vector_to_array("features").alias("features"))
    counts = rows.mapInArrow(count, "trees long, depth long, label long, prediction long, n long")
    return counts.groupBy("trees", "depth", "label", "prediction").agg(F.sum("n").alias("n"))


def search_random_forest(
    train: DataFrame,
    trees: Sequence[int] = FOREST_TREES,
    depths: Sequence[int] = FOREST_DEPTHS,
    folds: int = DEFAULTS.rf_folds,
    seed: int = DEFAULTS.seed,
    parallelism: int = DEFAULTS.cv_parallelism,
    weight: str | None = "class_weight",
    fold_col: str | None = None,
) -> dict[tuple[int, int], float]:
    """Mean weighted F1 over the folds of every (trees, depth).

    One forest is grown per fold, with the most trees and levels. Trees do not depend on each other, so its first ones
    are a forest of fewer trees; a node's split does not depend on what grows below it, so trees cut at a level are trees
    of that depth. All grid points are scored on the rows held out, in one pass. Of more than ``ENGINE_FOREST_ROWS`` rows,
    tasks grow whole trees (``forests``).
    """
    shared_dir(train.sparkSession)  # node ids kept for long tree growth are checkpointed there
    fold = F.col(fold_col) if fold_col else F.floor(F.rand(seed) * folds)
    labelled = train.select("label", "features", *([weight] if weight else []), fold.cast("int").alias("_fold"))
    scores = _search_forest_by_tasks(labelled, trees, depths, folds, seed, weight)
    if scores is not None:
        return scores
    rows = _few_tasks(labelled, parallelism, FOREST_TASK_ROWS).persist()

    def score(k: int) -> list[tuple[tuple[int, int], float]]:
        grown = _forest(max(trees), max(depths), seed, weight).fit(rows.filter(F.col("_fold") != k))
        counts = smaller_forest_counts(grown, rows.filter(F.col("_fold") == k), trees, depths)
        found = [((r.trees, r.depth), r.f1) for r in weighted_f1(counts, grown.numClasses, ["trees", "depth"]).collect()]
        if not found:
            raise ValueError(f"fold {k} has no rows")
        return found

    try:
        with ThreadPool(parallelism) as pool:
            jobs = pool.imap_unordered(inheritable_thread_target(train.sparkSession)(score), range(folds))
            found = [pair for pairs in jobs for pair in pairs]
    finally:
        rows.unpersist()
    return _mean_scores(found, trees, depths, folds)


def _mean_scores(found, trees: Sequence[int], depths: Sequence[int], folds: int) -> dict[tuple[int, int], float]:
    return {(n, depth): sum(sorted(v for key, v in found if key == (n, depth))) / folds for n in trees for depth in depths}


def _task_rows(labelled: DataFrame, weight: str | None) -> DataFrame | None:
    """Rows for forests grown by tasks; none if they are few or have features split by category."""
    if _categories(labelled) or labelled.count() <= ENGINE_FOREST_ROWS:
        return None
    by_weight = F.col(weight).cast("double") if weight else F.lit(1.0)
    return _few_tasks(labelled.select("label", "features", "_fold", by_weight.alias("_weight")), 1).persist()


def _classes(df: DataFrame, top: float) -> int:
    """Classes by the label's attributes, or up to the greatest index."""
    return max(int(top) + 1, len(df.schema["label"].metadata.get("ml_attr", {}).get("vals", [])))


def _tree_jobs(spark: SparkSession, parts: Sequence[int], trees: int) -> list[forests.Trees]:
    """The trees of all parts in about two tasks a core."""
    each = -(-trees // -(-2 * spark.sparkContext.defaultParallelism // len(parts)))
    return [forests.Trees(part, t, min(t + each, trees)) for part in parts for t in range(0, trees, each)]


def _search_forest_by_tasks(
    labelled: DataFrame, trees: Sequence[int], depths: Sequence[int], folds: int, seed: int, weight: str | None
) -> dict[tuple[int, int], float] | None:
    """The search with trees grown by a task each; none where the engine is to do it."""
    rows = _task_rows(labelled, weight)
    if rows is None:
        return None
    try:
        size = {r._fold: (r.n, r.top) for r in rows.groupBy("_fold").agg(F.count("*").alias("n"), F.max("label").alias("top")).collect() if r._fold is not None}
        for k in range(folds):
            if k not in size:
                raise ValueError(f"fold {k} has no rows")
        parts = {k: sum(n for other, (n, _) in size.items() if other != k) for k in range(folds)}
        if not all(parts.values()):
            raise ValueError("all rows are in one fold")
        bins = boosting.part_bins(rows, parts, seed)
        if not forests.fits_a_task(bins, parts):
            return None
        spark = labelled.sparkSession
        classes = _classes(labelled, max(top for _, top in size.values()))
        jobs = _tree_jobs(spark, list(parts), max(trees))
        path = forests.stored(forests.grow(rows, bins, jobs, classes, max(depths), seed), scratch_path(spark, "trees"))
        found = []
        for k in range(folds):
            nodes = stored_nodes(spark.read.parquet(f"{path}/part={k}"), sorted(set(depths)))
            counts = _vote_counts(nodes, classes, rows.filter(F.col("_fold") == k), trees, depths)
            found += [((r.trees, r.depth), r.f1) for r in weighted_f1(counts, classes, ["trees", "depth"]).collect()]
    finally:
        rows.unpersist()
    return _mean_scores(found, trees, depths, folds)


def _fit_forest_by_tasks(
    train: DataFrame, trees: int, depth: int, seed: int, weight: str | None
) -> RandomForestClassificationModel | None:
    """The forest with trees grown by a task each; none where the engine is to do it."""
    labelled = train.select("label", "features", *([weight] if weight else []), F.lit(0).alias("_fold"))
    rows = _task_rows(labelled, weight)
    if rows is None:
        return None
    try:
        count, top = rows.agg(F.count("*"), F.max("label")).first()
        bins = boosting.part_bins(rows, {-1: count}, seed)
        if not forests.fits_a_task(bins, {-1: count}):
            return None
        spark = train.sparkSession
        classes = _classes(labelled, top)
        jobs = _tree_jobs(spark, [-1], trees)
        path = forests.stored(forests.grow(rows, bins, jobs, classes, depth, seed), scratch_path(spark, "trees"))
        width = len(bins[-1].limits)
        return forests.engine_model(spark, spark.read.parquet(path), _forest(trees, depth, seed, weight), width, classes, weight)
    finally:
        rows.unpersist()


def fit_random_forest(
    train: DataFrame,
    trees: Sequence[int] = FOREST_TREES,
    depths: Sequence[int] = FOREST_DEPTHS,
    folds: int = DEFAULTS.rf_folds,
    seed: int = DEFAULTS.seed,
    parallelism: int = DEFAULTS.cv_parallelism,
    weight: str | None = "class_weight",
    fold_col: str | None = None,
) -> RandomForestClassificationModel:
    """Weighted random forest, chosen by cross-validated weighted F1 and fitted on all rows."""
    scores = search_random_forest(train, trees, depths, folds, seed, parallelism, weight, fold_col)
    # the first of the grid on ties
    n, depth = max(scores, key=scores.__getitem__)
    grown = _fit_forest_by_tasks(train, n, depth, seed, weight)
    if grown is not None:
        return grown
    rows = _few_tasks(train.select("label", "features", *([weight] if weight else [])), 1, FOREST_TASK_ROWS).persist()
    try:
        return _forest(n, depth, seed, weight).fit(rows)
    finally:
        rows.unpersist()


def ensemble_prefix(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model of the first ``n`` trees.

    Boosting without row sampling adds tree after tree, so this is the model that
    a fit of ``n`` iterations gives.
    """
    trees, weights = model._java_obj.trees(), model.treeWeights
    gateway = SparkContext._active_spark_context._gateway
    first = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    factors = gateway.new_array(gateway.jvm.double, n)
    for k in range(n):
        first[k], factors[k] = trees[k], weights[k]
    made = GBTClassificationModel(gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(model.uid, first, factors))
    made._resetUid(model.uid)
    return made.setFeaturesCol(model.getFeaturesCol()).setRawPredictionCol(model.getRawPredictionCol())


def one_vs_rest_prefix(model: OneVsRestModel, n: int) -> OneVsRestModel:
    made = OneVsRestModel([ensemble_prefix(m, n) for m in model.models])
    return made.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


#: Classes fitted at once by one-vs-rest.
SIDE_BY_SIDE = 5


def _boosted(iterations: int, depth: int, step: float, seed: int) -> OneVsRest:
    gbt = GBTClassifier(featuresCol="features", labelCol="label", seed=seed, stepSize=step, maxIter=iterations, maxDepth=depth)
    return OneVsRest(classifier=gbt, featuresCol="features", labelCol="label", parallelism=SIDE_BY_SIDE)


def search_gbt_one_vs_rest(
    train: DataFrame,
    iterations: Sequence[int] = BOOSTED_ITERATIONS,
    depths: Sequence[int] = BOOSTED_DEPTHS,
    folds: int = DEFAULTS.gbt_folds,
    step: float = 0.1,
    seed: int = DEFAULTS.seed,
    parallelism: int = DEFAULTS.cv_parallelism,
    fold_col: str | None = None,
) -> dict[tuple[int, int], float]:
    """Mean weighted F1 over the folds of every (iterations, depth).

    One ensemble is fitted per fold, depth and class, with the most iterations;
    the shorter ones are its prefixes. All of them grow side by side, a task each
    (``boosting``), and are scored on the rows held out in one pass.
    """
    fold = F.col(fold_col) if fold_col else F.floor(F.rand(seed) * folds)
    labelled = train.select("label", "features", fold.cast("int").alias("_fold"))
    rows = _few_tasks(labelled, 1).persist()
    try:
        size = {r._fold: (r.n, r.top) for r in rows.groupBy("_fold").agg(F.count("*").alias("n"), F.max("label").alias("top")).collect() if r._fold is not None}
        rest = {k: [v for other, v in size.items() if other != k] for k in range(folds)}
        if not all(rest.values()):
            raise ValueError("all rows are in one fold")
        parts = {k: sum(n for n, _ in v) for k, v in rest.items()}
        bins = None if _categories(train) else boosting.part_bins(rows, parts, seed)
        if bins is None or not boosting.fits_a_task(bins, parts):
            return _search_boosted_by_engine(labelled, iterations, depths, folds, step, seed, parallelism)
        # the longest fits first
        fits = [
            boosting.Fit(k, c, max(iterations), depth)
            for depth in sorted(depths, reverse=True)
            for k in range(folds)
            for c in range(int(max(top for _, top in rest[k])) + 1)
        ]
        trees = boosting.grow(rows, bins, fits, step)
        counts = boosting.held_out_counts(rows, trees, fits, iterations, step)
        classes = int(max(top for _, top in size.values())) + 1
        by = ["iterations", "depth", "fold"]
        found = {(r.iterations, r.depth, r.fold): r.f1 for r in weighted_f1(counts, classes, by).collect()}
    finally:
        rows.unpersist()
    # a fold without rows scores nothing
    return {(n, depth): sum(found.get((n, depth, k), 0.0) for k in range(folds)) / folds for depth in depths for n in iterations}


def _categories(df: DataFrame) -> bool:
    """Whether ``features`` has slots that are split by category."""
    return not {"nominal", "binary"}.isdisjoint(df.schema["features"].metadata.get("ml_attr", {}).get("attrs", {}))


def _search_boosted_by_engine(
    labelled: DataFrame, iterations: Sequence[int], depths: Sequence[int], folds: int, step: float, seed: int, parallelism: int
) -> dict[tuple[int, int], float]:
    """The same by the engine's fits, for tables whose bins no task can hold and for features split by category."""
    shared_dir(labelled.sparkSession)  # long boosting is checkpointed there
    rows = _few_tasks(labelled, min(parallelism, folds * len(depths)) * SIDE_BY_SIDE).persist()
    parts = [rows.filter(F.col("_fold") != k).select("label", "features").persist() for k in range(folds)]
    evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="f1")

    def score(job: tuple[int, int]) -> list[tuple[tuple[int, int], float]]:
        k, depth = job
        longest = _boosted(max(iterations), depth, step, seed).fit(parts[k])
        held = rows.filter(F.col("_fold") == k)
        return [((n, depth), evaluator.evaluate(one_vs_rest_prefix(longest, n).transform(held))) for n in iterations]

    try:
        # the longest fits first
        jobs = [(k, depth) for depth in sorted(depths, reverse=True) for k in range(folds)]
        with ThreadPool(parallelism) as pool:
            found = [pair for pairs in pool.imap_unordered(inheritable_thread_target(labelled.sparkSession)(score), jobs) for pair in pairs]
    finally:
        for df in (*parts, rows):
            df.unpersist()
    return {(n, depth): sum(v for key, v in found if key == (n, depth)) / folds for depth in depths for n in iterations}


def fit_gbt_one_vs_rest(
    train: DataFrame,
    iterations: Sequence[int] = BOOSTED_ITERATIONS,
    depths: Sequence[int] = BOOSTED_DEPTHS,
    folds: int = DEFAULTS.gbt_folds,
    step: float = 0.1,
    seed: int = DEFAULTS.seed,
    parallelism: int = DEFAULTS.cv_parallelism,
    fold_col: str | None = None,
) -> OneVsRestModel:
    """One boosted binary classifier per class, chosen by cross-validated weighted F1 and fitted on all rows. Unweighted."""
    scores = search_gbt_one_vs_rest(train, iterations, depths, folds, step, seed, parallelism, fold_col)
    # the first of the grid on ties
    n, depth = max(scores, key=scores.__getitem__)
    return fit_boosted(train, n, depth, step, seed)


def fit_boosted(train: DataFrame, iterations: int, depth: int, step: float, seed: int) -> OneVsRestModel:
    """One-vs-rest over boosted ensembles on all rows, a task a class, or by the engine where no task can hold the bins."""
    estimator = _boosted(iterations, depth, step, seed)
    rows = _few_tasks(train.select("label", "features", F.lit(0).alias("_fold")), 1).persist()
    try:
        count, top = rows.agg(F.count("*"), F.max("label")).first()
        everything = {-1: count}
        bins = boosting.part_bins(rows, everything, seed) if count and not _categories(train) else None
        if bins is not None and boosting.fits_a_task(bins, everything):
            fits = [boosting.Fit(-1, c, iterations, depth) for c in range(int(top) + 1)]
            trees = boosting.grow(rows, bins, fits, step)
            made = boosting.engine_models(train.sparkSession, trees, estimator.getClassifier(), len(bins[-1].limits))
            return estimator._copyValues(OneVsRestModel(made))
    finally:
        rows.unpersist()
    rows = _few_tasks(train.select("label", "features"), SIDE_BY_SIDE).persist()
    try:
        return estimator.fit(rows)
    finally:
        rows.unpersist()


def with_confidence(scored: DataFrame) -> DataFrame:
    """``confidence``: per class, the forest's probability, or for one-vs-rest boosting that of the class's own model."""
    if "probability" in scored.columns:
        return scored.withColumn("confidence", vector_to_array("probability"))
    # the boosted classifier's own link: logistic in twice the margin
    return scored.withColumn("confidence", F.transform(vector_to_array("rawPrediction"), lambda m: 1 / (1 + F.exp(-2 * m))))


def feature_importance(model, transformed: DataFrame, features: str = "features_raw", top: int = 20) -> DataFrame:
    """Importance per source column: the slots of a one-hot block are added up.

    Slot names come from the vector attributes, so blocks are matched by name
    and not by position.
    """
    attrs = transformed.schema[features].metadata["ml_attr"]["attrs"]
    slots = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    totals: dict[str, float] = {}
    for i, value in enumerate(model.featureImportances.toArray()):
        source = slots[i].split("_ohe_")[0] if "_ohe_" in slots[i] else slots[i]
        totals[source] = totals.get(source, 0.0) + float(value)
    table = transformed.sparkSession.createDataFrame(list(totals.items()), "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top)


# --- linear reconstruction detector ---------------------------------------------------


def components_for(n_features: int) -> int:
    """Width of the bottleneck."""
    return max(n_features // BOTTLENECK_SHARE, BOTTLENECK_LEAST)


def fit_pca_detector(train: DataFrame, k: int | None = None, label: str = LABEL_COL) -> PipelineModel:
    """Principal components of the normal rows, centered on their mean.

    This is the linear counterpart of a reconstruction network with a bottleneck
    of ``k`` units.
    """
    if k is None:
        k = components_for(train.select(F.size(vector_to_array("features"))).first()[0])
    center = StandardScaler(inputCol="features", outputCol="centered", withMean=True, withStd=False)
    pca = PCA(k=k, inputCol="centered", outputCol="projected")
    return Pipeline(stages=[center, pca]).fit(train.filter(F.col(label) == NORMAL))


def reconstruction_error(model: PipelineModel, df: DataFrame, features: str = "features") -> DataFrame:
    """Mean squared reconstruction error per row as ``mse``.

    Rows come as Arrow batches and are projected on the components and back as
    blocks. Residuals are taken slot by slot, as a difference of squared lengths
    would lose its digits when the reconstruction is good. The mean and the
    components depend on the features alone. A null vector gives a null error.
    """
    mean, components = model.stages[0].mean.toArray(), model.stages[1].pc.toArray()

    @F.arrow_udf("double")
    def error(rows: pa.Array) -> pa.Array:
        valid = np.asarray(rows.is_valid())
        x = np.asarray(rows.flatten(), np.float64).reshape(-1, len(mean)) - mean
        out = np.zeros(len(rows))
        out[valid] = ((x - x @ components @ components.T) ** 2).mean(axis=1)
        return pa.array(out, mask=~valid)

    return df.withColumn("mse", error(vector_to_array(features)))


def fit_anomaly_detector(train: DataFrame, val: DataFrame, k: int | None = None, label: str = LABEL_COL):
    """(model, one row ``threshold, max_error``): fitted on normal training rows, calibrated on validation rows."""
    model = fit_pca_detector(train, k, label)
    return model, calibrate_threshold(reconstruction_error(model, val), "mse", label)


def anomaly_scores(model: PipelineModel, df: DataFrame, calibration: DataFrame) -> DataFrame:
    return score_anomalies(reconstruction_error(model, df), calibration)
