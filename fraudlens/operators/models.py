"""Models, tuning and scoring on ``pyspark.ml``.

The reference's scikit-learn / XGBoost estimators map to their Spark ML
family members (same role, not bit-identical numbers): trees, forests,
logistic regression, gradient-boosted trees, linear SVM; tuning is
``CrossValidator`` over a fold column with an F2 evaluator, fits are
distributed across executors and fold fits run in parallel threads.
"""
from __future__ import annotations

import itertools
import json
from enum import Enum
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.operators.boosting import GroupedGBT, TreeBins, adaboost, adaboost_score  # noqa: F401
from fraudlens.operators.forest import RandomForestClassifier, binned
from fraudlens.operators.kernel import FourierSVC
from fraudlens.operators.resampling import Dealer, ResamplingPipeline
from fraudlens.operators.sampling import stratified_folds, uniform
from fraudlens.session import materialize
from fraudlens.operators.scalar import attach

FAMILIES = {
    "decision_tree": DecisionTreeClassifier,
    "random_forest": RandomForestClassifier,
    "logistic_regression": LogisticRegression,
    "gbt": GroupedGBT,
    "linear_svc": FourierSVC,
}


class Phase(str, Enum):
    """What a job may do."""
    TRAINING = "training"
    DEPLOY = "deploy"


def require_phase(phase: Phase | str, allowed: Phase) -> None:
    if Phase(phase) != allowed:
        raise RuntimeError(f"operation only allowed in phase '{allowed.value}', not '{Phase(phase).value}'")


def assembler(feature_cols: list[str], out="features") -> VectorAssembler:
    return VectorAssembler(inputCols=feature_cols, outputCol=out, handleInvalid="keep")


def make_classifier(name: str, label="is_fraud", weight_col: str | None = "weight", **params):
    """M2-M5, M7: a Spark ML classifier of the named family (weightCol where supported)."""
    cls = FAMILIES[name]
    kw = dict(labelCol=label, featuresCol="features", **params)
    if weight_col:
        kw["weightCol"] = weight_col
    return cls(**kw)


def build_pipeline(feature_cols: list[str], classifier, prep_stages=(), selectors=(), forest=None, resampling=None,
                   kernel=None) -> Pipeline:
    """Preparation -> selectors -> ``resampling`` -> assembler -> ``forest`` selection -> classifier (all fitted
    inside each fold; a ``Resampler`` changes the rows that later stages are fitted on and no scored row).  ``kernel``, a
    stage that makes the feature vector (``RandomFourierFeatures``), takes the assembler's place; train rows are dealt
    before it to tasks of bounded bytes, and the linear SVM makes the vectors anew in every pass.  Gradient-boosted trees get bin numbers, so that equal rows are grouped in their fit."""
    if forest is not None:
        classifier = classifier.copy().setFeaturesCol(forest.output_col)
    before = [*prep_stages, *selectors]
    if isinstance(classifier, GroupedGBT) and forest is None and kernel is None:
        bins = TreeBins(feature_cols, classifier)
        classifier_rows = [bins, assembler([f"{c}_bin" for c in feature_cols]), classifier]
        return ResamplingPipeline(stages=[*before, resampling, *classifier_rows]) if resampling is not None else Pipeline(stages=[*before, *classifier_rows])
    after = [kernel or assembler(feature_cols), *([forest] if forest else []), classifier]
    rows = [resampling] if resampling is not None else []
    if kernel is not None:
        rows.append(Dealer(kernel.row_bytes()))
    if rows:
        return ResamplingPipeline(stages=[*before, *rows, *after])
    return Pipeline(stages=[*before, *after])


def f2_evaluator(label="is_fraud", beta: float = 2.0) -> MulticlassClassificationEvaluator:
    """F-beta of the positive class."""
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                             metricName="fMeasureByLabel", metricLabel=1.0, beta=beta)


def score(model, df: DataFrame, keep=("transaction_id", "is_fraud")) -> DataFrame:
    """Prediction and class probabilities (models without probabilities: prediction only)."""
    out = model.transform(df)
    cols = [c for c in keep if c in out.columns] + [F.col("prediction").cast("int").alias("prediction")]
    if "probability" in out.columns:
        arr = vector_to_array("probability")
        cols += [arr[0].alias("p0"), arr[1].alias("p1")]
    return out.select(*cols)


def dummy_scores(train: DataFrame, test: DataFrame, label="is_fraud", strategy="prior",
                 id_col="transaction_id", seed=42) -> DataFrame:
    """M1: prior = majority class with P(1) = positive share; stratified = positive
    with probability equal to the share (hash-uniform per row)."""
    share = train.agg(F.avg(F.col(label).cast("double")).alias("s"))
    x = attach(test, share)       # one-row scalar
    if strategy == "prior":
        pred = (F.col("s") > 0.5).cast("int")
        p1 = F.col("s")
    else:
        pred = (uniform(id_col, seed) < F.col("s")).cast("int")
        p1 = pred.cast("double")
    return x.select(id_col, label, pred.alias("prediction"), (1 - p1).alias("p0"), p1.alias("p1"))


# ------------------------------------------------------------------ M9 grid

def parse_grid_values(values: str, value_type: str, special_type: str | None = None) -> list:
    """M9: one config cell -> list of values.  Cells are ``|``-separated;
    ``range`` = start|stop|step, ``logspace`` = start|stop|num (base 10)."""
    parts = [p.strip() for p in str(values).split("|") if p.strip() != ""]
    if special_type == "range":
        a, b, s = (float(p) for p in parts)
        vals = list(np.arange(a, b, s))
        return [int(v) if float(v).is_integer() and value_type.endswith("int") else float(v) for v in vals]
    if special_type == "logspace":
        a, b, n = float(parts[0]), float(parts[1]), int(float(parts[2]))
        return [float(v) for v in np.logspace(a, b, n)]
    conv = {"int": int, "list[int]": int, "float": float, "list[float]": float,
            "string": str, "list[str]": str, "bool": None, "list[bool]": None}[value_type]
    if conv is None:
        out = []
        for p in parts:
            if p.lower() not in ("true", "false"):
                raise ValueError(f"not a boolean: {p!r}")
            out.append(p.lower() == "true")
        return out
    return [conv(p) for p in parts]


def param_grid(estimator, config_rows: list[dict]) -> list:
    """M9: ParamMaps for every combination of the configured values."""
    b = ParamGridBuilder()
    for r in config_rows:
        b = b.addGrid(estimator.getParam(r["parameter"]),
                      parse_grid_values(r["values"], r["value_type"], r.get("special_type")))
    return b.build()


def _typed(cells: list[str], kind: str) -> list:
    if kind == "bool":
        if bad := [c for c in cells if c.lower() not in ("true", "false")]:
            raise ValueError(f"not a boolean: {bad[0]!r}")
        return [c.lower() == "true" for c in cells]
    return [{"int": int, "float": float, "str": str}[kind](c) for c in cells]


def read_grid(spark, path: str, model_name: str) -> dict[str, list]:
    """M9: parameter -> values of one model in a grid file.

    CSV columns ``model_name, parameter, values, value_type, special_type``; ``value_type`` is ``string`` (one value),
    ``list`` (cells of ``special_type`` int, float, str or bool), ``range`` (start|stop|step, stop excluded), ``logspace``
    (first and last power of ten|number) or ``bool``.  An unknown type raises; a model without lines has no grid."""
    rows = spark.read.csv(path, header=True).where(F.col("model_name") == model_name).collect()    # a configuration file
    out = {}
    for r in rows:
        cells = [c.strip() for c in str(r["values"]).split("|")]
        kind = r["value_type"]
        if kind == "string":
            out[r["parameter"]] = [r["values"]]
        elif kind == "list":
            out[r["parameter"]] = _typed(cells, r["special_type"] or "str")
        elif kind == "range":
            out[r["parameter"]] = list(range(*map(int, cells)))
        elif kind == "logspace":
            out[r["parameter"]] = [float(v) for v in np.logspace(float(cells[0]), float(cells[1]), int(float(cells[2])))]
        elif kind == "bool":
            out[r["parameter"]] = _typed(cells, "bool")
        else:
            raise ValueError(f"unknown value_type {kind!r} of {r['parameter']}")
    return out


#: Names of grid files -> parameters of the Spark estimators (fixed values).
PARAM_NAMES = {"n_estimators": "maxIter", "max_depth": "maxDepth", "learning_rate": "stepSize", "C": "regParam", "max_iter": "maxIter",
               "min_samples_leaf": "minInstancesPerNode", "max_bins": "maxBins", "subsample": "subsamplingRate"}


def grid_of(estimator, values: dict[str, list]) -> list:
    """M9: ParamMaps for every combination of ``read_grid`` values that the estimator has a parameter for.

    ``C`` is the inverse of the regularisation strength; names that the estimator lacks raise."""
    b = ParamGridBuilder()
    for name, v in values.items():
        here = PARAM_NAMES.get(name, name)
        if here == "maxIter" and estimator.hasParam("numTrees"):
            here = "numTrees"
        if not estimator.hasParam(here):
            raise ValueError(f"{type(estimator).__name__} has no parameter for {name!r}")
        b = b.addGrid(estimator.getParam(here), [1 / x for x in v] if name == "C" else v)
    return b.build()


def grid_combinations(config_rows: list[dict]) -> list[dict]:
    vals = [(r["parameter"], parse_grid_values(r["values"], r["value_type"], r.get("special_type"))) for r in config_rows]
    return [dict(zip([v[0] for v in vals], combo)) for combo in itertools.product(*[v[1] for v in vals])]


# ------------------------------------------------------------------ M10, M11, M16

def tune(pipeline: Pipeline, grid: list, train_with_folds: DataFrame, label="is_fraud", fold_col="fold",
         parallelism: int = 4, seed: int = 42):
    """Grid search over ``fold_col`` folds with F2, refit on the best setting."""
    n = train_with_folds.agg(F.max(fold_col)).first()[0] + 1
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=f2_evaluator(label), numFolds=n,
                        foldCol=fold_col, parallelism=parallelism, seed=seed, collectSubModels=False)
    return cv.fit(train_with_folds)


def tune_repeated(pipeline: Pipeline, grid: list, train: DataFrame, label="is_fraud", k: int = 5, repeats: int = 3,
                  parallelism: int = 4, seed: int = 42):
    """M10 with repeated stratified k-fold (the reference's 5 x 3): one fold
    assignment per repeat (different hash seeds), mean F2 per setting over all
    repeats, refit of the best setting on the whole training set.
    Returns (best model, [(param map, mean score)])."""
    scores = [0.0] * len(grid)
    for r in range(repeats):
        folds = stratified_folds(train, label, k=k, seed=seed + r, name="_fold")
        cv = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=f2_evaluator(label), numFolds=k,
                            foldCol="_fold", parallelism=parallelism, seed=seed + r).fit(folds)
        scores = [a + float(b) / repeats for a, b in zip(scores, cv.avgMetrics)]
    best = max(range(len(grid)), key=lambda i: scores[i])
    return pipeline.fit(train, grid[best]), list(zip(grid, scores))


def tune_with_trace(pipeline: Pipeline, grid: list, train: DataFrame, label="is_fraud", k: int = 5, repeats: int = 3,
                    parallelism: int = 4, seed: int = 42, beta: float = 2.0) -> tuple[PipelineModel, DataFrame]:
    """Repeated stratified folds with the score of the held-out and of the fitted part of every split.

    Returns the best setting fitted on all of ``train`` and the trace: (params, mean_test_score, std_test_score,
    mean_train_score, std_train_score, rank, test_scores, train_scores), a row for each setting, ties of rank by order in
    the grid.  A repeat's folds are written once; its fits run ``parallelism`` at a time; the driver holds two numbers a fit."""
    spark, evaluator = train.sparkSession, f2_evaluator(label, beta)
    held, seen = [[] for _ in grid], [[] for _ in grid]
    for r in range(repeats):
        folds = materialize(stratified_folds(train, label, k=k, seed=seed + r, name="_fold"), "folds")

        def one(job):
            setting, fold = job
            inside, outside = folds.where(F.col("_fold") != fold).drop("_fold"), folds.where(F.col("_fold") == fold).drop("_fold")
            model = pipeline.fit(inside, grid[setting])
            return setting, float(evaluator.evaluate(model.transform(outside))), float(evaluator.evaluate(model.transform(inside)))
        with ThreadPool(parallelism) as pool:
            for setting, test, fitted in pool.map(inheritable_thread_target(spark)(one), [(s, f) for s in range(len(grid)) for f in range(k)]):
                held[setting].append(test)
                seen[setting].append(fitted)
    order = sorted(range(len(grid)), key=lambda s: (-np.mean(held[s]), s))
    rows = [(json.dumps({p.name: v for p, v in grid[s].items()}, sort_keys=True, default=str), float(np.mean(held[s])), float(np.std(held[s])),
             float(np.mean(seen[s])), float(np.std(seen[s])), order.index(s) + 1, held[s], seen[s]) for s in range(len(grid))]
    trace = spark.createDataFrame(rows, "params string, mean_test_score double, std_test_score double, mean_train_score double, "
                                        "std_train_score double, rank int, test_scores array<double>, train_scores array<double>")
    return pipeline.fit(train, grid[order[0]]), trace


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """Single fit without tuning."""
    return pipeline.fit(train)


def tuning_trace(cv_model, spark) -> DataFrame:
    """Mean and std of the score per parameter setting."""
    rows = []
    stds = getattr(cv_model, "stdMetrics", None) or [None] * len(cv_model.avgMetrics)
    for pm, m, s in zip(cv_model.getEstimatorParamMaps(), cv_model.avgMetrics, stds):
        rows.append((json.dumps({p.name: (v if isinstance(v, (int, float, str, bool)) else str(v))
                                 for p, v in pm.items()}, sort_keys=True), float(m), None if s is None else float(s)))
    return spark.createDataFrame(rows, "params string, mean_score double, std_score double")


# ------------------------------------------------------------------ F13, V6, M17

#: Trees of one forest fit: a pass draws a bootstrap count for every row of a chunk and tree.
TREES_PER_FIT = 100
#: Forest fits at a time.
FITS_AT_ONCE = 4


def _tree_importances(forest, n: int) -> np.ndarray:
    """Sum over the trees of a forest of their importances (each sums to 1, a tree without splits to 0)."""
    return sum((t.featureImportances.toArray() for t in forest.trees), np.zeros(n))


class ForestSelector(Estimator):
    """F13 as a stage: random forest importances of the assembled features; its model
    slices the vector to the features whose importance is the mean or more.  In a
    pipeline it is fitted anew on the train part of each fold.

    Rows are binned and written once.  The forest is grown over them ``TREES_PER_FIT`` trees at a time, each part with its
    own seed: its importance is the mean over all trees, and bootstrap counts take the memory of one part for one chunk of rows."""

    def __init__(self, label="is_fraud", num_trees: int = 4000, max_depth: int = 2, features_per_split: int = 3,
                 seed: int = 42, input_col="features", output_col="selected"):
        super().__init__()
        self.label, self.num_trees, self.max_depth = label, num_trees, max_depth
        self.features_per_split, self.seed = features_per_split, seed
        self.input_col, self.output_col = input_col, output_col

    def _fit(self, df: DataFrame) -> VectorSlicer:
        n = len(df.schema[self.input_col].metadata["ml_attr"]["attrs"]["numeric"])
        rf = RandomForestClassifier(labelCol=self.label, featuresCol=self.input_col, maxDepth=self.max_depth,
                                    featureSubsetStrategy=str(min(self.features_per_split, n)))
        parts = -(-self.num_trees // TREES_PER_FIT)
        table = binned(df, self.input_col, n, self.label, parts, rf.getMaxBins(), self.seed)

        def one(part):
            trees = min(TREES_PER_FIT, self.num_trees - part * TREES_PER_FIT)
            return _tree_importances(rf.copy({rf.numTrees: trees, rf.seed: self.seed + part}).fit(table.rows(part)), n)
        with ThreadPool(FITS_AT_ONCE) as pool:
            imp = sum(pool.imap(inheritable_thread_target(df.sparkSession)(one), range(parts)), np.zeros(n))
        return VectorSlicer(inputCol=self.input_col, outputCol=self.output_col,
                            indices=[int(i) for i in np.flatnonzero(imp >= imp.mean())])


def select_by_forest(train: DataFrame, feature_cols: list[str], label="is_fraud", num_trees: int = 4000,
                     max_depth: int = 2, features_per_split: int = 3, seed: int = 42) -> list[str]:
    """the features that ``ForestSelector`` keeps."""
    stage = ForestSelector(label, num_trees, max_depth, features_per_split, seed)
    return [feature_cols[i] for i in stage.fit(assembler(feature_cols).transform(train)).getIndices()]


def feature_importance(model, feature_cols: list[str], spark, top: int = 30) -> DataFrame:
    """V6: importance per feature, sorted, top ``top``."""
    imp = model.featureImportances.toArray()
    rows = sorted(((c, float(v)) for c, v in zip(feature_cols, imp)), key=lambda r: (-r[1], r[0]))[:top]
    return spark.createDataFrame(rows, "feature string, importance double")


def split_counts(model, feature_cols: list[str], spark, path: str) -> DataFrame:
    """V6: per feature, number of splits ("weight") and mean gain over all tree
    nodes, read from the saved model's node table."""
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    node = F.col("nodeData") if "nodeData" in nodes.columns else F.struct(*[F.col(c) for c in nodes.columns])
    n = nodes.select(node.getField("split").getField("featureIndex").alias("fi"), node.getField("gain").alias("gain"))
    g = n.where(F.col("fi") >= 0).groupBy("fi").agg(F.count(F.lit(1)).alias("weight"), F.avg("gain").alias("gain"))
    names = spark.createDataFrame(list(enumerate(feature_cols)), "fi int, feature string")
    return g.join(F.broadcast(names), "fi").select("feature", "weight", "gain")


def out_of_fold_scores(pipeline: Pipeline, train_with_folds: DataFrame, k: int, fold_col="fold",
                       keep=("transaction_id", "is_fraud")) -> DataFrame:
    """Every train row scored by a fit that has not seen its fold."""
    parts = [score(pipeline.fit(train_with_folds.where(F.col(fold_col) != i)),
                   train_with_folds.where(F.col(fold_col) == i), keep) for i in range(k)]
    return reduce(DataFrame.unionByName, parts)


def isotonic_calibrator(oof_scores: DataFrame, score_col="p1", label="is_fraud"):
    """Isotonic map from out-of-fold scores to calibrated probabilities."""
    return IsotonicRegression(featuresCol=score_col, labelCol=label, predictionCol="p1_calibrated").fit(
        oof_scores.select(F.col(score_col).cast("double").alias(score_col), F.col(label).cast("double").alias(label)))
