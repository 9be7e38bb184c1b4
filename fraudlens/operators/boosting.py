"""What boosted trees need of a table of any size: thresholds from a bounded sample, sums from one pass.

The candidate thresholds of a feature are found as Spark's trees find them, on all rows or, of larger tables, on a
random sample of ``SAMPLE_ROWS``.  AdaBoost grows a level of a tree from the weighted class sums of every (node,
feature, bin): one pass, of which a few numbers come to the driver; a row's weight follows from the trees so far, so no
weights are stored.  Gradient boosting sees a row only through its bins and label, so rows equal in both are one
weighted row of its fit.
"""
from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Bucketizer, SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.session import materialize

#: Rows that thresholds are taken from, or bins * bins if that is more (the figures of Spark's trees).
SAMPLE_ROWS = 10_000


def sampled(df: DataFrame, rows: int, bins: int, seed: int = 42) -> tuple[np.ndarray, bool]:
    """All-double ``df`` of ``rows`` rows as a matrix, and whether it is all of it; else a random sample."""
    most = max(bins * bins, SAMPLE_ROWS)
    whole = rows <= most
    got = (df if whole else df.sample(most / rows, seed)).toArrow()
    return np.column_stack([np.asarray(c.to_numpy(), np.float64) for c in got.columns]), whole


def thresholds(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` points between neighbouring distinct values: all, or those that part the weight evenly."""
    v, of = np.unique(values, return_inverse=True)
    at = range(1, len(v))
    if len(v) - 1 > most:
        done = np.cumsum(np.bincount(of, weights, len(v)))
        stride = target = done[-1] / (most + 1)
        at = []
        for i in range(1, len(v)):
            if abs(done[i - 1] - target) < abs(done[i] - target):
                at.append(i)
                target += stride
    return np.unique([(v[i - 1] + v[i]) / 2 for i in at])


# ------------------------------------------------------------------ AdaBoost

def walked(node: dict, x: np.ndarray, key: str) -> np.ndarray:
    """``key`` of the node that each row ends in, -1 where it has none."""
    if "feature" not in node:
        return np.full(len(x), node.get(key, -1), np.int64)
    return np.where(x[:, node["feature"]] <= node["threshold"], walked(node["left"], x, key), walked(node["right"], x, key))


def walked_column(node: dict, cols: list, leaf):
    """The column ``leaf(prediction)`` of the leaf that a row ends in."""
    if "feature" not in node:
        return F.lit(leaf(node["prediction"]))
    return F.when(cols[node["feature"]] <= F.lit(node["threshold"]), walked_column(node["left"], cols, leaf)).otherwise(
        walked_column(node["right"], cols, leaf))


def row_weights(x: np.ndarray, y: np.ndarray, trees: list, alphas: list, scale: float) -> np.ndarray:
    log = np.full(len(x), -scale)
    for tree, a in zip(trees, alphas):
        log += a * (walked(tree, x, "prediction") != y)
    return np.exp(log)


def _class_sums(data: DataFrame, tree: dict, n_open: int, cuts: list, classes: int, trees: list, alphas: list, scale: float) -> np.ndarray:
    """Weight by (open node, feature, bin, class): one pass over ``data`` (the features, then the label)."""
    p, bins = len(cuts), max(len(c) for c in cuts) + 1
    size = n_open * p * bins * classes

    def run(batches):
        sums = np.zeros(size)
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns])
            x, y = x[:, :-1], x[:, -1].astype(np.int64)
            node = walked(tree, x, "open")
            some = node >= 0
            x, y, node = x[some], y[some], node[some]
            w = row_weights(x, y, trees, alphas, scale)
            for f in range(p):
                slot = ((node * p + f) * bins + np.searchsorted(cuts[f], x[:, f])) * classes + y
                sums += np.bincount(slot, w, size)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["slot", "w"])
    out = np.zeros(size)
    for r in data.mapInArrow(run, "slot bigint, w double").groupBy("slot").agg(F.sum("w").alias("w")).collect():   # ``size`` rows at most
        out[r["slot"]] = r["w"]
    return out.reshape(n_open, p, bins, classes)


def _gini(sums: np.ndarray) -> np.ndarray:
    total = sums.sum(-1, keepdims=True)
    return 1 - ((sums / np.where(total > 0, total, 1)) ** 2).sum(-1)


def _best_split(sums: np.ndarray, cuts: list):
    """(feature, number of its threshold, class sums left, right) of the greatest Gini gain; none: None."""
    best, found = 0.0, None
    for f, c in enumerate(cuts):
        if not len(c):
            continue
        left = np.cumsum(sums[f], 0)[:len(c)]
        right = np.cumsum(sums[f][::-1], 0)[::-1][1:len(c) + 1]
        lw, rw = left.sum(-1), right.sum(-1)
        total = lw + rw
        gain = _gini(left + right) - lw / total * _gini(left) - rw / total * _gini(right)
        gain = np.where((lw > 0) & (rw > 0), gain, -1.0)
        i = int(gain.argmax())
        if gain[i] > best:
            best, found = gain[i], (f, i, left[i], right[i])
    return found


def boosted_tree(data: DataFrame, sample: np.ndarray, classes: int, max_depth: int, bins: int, trees: list, alphas: list,
                 scale: float) -> tuple[dict, float, float]:
    """The next tree, the weight of the rows that it predicts wrong, and the weight of all rows."""
    w = row_weights(sample[:, :-1], sample[:, -1], trees, alphas, scale)
    cuts = [thresholds(sample[:, f], w, bins - 1) for f in range(sample.shape[1] - 1)]
    root = {"open": 0}
    growing, leaves = [root], []
    for _ in range(max_depth):
        sums = _class_sums(data, root, len(growing), cuts, classes, trees, alphas, scale)
        after = []
        for node, s in zip(growing, sums):
            node.pop("open")
            node["sums"] = s[0].sum(0)
            split = _best_split(s, cuts)
            if split is None:
                leaves.append(node)
                continue
            f, i, left, right = split
            node.update(feature=f, threshold=float(cuts[f][i]), left={"sums": left}, right={"sums": right})
            after += [node["left"], node["right"]]
        for k, node in enumerate(after):
            node["open"] = k
        growing = after
        if not growing:
            break
    leaves += growing
    wrong = 0.0
    for node in leaves:
        node.pop("open", None)
        node["prediction"] = int(node["sums"].argmax())
        wrong += float(np.delete(node["sums"], node["prediction"]).sum())
    return root, wrong, float(root["sums"].sum())


def adaboost(train: DataFrame, feature_cols: list[str], label="is_fraud", rounds: int = 50, max_depth: int = 1, bins: int = 32):
    """M6: SAMME boosting of weighted trees of ``max_depth``.  The rows are written once to the shared checkpoint folder;
    a round is one pass for each level of its tree, which gives the tree, its error and the next total weight."""
    nan = F.lit(float("nan"))
    data = train.select(*[F.coalesce(F.col(c).cast("double"), nan).alias(f"x{i}") for i, c in enumerate(feature_cols)],
                        F.coalesce(F.col(label).cast("double"), nan).alias("y"))
    data = materialize(data, "boost")
    y = F.col("y")
    seen = data.agg(F.count(F.lit(1)).alias("n"), F.max("y").alias("most"),
                    F.count(F.when(F.isnan(y) | (y < 0) | (y != F.floor(y)), 1)).alias("bad"),
                    F.count(F.when(~reduce(Column.__and__, [F.abs(f"x{i}") < math.inf for i in range(len(feature_cols))]), 1)).alias("open")).first()
    if not seen["n"]:
        raise ValueError("no rows to fit")
    if seen["bad"] or seen["open"]:
        raise ValueError(f"{seen['bad']} rows without a class number, {seen['open']} rows with a missing or infinite feature")
    sample, _ = sampled(data, seen["n"], bins)
    stumps, alphas, scale = [], [], 0.0
    for _ in range(rounds):
        tree, wrong, total = boosted_tree(data, sample, max(int(seen["most"]) + 1, 2), max_depth, bins, stumps, alphas, scale)
        err = wrong / total if total else 0.5
        if err <= 0:
            stumps.append(tree)
            alphas.append(10.0)
            break
        if err >= 0.5:
            break
        up = (1 - err) / err
        stumps.append(tree)
        alphas.append(math.log(up))
        scale += math.log(wrong * up + (total - wrong))
    return {"features": list(feature_cols), "stumps": stumps, "alphas": alphas}


def adaboost_score(model, df: DataFrame, keep=("transaction_id", "is_fraud")) -> DataFrame:
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in model["features"]]
    margin = F.lit(0.0)
    for tree, a in zip(model["stumps"], model["alphas"]):
        margin = margin + walked_column(tree, cols, lambda k, a=a: a if k == 1 else -a)
    total = float(sum(model["alphas"])) or 1.0
    x = df.withColumn("_m", margin)
    p1 = 1 / (1 + F.exp(-2 * F.col("_m") / total))
    return x.select(*[c for c in keep if c in x.columns], (F.col("_m") > 0).cast("int").alias("prediction"),
                    (1 - p1).alias("p0"), p1.alias("p1"))


# ------------------------------------------------------------------ gradient boosting

class TreeBins(Estimator):
    """Bin numbers of numeric columns, as ``<column>_bin``, for the trees of ``classifier``; other columns as they are.

    Up to the sample's size every two values have different bins.  A missing or infinite value stays as it is."""

    def __init__(self, cols: list[str], classifier):
        super().__init__()
        self.cols, self.uid_of, self.bins = list(cols), classifier.uid, classifier.getMaxBins()
        self.weight = classifier.getWeightCol() if classifier.isDefined(classifier.weightCol) else None

    def copy(self, extra=None):
        that = super().copy(extra)
        for param, value in (extra or {}).items():
            if param.parent == self.uid_of and param.name == "maxBins":
                that.bins = value
        return that

    def _fit(self, df: DataFrame) -> PipelineModel:
        def plain(c):
            return isinstance(df.schema[c].dataType, T.NumericType) and df.schema[c].metadata.get("ml_attr", {}).get("type") != "nominal"
        cols = [c for c in self.cols if plain(c)]
        nan = F.lit(float("nan"))
        x = df.select(*[F.coalesce(F.col(c).cast("double"), nan).alias(f"x{i}") for i, c in enumerate(cols)],
                      (F.col(self.weight).cast("double") if self.weight else F.lit(1.0)).alias("w"))
        stages = []
        if cols:
            rows, whole = sampled(x, x.count(), self.bins)
            splits = []
            for i in range(len(cols)):
                known = rows[np.isfinite(rows[:, i])]
                cuts = thresholds(known[:, i], known[:, -1], len(rows) if whole else self.bins - 1)
                cuts = np.unique(np.nextafter(cuts, np.inf))                 # a threshold itself lies in the lower bin
                splits.append([-math.inf, *(cuts.tolist() or [np.finfo(float).max]), math.inf])
            stages.append(Bucketizer(splitsArray=splits, inputCols=cols, outputCols=[f"{c}_bucket" for c in cols], handleInvalid="keep"))
        # a sum has no metadata: the trees are to take bin numbers as numbers, not as categories
        number = "IF(abs(CAST(`{0}` AS DOUBLE)) < double('Infinity'), `{0}_bucket` + 0.0D, CAST(`{0}` AS DOUBLE)) AS `{0}_bin`"
        out = [number.format(c) if c in cols else f"`{c}` AS `{c}_bin`" for c in self.cols]
        stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(out)} FROM __THIS__"))
        return PipelineModel(stages)


class GroupedGBT(GBTClassifier):
    """M5: gradient-boosted trees fitted on one row, of the summed weight, for rows of equal features and label.

    The sums that trees grow from are the same; where a parameter counts or draws single rows, they stay single."""

    def _fit(self, df: DataFrame):
        if self.getMinInstancesPerNode() > 1 or self.getSubsamplingRate() < 1 or self.isDefined(self.validationIndicatorCol):
            return super()._fit(df)
        weighted = self.isDefined(self.weightCol)
        by = [self.getFeaturesCol(), self.getLabelCol()]
        weight = F.col(self.getWeightCol()).cast("double") if weighted else F.lit(1.0)
        rows = materialize(df.groupBy(*by).agg(F.sum(weight).alias("_weight")), "grouped")
        return super(GroupedGBT, self.copy({self.weightCol: "_weight"}))._fit(rows)
