"""Boosting and ranks at size: how often rows are written, moved and fitted, and that results stay those of Spark's trees."""
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.sql import functions as F

from fraudlens.operators import boosting as B
from fraudlens.operators import models as M
from fraudlens.operators import profile as G


def _rows(spark, n, seed=7):
    rng = np.random.default_rng(seed)
    x, z = rng.normal(size=n).round(3), rng.integers(0, 5, n)
    y = ((x > 0.3) ^ (z > 3) ^ (rng.random(n) < 0.1)).astype(float)
    rows = [(i, float(x[i]), int(z[i]), float(y[i]), 3.0 if y[i] else 1.0) for i in range(n)]
    return spark.createDataFrame(rows, "transaction_id bigint, x double, z int, is_fraud double, weight double")


def test_adaboost_writes_rows_once_and_grows_the_trees_of_spark(spark, monkeypatch):
    t = _rows(spark, 600)
    written = []
    monkeypatch.setattr(B, "materialize", lambda df, name="table", keep=B.materialize: written.append(name) or keep(df, name))
    model = M.adaboost(t, ["x", "z"], rounds=8)
    assert written == ["boost"]
    data, alphas = M.assembler(["x", "z"]).transform(t).withColumn("_w", F.lit(1.0)).cache(), []
    for tree, alpha in zip(model["stumps"], model["alphas"]):
        m = DecisionTreeClassifier(labelCol="is_fraud", featuresCol="features", weightCol="_w", maxDepth=1).fit(data)
        pred = m.transform(data).select("transaction_id", "x", "z", "features", "is_fraud", "_w", "prediction")
        mine = B.walked_column(tree, [F.coalesce(F.col(c).cast("double"), F.lit(math.nan)) for c in ("x", "z")], float)
        assert pred.where(mine != F.col("prediction")).count() == 0
        wrong = F.col("prediction") != F.col("is_fraud")
        e, w = pred.agg(F.sum(F.when(wrong, F.col("_w")).otherwise(0.0)), F.sum("_w")).first()
        alphas.append(math.log((w - e) / e))
        assert alphas[-1] == pytest.approx(alpha, abs=1e-9)
        data = pred.withColumn("_w", F.when(wrong, F.col("_w") * (w - e) / e).otherwise(F.col("_w"))).drop("prediction").localCheckpoint()
    scored = M.adaboost_score(model, t)
    assert scored.columns == ["transaction_id", "is_fraud", "prediction", "p0", "p1"]
    x = np.array([(r.x, r.z) for r in t.orderBy("transaction_id").collect()], float)
    votes = sum(a * (2 * B.walked(tree, x, "prediction") - 1) for tree, a in zip(model["stumps"], model["alphas"]))
    assert [r.prediction for r in scored.orderBy("transaction_id").collect()] == (votes > 0).astype(int).tolist()


def test_adaboost_deeper_trees_and_refused_labels(spark):
    t = spark.range(400).select(F.col("id").alias("transaction_id"), (F.col("id") % 20).alias("a"), F.floor(F.col("id") / 20).alias("b"))
    t = t.withColumn("is_fraud", ((F.col("a") < 7) & (F.col("b") >= 12)).cast("int"))
    model = M.adaboost(t, ["a", "b"], rounds=5, max_depth=2)
    assert model["alphas"] == [10.0]                               # one tree of depth 2 is enough
    assert M.adaboost_score(model, t).where("prediction <> is_fraud").count() == 0
    with pytest.raises(ValueError, match="1 rows with a missing"):
        M.adaboost(t.withColumn("a", F.when(F.col("transaction_id") > 0, F.col("a"))), ["a", "b"], rounds=1)
    with pytest.raises(ValueError, match="20 rows without a class number"):
        M.adaboost(t.withColumn("is_fraud", F.when(F.col("a") > 0, F.col("is_fraud"))), ["a", "b"], rounds=1)


def test_gbt_fits_a_row_for_each_bin_vector_and_label(spark, monkeypatch):
    t = _rows(spark, 900)
    fitted = []
    monkeypatch.setattr(GBTClassifier, "_fit", lambda self, df, keep=GBTClassifier._fit: fitted.append(df.count()) or keep(self, df))
    got = M.score(M.fit(M.build_pipeline(["x", "z"], M.make_classifier("gbt", maxIter=5, maxDepth=3)), t), t)
    assert fitted[0] < 900
    plain = Pipeline(stages=[M.assembler(["x", "z"]), GBTClassifier(labelCol="is_fraud", featuresCol="features", weightCol="weight", maxIter=5, maxDepth=3)])
    want = M.score(plain.fit(t), t)
    both = got.alias("g").join(want.alias("w"), "transaction_id").select(F.max(F.abs(F.col("g.p1") - F.col("w.p1"))).alias("d"))
    assert both.first().d < 1e-9
    # above the sample's size the rows of the fit are bounded by the bins
    fitted.clear()
    monkeypatch.setattr(B, "SAMPLE_ROWS", 64)
    M.fit(M.build_pipeline(["x", "z"], M.make_classifier("gbt", maxIter=2, maxBins=8)), _rows(spark, 3000))
    assert fitted == [n for n in fitted if n <= 8 * 8 * 2]
    # where single rows count, they stay single; a grid's bins reach the binning
    fitted.clear()
    clf = M.make_classifier("gbt", maxIter=2, minInstancesPerNode=5)
    pipe = M.build_pipeline(["x", "z"], clf)
    M.fit(pipe, t)
    assert fitted == [900] and pipe.copy({clf.maxBins: 16}).getStages()[0].bins == 16


def test_few_valued_columns_are_ranked_without_moving_rows(spark):
    t = spark.range(200).select((F.col("id") % 7).alias("a"), (F.col("id") % 3).alias("b"), F.lit(4).alias("k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "SortMergeJoin" not in G.with_average_ranks(t, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
        few = {tuple(r) for r in G.spearman_pairs(t, ["a", "b", "k"]).collect()}
        G.FEW_VALUES, keep = 2, G.FEW_VALUES
        try:
            assert {tuple(r) for r in G.spearman_pairs(t, ["a", "b", "k"]).collect()} == few
        finally:
            G.FEW_VALUES = keep
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    p = t.toPandas()[["a", "b"]].corr("spearman").loc["a", "b"]
    got = {(r[0], r[1]): r[2] for r in few}
    assert got[("a", "b")] == pytest.approx(p, abs=1e-4) and got[("a", "k")] is None and got[("b", "k")] is None
