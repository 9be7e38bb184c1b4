"""Random Fourier features (M7), K-best selection and the statistics-based selection."""
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fraudlens.operators import kernel as K
from fraudlens.operators import models as M
from fraudlens.operators import prep as P


def _circle(spark, n=1500):
    rng = np.random.default_rng(5)
    xy = rng.uniform(-1, 1, (n, 2))
    inside = (xy ** 2).sum(1) < 0.5
    return spark.createDataFrame([(i, float(a), float(b), float(c), 1.0) for i, ((a, b), c) in enumerate(zip(xy, inside))],
                                 "i int, x double, y double, is_fraud double, weight double")


def _accuracy(model, rows):
    return model.transform(rows).agg(F.avg((F.col("prediction") == F.col("is_fraud")).cast("double"))).first()[0]


def test_kernel_svm_separates_a_circle(spark):
    rows = _circle(spark).cache()
    train, test = rows.where("i % 3 > 0"), rows.where("i % 3 = 0")
    clf = M.make_classifier("linear_svc", maxIter=60)
    linear = M.build_pipeline(["x", "y"], clf).fit(train)
    radial = M.build_pipeline(["x", "y"], clf, kernel=K.RandomFourierFeatures(["x", "y"], dim=128, gamma=1.0)).fit(train)
    assert _accuracy(linear, test) < 0.75 and _accuracy(radial, test) > 0.95


def test_fourier_features_near_the_kernel_saved_and_whole(spark, tmp_path):
    rows = _circle(spark, 200)
    st = K.RandomFourierFeatures(["x", "y"], dim=1024, gamma=0.7, seed=9).fit(rows)
    feats = lambda m, d: np.array([r[0] for r in m.transform(d).orderBy("i").select(vector_to_array("features")).collect()])
    z = feats(st, rows)
    x = np.array([(r.x, r.y) for r in rows.orderBy("i").collect()])
    x = (x - x.mean(0)) / x.std(0)
    exact = np.exp(-0.7 * ((x[:, None] - x[None]) ** 2).sum(2))
    assert np.abs(z @ z.T - exact).mean() < 1 / math.sqrt(1024) and np.abs(z @ z.T - exact).max() < 6 / math.sqrt(1024)
    st.write().overwrite().save(str(tmp_path / "rff"))
    assert np.allclose(feats(K.RandomFourierModel.load(str(tmp_path / "rff")), rows.repartition(7)), z)
    odd = spark.createDataFrame([(0, None, 1.0), (1, float("nan"), 1.0), (2, float("inf"), 1.0)], "i int, x double, y double")
    m = K.RandomFourierFeatures(["x", "y"], dim=8).fit(odd)      # no value at all, and a constant column
    assert np.isfinite(feats(m, odd)).all() and (feats(m, odd) == feats(m, odd)[0]).all()
    assert m.transform(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        K.RandomFourierFeatures([]).fit(odd)


def test_k_best_and_selection_pipeline(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 600)
    rows = spark.createDataFrame(
        [(float(t + 0.1 * a), float(t + 2 * b), float(c), float(2 * c), 1.0, "k", int(t)) for t, a, b, c in
         zip(y, rng.normal(size=600), rng.normal(size=600), rng.normal(size=600))],
        "strong double, weak double, noise double, twin double, same double, kind string, label int")
    num = ["strong", "weak", "noise", "twin", "same"]
    assert P.KBestFilter(num, k=2, label="label").fit(rows).fitted()["keep"] == ["strong", "weak"]
    assert P.KBestFilter(num, k=9, label="label").fit(rows).fitted()["keep"] == num
    out = Pipeline(stages=P.stats_selection_stages(num)).fit(rows).transform(rows)
    assert out.columns == ["strong", "weak", "noise", "kind", "label"]     # constant and linked columns go, others pass
    out = Pipeline(stages=P.stats_selection_stages(num, k_best=1, label="label")).fit(rows).transform(rows)
    assert out.columns == ["strong", "kind", "label"]
    gap = rows.withColumn("strong", F.when(F.col("noise") > 1, None).otherwise(F.col("strong")))
    assert P.KBestFilter(num, k=1, label="label").fit(gap).fitted()["keep"] == ["strong"]


def test_correlation_of_constant_and_pairwise_constant_columns(spark):
    from fraudlens.operators import profile as G
    rows = spark.createDataFrame([(1.0, 5.0, None, 1), (2.0, 5.0, 7.0, 3), (3.0, 5.0, 7.0, 2), (4.0, 5.0, None, 5)],
                                 "a double, same double, held double, b int")
    got = {(r.feature_1, r.feature_2): r.corr for r in G.correlation_pairs(rows).collect()}
    assert len(got) == 6 and got[("a", "b")] == round(float(np.corrcoef([1, 2, 3, 4], [1, 3, 2, 5])[0, 1]), 4)
    assert all(v is None for k, v in got.items() if k != ("a", "b"))
    assert P.PearsonCorrelationFilter(["a", "same", "held", "b"], threshold=0.5).fit(rows).fitted()["keep"] == ["a", "same", "held"]
    assert all(r.corr is None for r in G.correlation_pairs(rows.limit(0)).collect())


def test_kernel_fit_deals_rows_to_bounded_tasks(spark, monkeypatch):
    """One input partition of few bytes makes many: the classifier is fitted on tasks of bounded bytes."""
    from fraudlens.operators import resampling as R
    monkeypatch.setattr(R, "TASK_BYTES", 64 * 8 * 50)                      # 50 rows
    rows = _circle(spark, 1000).coalesce(1).cache()
    parts = []

    class Recorded(type(M.make_classifier("linear_svc"))):
        def _fit(self, df):
            parts.extend(df.rdd.glom().map(len).collect())
            return super()._fit(df)
    clf = Recorded(labelCol="is_fraud", featuresCol="features", weightCol="weight", maxIter=5)
    model = M.build_pipeline(["x", "y"], clf, kernel=K.RandomFourierFeatures(["x", "y"], dim=64)).fit(rows)
    assert sum(parts) == 1000 and max(parts) <= 60
    assert len(model.stages) == 2 and model.transform(rows).rdd.getNumPartitions() == 1


def test_radial_svm_reads_no_features_and_takes_the_steps_of_sparks_fit(spark, tmp_path, monkeypatch):
    """The fit keeps a row's few inputs: Spark's fit over the vectors, which are many times the table, is not run."""
    from pyspark.ml.classification import LinearSVC, LinearSVCModel
    rows = _circle(spark, 700).withColumn("weight", F.when(F.col("is_fraud") == 1, 2.5).otherwise(F.lit(0.5) * (F.col("i") % 4))).withColumn(
        "x", F.when(F.col("i") % 50 > 0, F.col("x"))).repartition(3).cache()
    kernel = K.RandomFourierFeatures(["x", "y"], dim=48, gamma=0.8)
    z = kernel.fit(rows).transform(rows)
    for kw in (dict(maxIter=40), dict(maxIter=12, regParam=0.05), dict(maxIter=12, regParam=0.02, standardization=False, fitIntercept=False), dict(maxIter=0)):
        want = LinearSVC(labelCol="is_fraud", weightCol="weight", **kw).fit(z)
        with monkeypatch.context() as m:
            m.setattr(LinearSVC, "_fit_java", lambda self, df: pytest.fail("fitted over the features"))
            model = M.build_pipeline(["x", "y"], M.make_classifier("linear_svc", **kw), kernel=kernel).fit(rows)
        got = model.stages[1]
        assert isinstance(got, LinearSVCModel) and got.getMaxIter() == kw["maxIter"]
        assert np.abs(got.coefficients.toArray() - want.coefficients.toArray()).max() < 1e-6 and abs(got.intercept - want.intercept) < 1e-6
    model.write().overwrite().save(str(tmp_path / "svm"))
    assert M.PipelineModel.load(str(tmp_path / "svm")).transform(rows).count() == 700
    clf = M.make_classifier("linear_svc")
    for odd, said in ((rows.withColumn("is_fraud", F.when(F.col("i") > 0, F.col("is_fraud"))), "1 rows without a label"),
                      (rows.withColumn("weight", F.when(F.col("i") < 2, -1.0).otherwise(1.0)), "2 rows without a label"),
                      (rows.where("is_fraud = 0"), "no rows of label 1")):
        with pytest.raises(ValueError, match=said):
            M.build_pipeline(["x", "y"], clf, kernel=kernel).fit(odd)


def test_half_cosine_is_exact_to_the_last_digits():
    turns = np.random.default_rng(1).normal(0, 40, 100_000)
    want = (1 + np.cos(2 * np.pi * (turns - np.rint(turns)))) / 2
    assert np.abs(K.half_cosine(turns.copy(), np.empty_like(turns)) - want).max() < 4e-15
