"""F13's forest over binned rows: how often it reads its rows, and that it grows the trees of Spark's forest."""
import math

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from fraudlens.operators import forest as FO
from fraudlens.operators import models as M


def _rows(spark, n, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=(n, 3)), rng.integers(0, 3, n)])
    y = (x[:, 0] + 0.6 * x[:, 1] + rng.normal(size=n) > 0).astype(int) + ((x[:, 3] > 1) & (x[:, 2] > 0.4))
    return spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, d double, is_fraud double")


def test_rows_are_read_a_few_times_whatever_the_number_of_trees(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b
    t = spark.range(500).select((F.col("id") % 2).cast("double").alias("is_fraud"), ((F.col("id") % 2) * 3 + F.rand(1)).alias("good"),
                                F.rand(2).alias("noise"))
    assert M.select_by_forest(t.mapInArrow(counted, t.schema), ["noise", "good"], num_trees=330) == ["good"]
    assert read.value <= 4 * 500


def test_importances_are_those_of_sparks_forest(spark, monkeypatch):
    df = M.assembler(list("abcd")).transform(_rows(spark, 2500)).cache()
    kw = dict(labelCol="is_fraud", featuresCol="features", maxDepth=3, featureSubsetStrategy="2", numTrees=150)

    def mean(forests):
        return np.mean([t.featureImportances.toArray() for f in forests for t in f.trees], 0)
    want = mean([RandomForestClassifier(seed=5, **kw).fit(df)])
    table = FO.binned(df, "features", 4, "is_fraud", 2)
    assert len(table.cuts) == 1 and np.abs(mean([FO.RandomForestClassifier(seed=s, **kw).fit(table.rows(s)) for s in (0, 1)]) - want).max() < 0.06
    # chunks cut small, and a sample for the thresholds of each part
    monkeypatch.setattr(FO, "CHUNK_ROWS", 100)
    monkeypatch.setattr(FO, "SAMPLE_ROWS", 1100)
    monkeypatch.setattr(FO, "NODE_CELLS", 1 << 12)
    table = FO.binned(df, "features", 4, "is_fraud", 2)
    chunks = table.rows(1).collect()
    assert len(table.cuts) == 2 and not np.array_equal(table.cuts[0][0], table.cuts[1][0])
    assert sum(len(r.features) for r in chunks) == 2500 * 4 * 2 and {r.is_fraud for r in chunks} == {0, 1, 2}
    assert len({r.chunk for r in chunks}) == len(chunks) and max(len(r.features) for r in chunks) == 100 * 4 * 2
    assert np.abs(mean([FO.RandomForestClassifier(seed=s, **kw).fit(table.rows(s)) for s in (0, 1)]) - want).max() < 0.06
    one = [FO.RandomForestClassifier(seed=9, **kw).fit(r) for r in (table.rows(0), table.rows(0).repartition(3))]
    assert (mean(one[:1]) == mean(one[1:])).all()                    # draws follow from the chunk, not from its task


def test_leaves_of_one_prediction_are_one_leaf_as_in_sparks_trees(spark):
    t = spark.range(2000).select((F.col("id") % 50 == 0).cast("double").alias("is_fraud"), (F.col("id") % 10).cast("double").alias("x"),
                                 (F.col("id") % 7).cast("double").alias("z"))
    df = M.assembler(["x", "z"]).transform(t)
    kw = dict(labelCol="is_fraud", featuresCol="features", maxDepth=2, numTrees=20, featureSubsetStrategy="2", seed=1)
    assert RandomForestClassifier(**kw).fit(df).featureImportances.toArray().sum() == 0
    forest = FO.RandomForestClassifier(**kw).fit(FO.binned(df, "features", 2, "is_fraud").rows(0))
    assert all(tree.featureImportances.toArray().sum() == 0 and tree.root["gain"] > 0 for tree in forest.trees)
    assert M.select_by_forest(t, ["x", "z"], num_trees=20) == ["x", "z"]


def test_draws_are_poisson_and_follow_from_the_chunk():
    d = FO.draws(7, 3 << 32, 50, 4001)
    assert (d == FO.draws(7, 3 << 32, 50, 4001)).all() and (d != FO.draws(7, 1, 50, 4001)).any()
    for k in range(8):
        p = math.exp(-1) / math.factorial(k)
        assert abs((d == k).mean() - p) < 6 * math.sqrt(p / d.size)
    assert abs(np.corrcoef(d[0], d[1])[0, 1]) < 0.1


def test_odd_rows_are_refused_and_constant_features_are_kept(spark):
    t = _rows(spark, 60)
    cols = list("abcd")
    with pytest.raises(ValueError, match="0 rows without a class number, 1 rows with a missing"):
        M.select_by_forest(t.union(spark.sql("SELECT 1D, CAST(NULL AS DOUBLE), 1D, 1D, 1D")), cols, num_trees=5)
    with pytest.raises(ValueError, match="2 rows without a class number, 0 rows"):
        M.select_by_forest(t.union(spark.sql("SELECT 1D, 1D, 1D, 1D, 0.5D")).union(spark.sql("SELECT 1D, 1D, 1D, 1D, CAST(NULL AS DOUBLE)")), cols, num_trees=5)
    with pytest.raises(ValueError, match="no rows"):
        M.select_by_forest(t.limit(0), cols, num_trees=5)
    same = t.select(*[F.lit(1.0).alias(c) for c in "abcd"], "is_fraud")
    assert M.select_by_forest(same, cols, num_trees=5) == cols
    with pytest.raises(ValueError, match="minInfoGain"):
        FO.RandomForestClassifier(labelCol="is_fraud", minInfoGain=0.1).fit(FO.binned(M.assembler(cols).transform(t), "features", 4, "is_fraud").rows(0))
