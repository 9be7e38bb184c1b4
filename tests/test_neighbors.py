"""Exact neighbours, k-NN stages and re-sampling against brute force; what they send and what they leave alone."""
import math
import tempfile

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from fraudlens.operators import knn as K
from fraudlens.operators import models as M
from fraudlens.operators import neighbors as N
from fraudlens.operators import resampling as R

COLS = ["a", "b", "c"]
SCHEMA = "transaction_id bigint, a double, b double, c double, is_fraud double, space int, cell int, q string, x string"


def frame(spark, X, y=None, parts=3):
    rows = [(i, *[None if v is None or math.isnan(v) else float(v) for v in r], float(y[i]) if y is not None else 0.0, 1, 2, "q", "x")
            for i, r in enumerate(X)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def points(n=500, seed=1):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, 3)).round(1)
    X[: n // 3] = X[0]                               # a third of the rows is one vector
    return X, (rng.random(n) < 0.15).astype(float)


def order(X, i, pool, skip=False):
    """Donors by (distance, id); ``skip``: common coordinates only, scaled up."""
    d = (X[i] - X[pool]) ** 2
    have = ~np.isnan(d)
    n = have.sum(1)
    with np.errstate(divide="ignore", invalid="ignore"):
        d = sum(np.where(have, d, 0).T)               # in column order
        d = d * X.shape[1] / n if skip else d
    keep = n > 0
    return [pool[j] for j in np.lexsort((pool, d)) if keep[j]]


@pytest.mark.parametrize("block", [40, 2048])
def test_nearest_is_exact(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK_ROWS", block)
    X, _ = points()
    df = frame(spark, X)
    got = {}
    for r in N.nearest(df, df, COLS, 4, "transaction_id", exclude_self=True).collect():
        got.setdefault(r.q, {})[r["rank"]] = r.id
    for i in range(len(X)):
        assert [got[i][k] for k in (1, 2, 3, 4)] == order(X, i, np.array([j for j in range(len(X)) if j != i]))[:4]


def test_rows_sent_for_a_query_stay_bounded(spark, monkeypatch):
    """Four times the donors: a query still looks at about as many blocks, not at four times as many."""
    monkeypatch.setattr(N, "BLOCK_ROWS", 32)
    rng = np.random.default_rng(4)
    sent = []
    for n in (1000, 4000):
        df = frame(spark, rng.normal(size=(n, 3)))
        index = N.NeighborIndex.build(N.vectors(df, "transaction_id", COLS), COLS, 3)
        index.search(N.vectors(df.limit(200), "transaction_id", COLS)).count()
        sent.append((index.visits.count() + 200) / 200)
        assert index.blocks[:, 4].sum() == n and (index.blocks[:, 4] / index.blocks[:, 3]).max() <= 32
    assert sent[1] < 0.5 * (4000 / 32) and sent[1] < 3 * sent[0]


def test_fewer_donors_than_neighbours_and_none(spark):
    df = frame(spark, np.array([[0, 0, 0], [1, 0, 0], [math.nan, 0, 0]], float))
    got = sorted((r.q, r.id, r["rank"]) for r in N.nearest(df, df, COLS, 5, "transaction_id", exclude_self=True).collect())
    assert got == [(0, 1, 1), (1, 0, 1)]
    assert N.nearest(df, df.limit(0), COLS, 5, "transaction_id").count() == 0
    assert N.nearest(df.limit(0), df, COLS, 5, "transaction_id").count() == 0


def test_knn_imputer_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 16)
    X, _ = points(200, 3)
    rng = np.random.default_rng(7)
    X[rng.random(X.shape) < 0.2] = np.nan
    X[5] = np.nan                                    # nothing to compare: the mean
    df = frame(spark, X)
    store = tempfile.mkdtemp(prefix="knn-")
    model = Pipeline(stages=[K.KnnImputer(COLS, n_neighbors=2, store=f"{store}/donors")]).fit(df)
    model.write().overwrite().save(f"{store}/model")
    out = PipelineModel.load(f"{store}/model").transform(df)
    assert out.columns == df.columns
    got = {r.transaction_id: (r.a, r.b, r.c) for r in out.collect()}
    for i in range(len(X)):
        for j in range(3):
            if np.isnan(X[i, j]):
                pool = np.flatnonzero(~np.isnan(X[:, j]))
                near = order(X, i, pool, skip=True)[:2]
                want = np.mean(X[near, j]) if near else np.nanmean(X[:, j])
            else:
                want = X[i, j]
            assert got[i][j] == pytest.approx(want, abs=1e-12)


def test_imputer_leaves_complete_rows_and_empty_columns(spark):
    df = frame(spark, np.array([[1, math.nan, 2], [3, math.nan, 4]], float))
    got = sorted((r.a, r.b, r.c) for r in K.KnnImputer(COLS).fit(df).transform(df).collect())
    assert got == [(1.0, None, 2.0), (3.0, None, 4.0)]


def test_knn_classifier_saves_and_scores(spark):
    X, y = points(300, 5)
    df = frame(spark, X, y)
    train, test = df.where("transaction_id % 4 <> 0"), df.where("transaction_id % 4 = 0")
    store = tempfile.mkdtemp(prefix="knn-")
    model = M.fit(M.build_pipeline(COLS, K.KnnClassifier(COLS, n_neighbors=5, store=f"{store}/index")), train)
    model.write().overwrite().save(f"{store}/model")
    got = {r.transaction_id: (r.prediction, r.p1) for r in M.score(PipelineModel.load(f"{store}/model"), test).collect()}
    pool = np.array([i for i in range(300) if i % 4])
    for i in range(0, 300, 4):
        p1 = np.mean(y[order(X, i, pool)[:5]])
        assert got[i] == (int(p1 > 0.5), pytest.approx(p1))


@pytest.mark.parametrize("kind", ["smote", "borderline_smote", "adasyn"])
def test_synthetic_rows_lie_between_neighbours_and_do_not_depend_on_partitions(spark, kind):
    X, y = points(240, 9)
    rows = [sorted(tuple(r) for r in R._ROWS[kind](frame(spark, X, y, p), COLS).collect()) for p in (1, 7)]
    assert rows[0] == rows[1] and rows[0]
    minority = np.flatnonzero(y == 1)
    for base, _, label, *point in rows[0]:
        assert label == 1.0 and y[base] == 1
        near = order(X, base, minority[minority != base])[:5]
        p, a = np.array(point), X[base]
        on = False
        for b in X[near]:
            t = np.dot(p - a, b - a) / max(np.dot(b - a, b - a), 1e-300)
            on |= -1e-9 <= t <= 1 + 1e-9 and np.allclose(a + t * (b - a), p, atol=1e-9)
        assert on
    if kind == "smote":
        assert len(rows[0]) == (y == 0).sum() - (y == 1).sum()


def test_edited_neighbours(spark):
    X, y = points(240, 11)
    df = frame(spark, X, y)
    kept = {r.transaction_id for r in R.edited_nearest_neighbours(df, COLS).collect()}
    everyone = np.arange(240)
    for i in range(240):
        near = order(X, i, everyone[everyone != i])[:3]
        assert (i in kept) == (y[i] == 1 or not y[near].any())


def test_pipeline_resamples_train_rows_only(spark):
    X, y = points(240, 13)
    df = frame(spark, X, y).withColumn("weight", F.lit(2.0))
    seen = []

    class Spy(R.Resampler):
        def resample(self, rows):
            out = super().resample(rows)
            seen.append((rows.count(), out.count(), out.where("weight <> 1").count(), out.agg(F.avg("is_fraud")).first()[0]))
            return out
    stage = Spy("smote", COLS, weight_col="weight")
    pipe = R.ResamplingPipeline(stages=[stage, M.assembler(COLS), M.make_classifier("decision_tree", maxDepth=3)])
    folds = df.withColumn("fold", (F.col("transaction_id") % 2).cast("int"))
    clf = pipe.getStages()[-1]
    cv = M.tune(pipe, M.param_grid(clf, [{"parameter": "maxDepth", "values": "2", "value_type": "list[int]"}]), folds, parallelism=1)
    assert len(seen) == 3                            # two folds and the refit: anew each time
    assert all(out > n and left == 0 and share == pytest.approx(0.5, abs=0.01) for n, out, left, share in seen)
    scored = M.score(cv.bestModel, df)
    assert scored.count() == df.count() and not [s for s in cv.bestModel.stages if isinstance(s, R.Resampler)]
    assert stage.fit(df).transform(df).count() == df.count()


def test_enn_in_a_pipeline_keeps_incomplete_rows(spark):
    X, y = points(60, 15)
    X[3, 1] = math.nan
    df = frame(spark, X, y)
    out = R.resample(df, "enn", COLS)
    assert out.columns == df.columns and out.where("transaction_id = 3").count() == 1


# ------------------------------------------------------------------ grid files, tuning trace, the whole pipeline in the folds

GRID = """model_name,parameter,values,value_type,special_type
gbt,n_estimators,2|4,list,int
gbt,learning_rate,0.1|0.5,list,float
gbt,max_depth,1|4|2,range,
lr,C,-1|1|3,logspace,
lr,fitIntercept,true|False,bool,
lr,family,binomial,string,
bad,x,1,what,
"""


def test_grid_file(spark):
    path = tempfile.mkdtemp(prefix="grid-") + "/grid.csv"
    with open(path, "w") as f:
        f.write(GRID)
    gbt = M.read_grid(spark, path, "gbt")
    assert gbt == {"n_estimators": [2, 4], "learning_rate": [0.1, 0.5], "max_depth": [1, 3]}
    lr = M.read_grid(spark, path, "lr")
    assert lr == {"C": [0.1, 1.0, 10.0], "fitIntercept": [True, False], "family": ["binomial"]}
    assert len(M.grid_of(M.make_classifier("gbt"), gbt)) == 8
    regs = {round(v, 6) for pm in M.grid_of(M.make_classifier("logistic_regression"), lr) for p, v in pm.items() if p.name == "regParam"}
    assert regs == {10.0, 1.0, 0.1} and M.read_grid(spark, path, "none") == {}
    with pytest.raises(ValueError):
        M.read_grid(spark, path, "bad")
    with pytest.raises(ValueError):
        M.grid_of(M.make_classifier("gbt"), {"nope": [1]})


def test_trace_has_test_and_train_scores(spark):
    X, y = points(240, 17)
    y = (X[:, 0] > 0.4).astype(float)
    df = frame(spark, X, y).withColumn("weight", F.lit(1.0))
    clf = M.make_classifier("decision_tree")
    grid = M.param_grid(clf, [{"parameter": "maxDepth", "values": "0|2", "value_type": "list[int]"}])
    model, trace = M.tune_with_trace(M.build_pipeline(COLS, clf), grid, df, k=2, repeats=2)
    rows = {r.params: r for r in trace.collect()}
    stump, tree = rows['{"maxDepth": 0}'], rows['{"maxDepth": 2}']
    assert tree["rank"] == 1 and len(tree.test_scores) == len(tree.train_scores) == 4
    assert tree.mean_train_score == pytest.approx(1.0) and tree.mean_test_score > 0.9 > stump.mean_test_score
    assert tree.mean_test_score == pytest.approx(np.mean(tree.test_scores)) and model.stages[-1].depth <= 2


def test_job_tunes_the_whole_pipeline(spark, sf_small):
    from fraudlens.plans import jobs, training as TR
    from fraudlens.sources.tables import transactions
    path = tempfile.mkdtemp(prefix="grid-") + "/grid.csv"
    with open(path, "w") as f:
        f.write("model_name,parameter,values,value_type,special_type\ntree,max_depth,2|3,list,int\n")
    numeric = [c for c in TR.MODEL_FEATURES if c != "seconds_since_last_ip"]
    done = jobs.train_and_evaluate(
        transactions(spark, sf_small), "decision_tree", grid_file=path, model_name="tree", k=2, repeats=1,
        drop=["seconds_since_last_ip"], forest=M.ForestSelector(num_trees=20), resampling=R.Resampler(
            "smote", numeric, weight_col="weight"))
    kinds = [type(s).__name__ for s in done["model"].stages]
    assert kinds[0] == "ImputerModel" and "VectorSlicer" in kinds and "Resampler" not in kinds
    assert done["tuning_trace"].count() == 2 and done["params"]["maxDepth"] in (2, 3)
    assert done["scores"].count() == 1
