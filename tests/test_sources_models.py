"""Sources/sinks, config parsing, model store and statistics helpers."""
import math
import tempfile

import pytest
from pyspark.sql import functions as F

from fraudlens.operators import models as M
from fraudlens.operators import prep as P
from fraudlens.operators import quality as Q
from fraudlens.plans import training as TR
from fraudlens.sources import dims
from fraudlens.sources import io as S
from fraudlens.sources.tables import transactions


def test_csv_round_trip_with_schema(spark, sf_small):
    t = transactions(spark, sf_small)
    d = tempfile.mkdtemp(prefix="fl-csv-")
    S.write_table(t, d + "/tx", fmt="csv")
    back = S.read_csv(spark, d + "/tx", S.TRANSACTION_SCHEMA)
    assert back.count() == t.count()
    assert back.schema["transaction_date"].dataType.simpleString() == "timestamp_ntz"


def test_safe_names():
    assert S.safe_name("No._of_day") == "day_no" and S.safe_name("a.b") == "a_b"


def test_jdbc_options():
    o = S.jdbc_options("srv", "db", "drv", table="t", partition_column="id", lower=0, upper=100, num_partitions=4)
    assert o["url"].startswith("jdbc:sqlserver://srv") and o["numPartitions"] == "4"
    with pytest.raises(ValueError):
        S.jdbc_options("srv", "db", "drv")


def test_bin_config(spark):
    assert P.bins_from_config(dims.columns_to_bin(spark)) == {"amount": 2, "MCCs": 3, "date_in_sec": 5, "pos_id": 5}


def test_convert_datatypes_warns(spark, sf_small):
    out, notes = Q.convert_datatypes(transactions(spark, sf_small), dims.data_schema(spark))
    assert dict(out.dtypes)["is_fraud"] == "boolean"
    assert any("category" in n and "MCCs" in n for n in notes)


def test_name_rules():
    r = Q.name_rule_columns(["num trans__a", "x|y", "cat trans__b", "plain"], exclude=["plain"])
    assert r == {"numeric": ["num trans__a", "x|y"], "categorical": ["cat trans__b"]}


def test_chi2_tail():
    assert P._chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-6)
    assert P._chi2_sf(11.070497693516351, 5) == pytest.approx(0.05, abs=1e-6)


def test_grid_parsing():
    assert M.parse_grid_values("1|3|5", "list[int]") == [1, 3, 5]
    assert M.parse_grid_values("true|False", "list[bool]") == [True, False]
    assert M.parse_grid_values("1|4|1", "int", "range") == [1, 2, 3]
    assert M.parse_grid_values("-2|0|3", "float", "logspace") == [0.01, 0.1, 1.0]
    with pytest.raises(ValueError):
        M.parse_grid_values("yes", "list[bool]")
    combos = M.grid_combinations([{"parameter": "a", "values": "1|2", "value_type": "list[int]"},
                                  {"parameter": "b", "values": "x|y", "value_type": "list[str]"}])
    assert len(combos) == 4


def test_phase_guard():
    M.require_phase("training", M.Phase.TRAINING)
    with pytest.raises(RuntimeError):
        M.require_phase("deploy", M.Phase.TRAINING)


def test_model_store_versions(spark, sf_small):
    train, test = TR.train_test(transactions(spark, sf_small))
    model = M.fit(M.build_pipeline(TR.MODEL_FEATURES, M.make_classifier("decision_tree", maxDepth=2)), train)
    root = tempfile.mkdtemp(prefix="fl-models-")
    assert S.save_model(spark, model, root, "is_fraud") == 1
    assert S.save_model(spark, model, root, "is_fraud") == 2
    loaded = S.load_model(spark, root, "is_fraud", 1)
    a = M.score(model, test).orderBy("transaction_id").collect()
    b = M.score(loaded, test).orderBy("transaction_id").collect()
    assert a == b
    with pytest.raises(FileNotFoundError):
        S.load_model(spark, root, "is_fraud", 7)
    rec = S.save_run_record(spark, root, "is_fraud", 2, {"maxDepth": 2}, 0.5)
    assert rec.count() == 1


def test_fitted_stage_persistence(spark, sf_small):
    t = transactions(spark, sf_small).select("amount", "MCCs")
    m = P.ExactImputer(["amount"], strategy="median").fit(t)
    d = tempfile.mkdtemp(prefix="fl-stage-")
    m.write().overwrite().save(d + "/imp")
    back = P.ImputerModel.load(d + "/imp")
    assert back.fitted() == m.fitted()


def test_gbt_beats_dummy_on_f2(spark, sf_small):
    from fraudlens.operators.evaluate import summary_scores
    train, test = TR.train_test(transactions(spark, sf_small))
    gbt = M.score(M.fit(M.build_pipeline(TR.MODEL_FEATURES, M.make_classifier("gbt", maxIter=10)), train), test)
    dummy = M.dummy_scores(train, test, strategy="stratified")
    assert summary_scores(gbt).first()["f2"] >= summary_scores(dummy).first()["f2"]


def test_scoring_stream(spark, sf_small):
    from fraudlens.streaming.scoring import start_scoring_stream
    train, test = TR.train_test(transactions(spark, sf_small))
    model = M.fit(M.build_pipeline(TR.MODEL_FEATURES, M.make_classifier("decision_tree", maxDepth=2)), train)
    d = tempfile.mkdtemp(prefix="fl-stream-")
    model.write().overwrite().save(d + "/model")
    feats = test.drop("is_test", "weight")
    feats.write.parquet(d + "/in")
    q = start_scoring_stream(spark, d + "/model", d + "/in", d + "/out", feats.schema, d + "/ckpt")
    q.awaitTermination(120)
    assert spark.read.parquet(d + "/out").count() == feats.count()


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_config_sheets(spark):
    d = tempfile.mkdtemp(prefix="fl-cfg-")
    _write(d + "/schema.csv", "column_name,data_type,nullable,is_categorical\namount,float,Y,N\nday_no,int,N,N\n")
    rows = [r.asDict() for r in S.schema_sheet(spark, d + "/schema.csv").collect()]
    st = S.struct_from_sheet(rows)
    assert [f.name for f in st.fields] == ["amount", "day_no"] and not st["day_no"].nullable
    _write(d + "/drop.csv", "column\nIP_address\npos_id\n")
    assert S.drop_list(spark, d + "/drop.csv") == ["IP_address", "pos_id"]
    _write(d + "/hol.csv", "holiday_starts,holiday_ends\n24/12/2023,02/01/2024\n")
    r = S.holiday_periods(spark, d + "/hol.csv").first()
    assert (str(r["holiday_starts"]), str(r["holiday_ends"])) == ("2023-12-24", "2024-01-02")


def test_column_difference():
    from fraudlens.operators.aggregates import column_difference
    assert column_difference(["a", "b", "c"], ["b", "x"]) == ["a", "c"]


def test_split_counts_from_saved_trees(spark, sf_small):
    train, _ = TR.train_test(transactions(spark, sf_small))
    m = M.fit(M.build_pipeline(TR.MODEL_FEATURES, M.make_classifier("gbt", maxIter=5, maxDepth=2)), train)
    d = tempfile.mkdtemp(prefix="fl-trees-")
    sc = M.split_counts(m.stages[-1], TR.MODEL_FEATURES, spark, d + "/gbt")
    rows = sc.collect()
    assert rows and all(r["weight"] >= 1 for r in rows)
    assert {r["feature"] for r in rows} <= set(TR.MODEL_FEATURES)


def test_repeated_stratified_tuning(spark, sf_small):
    train, _ = TR.train_test(transactions(spark, sf_small))
    clf = M.make_classifier("decision_tree")
    grid = M.param_grid(clf, [{"parameter": "maxDepth", "values": "1|3", "value_type": "list[int]"}])
    model, trace = M.tune_repeated(M.build_pipeline(TR.MODEL_FEATURES, clf), grid, train, k=3, repeats=2, parallelism=2)
    assert len(trace) == 2 and all(0.0 <= s <= 1.0 for _, s in trace)
    assert M.score(model, train).count() == train.count()


def test_jobs_end_to_end(spark, sf_small):
    from fraudlens.plans import jobs
    t = transactions(spark, sf_small)
    clean, rep = jobs.cleanse_and_profile(t, dims.data_schema(spark), out=tempfile.mkdtemp(prefix="fl-rep-"))
    assert clean.count() == t.count() and rep["missing_columns"].count() == 2
    res = jobs.train_and_evaluate(t, "decision_tree", [{"parameter": "maxDepth", "values": "2|3", "value_type": "list[int]"}],
                                  model_root=tempfile.mkdtemp(prefix="fl-store-"), k=3, repeats=1)
    assert res["version"] == 1 and res["confusion"].count() == 4 and 0 <= res["best_score"] <= 1


def test_cluster_settings(spark):
    from fraudlens.session import apply_cluster_conf, suggest_shuffle_partitions
    assert suggest_shuffle_partitions(0, cores=8) == 16
    assert suggest_shuffle_partitions(60e12) > 200_000
    done = apply_cluster_conf(spark, overrides={"spark.sql.shuffle.partitions": "8"})
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert "spark.sql.adaptive.advisoryPartitionSizeInBytes" in done or \
        "spark.sql.adaptive.advisoryPartitionSizeInBytes" in dict(spark.sparkContext.getConf().getAll())


def test_forest_selection_is_fitted_inside_the_pipeline(spark):
    from fraudlens.operators import sampling as L
    from pyspark.sql import functions as F
    t = spark.range(600).select(F.col("id").alias("transaction_id"), (F.col("id") % 2).cast("double").alias("is_fraud"),
                                ((F.col("id") % 2) * 3 + F.rand(1)).alias("good"), F.rand(2).alias("noise_a"),
                                F.rand(3).alias("noise_b"), F.lit(1.0).alias("weight"))
    cols = ["noise_a", "good", "noise_b"]
    assert M.select_by_forest(t, cols, num_trees=20) == ["good"]
    pipe = M.build_pipeline(cols, M.make_classifier("decision_tree", maxDepth=2), forest=M.ForestSelector(num_trees=20))
    folds = L.stratified_folds(t, k=3).cache()
    oof = M.out_of_fold_scores(pipe, folds, 3)
    assert oof.count() == 600 and oof.where("prediction <> is_fraud").count() == 0
    cv = M.tune(pipe, M.param_grid(M.make_classifier("decision_tree"), []) or [{}], folds, parallelism=1)
    assert cv.bestModel.stages[1].getIndices() == [1]


def test_adaboost_learns_an_interval(spark):
    from pyspark.sql import functions as F
    t = spark.range(300).select(F.col("id").alias("transaction_id"), (F.col("id") / 300).alias("x"),
                                F.col("id").between(100, 199).cast("double").alias("is_fraud"))
    model = M.adaboost(t, ["x"], rounds=12)
    assert len(model["stumps"]) > 1
    wrong = M.adaboost_score(model, t).where("prediction <> is_fraud").count()
    assert wrong < 100


def test_forest_selection_grows_the_forest_in_parts(spark, monkeypatch):
    """A fit keeps a bootstrap count for every row and tree: no fit holds the whole forest."""
    from pyspark.sql import functions as F
    sizes = []

    class Recorded(M.RandomForestClassifier):
        def _fit(self, df):
            sizes.append((self.getNumTrees(), self.getSeed()))
            return super()._fit(df)
    monkeypatch.setattr(M, "RandomForestClassifier", Recorded)
    t = spark.range(300).select((F.col("id") % 2).cast("double").alias("is_fraud"), ((F.col("id") % 2) * 3 + F.rand(1)).alias("good"),
                                F.rand(2).alias("noise"))
    assert M.select_by_forest(t, ["noise", "good"], num_trees=250) == ["good"]
    assert sum(n for n, _ in sizes) == 250 and max(n for n, _ in sizes) <= 100 and len({s for _, s in sizes}) == len(sizes)


def test_profile_counts_each_column_by_itself(spark):
    from fraudlens.operators import profile as G
    t = spark.createDataFrame([(1, "b", 2.0, None), (1, None, -1.5, None), (3, "a", 2.0, None), (None, "b", float("nan"), None)],
                              "i int, s string, d double, e string")
    out = G.profile(t)
    got = {r.column_name: tuple(r)[1:] for r in out.collect()}
    assert got == {"i": ("int", 1, 2, "1", "3"), "s": ("string", 1, 2, "a", "b"), "d": ("double", 0, 3, "-1.5", "NaN"),
                   "e": ("string", 4, 0, None, None)}
    assert "Expand" not in out._jdf.queryExecution().toString()
    assert tuple(G.profile(t.limit(0)).first()) == ("i", "int", None, 0, None, None)
