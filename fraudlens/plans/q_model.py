"""Registered queries: feature job, fitted preparation (F), splits (L), models (M), importance (V6)."""
from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fraudlens.functions import dates as D
from fraudlens.operators import models as M
from fraudlens.operators import prep as P
from fraudlens.operators import sampling as L
from fraudlens.operators.quality import numeric_columns
from fraudlens.plans import training as TR
from fraudlens.plans.feature_job import build_transaction_features
from fraudlens.plans.flagship import scored_transactions
from fraudlens.plans.oracle import with_tx
from fraudlens.plans.q_profile import SPEARMAN_CTES
from fraudlens.plans.registry import ORACLE, register, tbl, tx
from fraudlens.session import materialize
from fraudlens.sources import dims
from fraudlens.sources.tables import transactions

LM, LA = L.LEHMER_M, L.LEHMER_A


def U(seed=42, id_col="transaction_id"):
    return f"(CAST((((({id_col} % {LM}) + {seed}) % {LM}) * {LA}) % {LM} AS DOUBLE) / {LM}.0)"


# ------------------------------------------------------------------ feature job

_WS = (1, 5, 12, 28, 60)
_FEAT_PARTS = [("j4_ip_country", ["IP_address_country_code"]),
               ("d2_local_time", ["country_code_date", "country_code_date_sec_since_midnight"]),
               ("d3_sec_since_midnight", ["transaction_date_sec_since_midnight"]),
               ("w1_distinct_ip_windows", [f"customer_id_distinct_ip_{w}d" for w in _WS]),
               ("d4_is_weekend", ["is_weekend"]),
               ("d5_weekday_flags", [f"local_is_{d}" for d in D.WEEKDAYS]),
               ("j6_is_gb_bank_holiday", ["is_GB_bank_holiday"]),
               ("w3_sec_since_last_trade", ["customer_id_sec_since_last_trade"]),
               ("d9_days_established", ["established_period_in_day"]),
               ("w2_moving_amount_count", [f"customer_id_{k}_{w}d" for w in _WS for k in ("ma_amount", "ma_count")]),
               ("e6_merchant_card_flags", ["is_merchant_card", "is_merchant_mismatch", "is_merchant_card_and_mismatch"]),
               ("d6_day_month", ["transaction_date_day", "transaction_date_month"]),
               ("e2_onehot_merchant_category", [f"merchant_category_CAT_{i}" for i in range(7)]),
               ("e3_label_encode", ["card_present_or_not"]),
               ("w4_seconds_since_last_ip", ["seconds_since_last_ip"])]
_BASE = ["transaction_id", "transaction_date", "customer_id", "amount", "date_in_sec", "day_no", "merchant_id", "pos_id",
         "merchant_established_date", "MCCs", "IP_address", "type_of_credit_card_used", "store_card_merchant_id", "is_fraud"]


def _feature_sql():
    sel = [f"t.{c}" for c in _BASE] + ["j3.IP_used_by_2_customer_id_or_more"]
    joins = [f"JOIN ({ORACLE['j3_ip_used_by_many']}) j3 ON t.transaction_id = j3.transaction_id"]
    for i, (name, cols) in enumerate(_FEAT_PARTS):
        sel += [f"p{i}.{c}" for c in cols]
        joins.append(f"JOIN ({ORACLE[name]}) p{i} ON t.transaction_id = p{i}.transaction_id")
    return f"SELECT {', '.join(sel)} FROM ({ORACLE['s1_transactions']}) t " + " ".join(joins)


@register("feature_table_transactions", _feature_sql())
def q_feature_table(spark, sf):
    f = build_transaction_features(tx(spark, sf), dims.ip_ranges(spark), dims.country_timezone(spark),
                                   dims.holidays(spark), ip_thresholds=[2])
    return f.drop("IP_used_by_3_customer_id_or_more")


# ------------------------------------------------------------------ F

@register("f1_impute_median", with_tx(
    "SELECT transaction_id, coalesce(amount, (SELECT quantile_cont(amount, 0.5) FROM transactions)) AS amount FROM transactions"))
def q_f1a(spark, sf):
    t = tx(spark, sf).select("transaction_id", "amount")
    return P.ExactImputer(["amount"], strategy="median").fit(t).transform(t)


@register("f1_impute_mean", with_tx(
    "SELECT transaction_id, round(coalesce(amount, (SELECT avg(amount) FROM transactions)), 4) AS amount FROM transactions"))
def q_f1b(spark, sf):
    t = tx(spark, sf).select("transaction_id", "amount")
    return P.ExactImputer(["amount"], strategy="mean").fit(t).transform(t).withColumn("amount", F.round("amount", 4))


@register("f1_impute_most_frequent", with_tx("""SELECT transaction_id, coalesce(type_of_credit_card_used,
  (SELECT arg_min(v, (-n, v)) FROM (SELECT type_of_credit_card_used AS v, count(*) AS n FROM transactions
   WHERE type_of_credit_card_used IS NOT NULL GROUP BY 1))) AS type_of_credit_card_used FROM transactions"""))
def q_f1c(spark, sf):
    t = tx(spark, sf).select("transaction_id", "type_of_credit_card_used")
    return P.ExactImputer(["type_of_credit_card_used"], strategy="most_frequent").fit(t).transform(t)


@register("f1_impute_constant", with_tx("SELECT transaction_id, coalesce(amount, 0.0) AS amount FROM transactions"))
def q_f1d(spark, sf):
    t = tx(spark, sf).select("transaction_id", "amount")
    return P.ExactImputer(["amount"], strategy="constant", fill_value=0.0).fit(t).transform(t)


_BINS = {c: int(b.split("_")[1]) for b, c in dims.COLUMNS_TO_BIN}


def _bin_sql():
    mm = ", ".join(f"min(CAST({c} AS DOUBLE)) AS mn_{c}, max(CAST({c} AS DOUBLE)) AS mx_{c}" for c in _BINS)
    cols = []
    for c, n in _BINS.items():
        terms = " + ".join(f"CAST({c} >= mn_{c} + {k} * ((mx_{c} - mn_{c}) / {n}) AS INTEGER)" for k in range(1, n))
        cols.append(f"CASE WHEN {c} IS NULL THEN NULL ELSE CAST({terms} AS DOUBLE) END AS {c}")
    return with_tx(f"SELECT transaction_id, {', '.join(cols)} FROM transactions, (SELECT {mm} FROM transactions)")


@register("f3_equal_width_bins", _bin_sql())
def q_f3(spark, sf):
    t = tx(spark, sf).select("transaction_id", *_BINS)
    bins = P.bins_from_config(dims.columns_to_bin(spark))
    return P.EqualWidthBinner(list(bins), bins=bins).fit(t).transform(t)


_SC = ["amount", "MCCs", "day_no"]


@register("f4_standard_scaler", with_tx("SELECT transaction_id, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM transactions)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END "
    f"FROM transactions), 4) AS {c}" for c in _SC) + " FROM transactions"))
def q_f4(spark, sf):
    t = tx(spark, sf).select("transaction_id", *_SC)
    out = P.PopulationStandardScaler(_SC).fit(t).transform(t)
    return out.select("transaction_id", *[F.round(c, 4).alias(c) for c in _SC])


@register("f5_minmax_scaler", with_tx("SELECT transaction_id, " + ", ".join(
    f"round((CAST({c} AS DOUBLE) - mn_{c}) / (CASE WHEN mx_{c} = mn_{c} THEN 1.0 ELSE mx_{c} - mn_{c} END), 6) AS {c}" for c in _SC)
    + " FROM transactions, (SELECT " + ", ".join(f"CAST(min({c}) AS DOUBLE) AS mn_{c}, CAST(max({c}) AS DOUBLE) AS mx_{c}" for c in _SC)
    + " FROM transactions)"))
def q_f5(spark, sf):
    t = tx(spark, sf).select("transaction_id", *_SC)
    out = P.ZeroOneScaler(_SC).fit(t).transform(t)
    return out.select("transaction_id", *[F.round(c, 6).alias(c) for c in _SC])


@register("f6_onehot_for_model", with_tx("SELECT transaction_id, [" + ", ".join(
    f"CAST(merchant_category = 'CAT_{i}' AS DOUBLE)" for i in range(7)) + "] AS merchant_category_vec, "
    "CAST(card_present_or_not = 'card present' AS DOUBLE) AS card_present_or_not_vec FROM transactions"))
def q_f6(spark, sf):
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    t = tx(spark, sf).select("transaction_id", "merchant_category", "card_present_or_not")
    si = StringIndexer(inputCols=["merchant_category", "card_present_or_not"], outputCols=["_mc", "_cp"],
                       stringOrderType="alphabetAsc", handleInvalid="keep").fit(t)
    x = si.transform(t)
    # indexer keeps an extra "unknown" slot; dropping the last slot maps unknown values to all zeros
    oh = OneHotEncoder(inputCols=["_mc"], outputCols=["_mcv"], dropLast=True, handleInvalid="error").fit(x)
    x = oh.transform(x)
    # binary column: one indicator (drop='if_binary')
    return x.select("transaction_id", vector_to_array("_mcv").alias("merchant_category_vec"),
                    F.col("_cp").alias("card_present_or_not_vec"))


@register("f7_column_pipeline")
def q_f7(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    t = tx(spark, sf)
    num = ["amount", "day_no"]
    stages = [P.ExactImputer(num, strategy="median"), P.PopulationStandardScaler(num), P.ZeroOneScaler(num),
              P.ExactImputer(["type_of_credit_card_used"], strategy="most_frequent"),
              StringIndexer(inputCols=["type_of_credit_card_used"], outputCols=["_ci"], stringOrderType="alphabetAsc",
                            handleInvalid="keep"),
              OneHotEncoder(inputCols=["_ci"], outputCols=["_cv"], handleInvalid="keep"),
              P.EqualWidthBinner(["MCCs"], bins={"MCCs": 3}),
              VectorAssembler(inputCols=[*num, "_cv", "MCCs"], outputCol="features", handleInvalid="keep")]
    m = Pipeline(stages=stages).fit(t)
    return m.transform(t).select("transaction_id", vector_to_array("features").alias("features"))


_VF = ["amount", "MCCs", "day_no", "is_fraud", "merchant_id"]


@register("f8_variance_filter", with_tx(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(var_pop({c}), 6) AS variance, var_pop({c}) > 0.001 AS keep FROM transactions" for c in _VF)))
def q_f8(spark, sf):
    t = tx(spark, sf)
    st = P.VarianceThresholdFilter(_VF, threshold=0.001).fit(t).fitted()
    return spark.createDataFrame([(c, round(st["variance"][c], 6), c in st["keep"]) for c in _VF],
                                 "column_name string, variance double, keep boolean")


_NF = ["amount", "IP_address", "pos_id", "type_of_credit_card_used", "store_card_merchant_id", "customer_id"]


@register("f9_null_ratio_filter", with_tx(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) >= CAST(floor(0.75 * count(*)) AS BIGINT) AS keep FROM transactions" for c in _NF)))
def q_f9(spark, sf):
    t = tx(spark, sf)
    keep = P.NullRatioFilter(_NF, threshold=0.75).fit(t).fitted()["keep"]
    return spark.createDataFrame([(c, c in keep) for c in _NF], "column_name string, keep boolean")


_LI = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]   # for the SQL twins


def _spearman_keep_sql(threshold: float, variance: float | None = None):
    """Recursive twin of F10 (and F14): the first name of each component of strong links, and all unlinked columns,
    among the columns of more than ``variance``."""
    strong = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM rk" for a in _LI for b in _LI if a != b)
    names = (" UNION ALL ".join(f"SELECT '{c}' AS c FROM lineitem HAVING var_pop({c}) > {variance}" for c in _LI) if variance is not None
             else " UNION ALL ".join(f"SELECT '{c}' AS c" for c in _LI))
    every = ", ".join(f"('{c}')" for c in _LI)
    return (SPEARMAN_CTES.replace("WITH ", "WITH RECURSIVE ", 1) + f""",
names AS ({names}),
strong AS (SELECT a, b FROM ({strong}) WHERE abs(r) > {threshold} AND a IN (SELECT c FROM names) AND b IN (SELECT c FROM names)),
reach AS (SELECT c, c AS d FROM names UNION SELECT reach.c, strong.b FROM reach JOIN strong ON strong.a = reach.d)
SELECT t.c AS column_name, coalesce(min(d) = t.c, false) AS keep FROM (VALUES {every}) t(c) LEFT JOIN reach ON reach.c = t.c GROUP BY t.c""")


@register("f10_spearman_filter", _spearman_keep_sql(0.5))
def q_f10(spark, sf):
    li = tbl(spark, sf, "lineitem")
    cols = numeric_columns(li)
    keep = P.SpearmanCorrelationFilter(cols, threshold=0.5).fit(li).fitted()["keep"]
    return spark.createDataFrame([(c, c in keep) for c in cols], "column_name string, keep boolean")


@register("f11_pearson_filter", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) >= 0 AND NOT (" + (" OR ".join(f"coalesce(abs(corr({p}, {c})) > 0.5, false)" for p in _LI[:i]) or "false")
    + ") AS keep FROM lineitem" for i, c in enumerate(_LI)))
def q_f11(spark, sf):
    li = tbl(spark, sf, "lineitem")
    cols = numeric_columns(li)
    keep = P.PearsonCorrelationFilter(cols, threshold=0.5).fit(li).fitted()["keep"]
    return spark.createDataFrame([(c, c in keep) for c in cols], "column_name string, keep boolean")


_CH = ["merchant_category", "type_of_credit_card_used", "card_present_or_not", "is_fraud"]


def _chi_sql():
    parts = []
    for i, a in enumerate(_CH):
        for b in _CH[i + 1:]:
            parts.append(f"""SELECT '{a}' AS feature_1, '{b}' AS feature_2, round(sum(CASE WHEN dof = 1 THEN
  pow(greatest(abs(coalesce(o, 0) - e) - least(0.5, abs(coalesce(o, 0) - e)), 0), 2) / e ELSE pow(coalesce(o, 0) - e, 2) / e END), 4) AS chi2,
  CAST(max(dof) AS INTEGER) AS dof, round(max(n) / (max(r) * max(c)), 4) AS expected_mean FROM (
  SELECT ra.a, cb.b, ra.ra * cb.cb / tot.n AS e, ct.o, tot.n, tot.r, tot.c, (tot.r - 1) * (tot.c - 1) AS dof
  FROM (SELECT CAST({a} AS VARCHAR) AS a, sum(o) AS ra FROM ct_{i}_{b} GROUP BY 1) ra
  CROSS JOIN (SELECT b, sum(o) AS cb FROM ct_{i}_{b} GROUP BY 1) cb
  CROSS JOIN (SELECT sum(o) AS n, count(DISTINCT a) AS r, count(DISTINCT b) AS c FROM ct_{i}_{b}) tot
  LEFT JOIN ct_{i}_{b} ct ON ct.a = ra.a AND ct.b = cb.b)""")
    ctes = []
    for i, a in enumerate(_CH):
        for b in _CH[i + 1:]:
            ctes.append(f"""ct_{i}_{b} AS (SELECT CAST({a} AS VARCHAR) AS a, CAST({b} AS VARCHAR) AS b, CAST(count(*) AS DOUBLE) AS o,
  CAST({a} AS VARCHAR) AS {a} FROM transactions WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2)""")
    return with_tx(" UNION ALL ".join(parts), extra=",\n".join(ctes))


@register("f12_chi_square_pairs", _chi_sql())
def q_f12(spark, sf):
    p = P.chi_square_pairs(tx(spark, sf), _CH)
    return p.select("feature_1", "feature_2", F.round("chi2", 4).alias("chi2"), "dof",
                    F.round("expected_mean", 4).alias("expected_mean"))


@register("f12_chi_square_filter")
def q_f12b(spark, sf):
    t = tx(spark, sf)
    keep = P.ChiSquareFilter(_CH, alpha=0.05).fit(t).fitted()["keep"]
    return spark.createDataFrame([(c, c in keep) for c in _CH], "column_name string, keep boolean")


@register("f13_forest_selection")
def q_f13(spark, sf):
    train, _ = TR.train_test(tx(spark, sf))
    kept = M.select_by_forest(train, TR.MODEL_FEATURES)
    return spark.createDataFrame([(c, c in kept) for c in TR.MODEL_FEATURES], "feature string, keep boolean")


@register("f14_stats_selection_pipeline")
def q_f14(spark, sf):
    from pyspark.ml import Pipeline
    li = tbl(spark, sf, "lineitem")
    return Pipeline(stages=P.stats_selection_stages(numeric_columns(li))).fit(li).transform(li)


@register("f14_selected_columns", _spearman_keep_sql(0.85, 0.001))
def q_f14b(spark, sf):
    """Which columns the selection lets pass."""
    from pyspark.ml import Pipeline
    li = tbl(spark, sf, "lineitem")
    cols = numeric_columns(li)
    left = Pipeline(stages=P.stats_selection_stages(cols)).fit(li).transform(li).columns
    return spark.createDataFrame([(c, c in left) for c in cols], "column_name string, keep boolean")


@register("f15_function_stage", with_tx(
    "SELECT transaction_id, CAST(coalesce(isodow(transaction_date) - 1 >= 5, false) AS INTEGER) AS is_weekend FROM transactions"))
def q_f15(spark, sf):
    from pyspark.ml import Pipeline
    stage = P.FunctionTransformer(lambda df, col: df.withColumn("is_weekend", D.is_weekend(col)), col="transaction_date")
    return Pipeline(stages=[stage]).fit(tx(spark, sf)).transform(tx(spark, sf)).select("transaction_id", "is_weekend")


# ------------------------------------------------------------------ L

@register("l1_random_split", with_tx(f"SELECT transaction_id, {U()} < 0.2 AS is_test FROM transactions"))
def q_l1(spark, sf):
    return L.with_split_flag(tx(spark, sf).select("transaction_id"), method="lehmer")


@register("l2_time_split", with_tx("""SELECT transaction_id, row_number() OVER (ORDER BY transaction_date, transaction_id) - 1
  >= (SELECT CAST(floor(count(*) * 0.8) AS BIGINT) FROM transactions) AS is_test FROM transactions"""))
def q_l2(spark, sf):
    return L.time_split(tx(spark, sf).select("transaction_id", "transaction_date")).select("transaction_id", "is_test")


@register("l3_stratified_folds", with_tx(f"""SELECT transaction_id, is_fraud, CAST((row_number() OVER (PARTITION BY is_fraud
  ORDER BY {U()}, transaction_id) - 1) % 5 AS INTEGER) AS fold FROM transactions"""))
def q_l3(spark, sf):
    return L.stratified_folds(tx(spark, sf).select("transaction_id", "is_fraud"), method="lehmer")


@register("l4_hash_folds", with_tx(f"SELECT transaction_id, CAST(floor({U()} * 2) AS INTEGER) AS fold FROM transactions"))
def q_l4(spark, sf):
    return L.hash_folds(tx(spark, sf).select("transaction_id"), k=2, method="lehmer")


@register("l5_time_series_folds", with_tx("""SELECT transaction_id, CAST(CASE WHEN pos < n - 5 * (n // 6) THEN -1
  ELSE floor((pos - (n - 5 * (n // 6))) / (n // 6)) END AS INTEGER) AS test_fold FROM
  (SELECT transaction_id, row_number() OVER (ORDER BY transaction_date, transaction_id) - 1 AS pos, count(*) OVER () AS n FROM transactions)"""))
def q_l5(spark, sf):
    return L.time_series_folds(tx(spark, sf).select("transaction_id", "transaction_date")).select("transaction_id", "test_fold")


@register("l6_sample_rows", with_tx(f"SELECT transaction_id, day_no FROM transactions ORDER BY {U()}, transaction_id LIMIT 5000"))
def q_l6(spark, sf):
    return L.sample_rows(tx(spark, sf).select("transaction_id", "day_no"), 5000, method="lehmer")


@register("l7_class_weights", with_tx("""SELECT transaction_id, CASE WHEN is_fraud = 1 THEN
  (SELECT CAST(count(*) AS DOUBLE) FROM transactions) / (SELECT min(n) FROM (SELECT count(*) AS n FROM transactions GROUP BY is_fraud))
  ELSE 1.0 END AS weight FROM transactions"""))
def q_l7(spark, sf):
    return L.with_weights(tx(spark, sf).select("transaction_id", "is_fraud")).select("transaction_id", "weight")


_CNT = "(SELECT sum(CASE WHEN is_fraud = 0 THEN 1 ELSE 0 END) AS n0, sum(CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END) AS n1 FROM transactions)"


@register("l8_random_oversample", with_tx(f"""SELECT transaction_id, is_fraud, rep FROM (
  SELECT t.transaction_id, t.is_fraud, CASE WHEN t.is_fraud = 1 THEN CAST(floor(0.5 * c.n0 / c.n1) AS BIGINT)
    + CAST({U()} < 0.5 * c.n0 / c.n1 - floor(0.5 * c.n0 / c.n1) AS BIGINT) ELSE 1 END AS reps
  FROM transactions t, {_CNT} c), LATERAL (SELECT unnest(range(1, greatest(reps, 1) + 1)) AS rep)"""))
def q_l8(spark, sf):
    t = tx(spark, sf).select("transaction_id", "is_fraud")
    out = L.random_oversample(t, ratio=0.5, method="lehmer")
    from pyspark.sql import Window
    return out.withColumn("rep", F.row_number().over(Window.partitionBy("transaction_id").orderBy("is_fraud")).cast("bigint"))


@register("l8_random_undersample", with_tx(f"""SELECT transaction_id, is_fraud FROM transactions, {_CNT} c
  WHERE is_fraud = 1 OR {U()} < least(1.0, 1.0 * c.n1 / c.n0)"""))
def q_l8b(spark, sf):
    return L.random_undersample(tx(spark, sf).select("transaction_id", "is_fraud"), ratio=1.0, method="lehmer")


# ------------------------------------------------------------------ M

@register("m1_dummy_prior", with_tx("""
SELECT transaction_id, CAST(is_fraud AS DOUBLE) AS is_fraud, CAST(s > 0.5 AS INTEGER) AS prediction, 1 - s AS p0, s AS p1
FROM split, (SELECT avg(CAST(is_fraud AS DOUBLE)) AS s FROM split WHERE NOT is_test) WHERE is_test""",
    extra="""split AS (SELECT transaction_id, is_fraud, row_number() OVER (ORDER BY transaction_date, transaction_id) - 1
  >= (SELECT CAST(floor(count(*) * 0.8) AS BIGINT) FROM transactions) AS is_test FROM transactions)"""))
def q_m1(spark, sf):
    train, test = TR.train_test(tx(spark, sf))
    return M.dummy_scores(train, test, strategy="prior")


@register("m1_dummy_stratified")
def q_m1b(spark, sf):
    train, test = TR.train_test(tx(spark, sf))
    return M.dummy_scores(train, test, strategy="stratified")


@register("m2_decision_tree")
def q_m2(spark, sf):
    return TR.fit_and_score(tx(spark, sf), "decision_tree", maxDepth=4)


@register("m3_random_forest")
def q_m3(spark, sf):
    return TR.fit_and_score(tx(spark, sf), "random_forest", numTrees=100, maxDepth=4)


@register("m4_logistic_regression")
def q_m4(spark, sf):
    return TR.fit_and_score(tx(spark, sf), "logistic_regression", maxIter=100)


@register("m5_gradient_boosted_trees")
def q_m5(spark, sf):
    return TR.fit_and_score(tx(spark, sf), "gbt", maxIter=50, maxDepth=3)


@register("m6_adaboost")
def q_m6(spark, sf):
    train, test = TR.train_test(tx(spark, sf))
    model = M.adaboost(train, TR.MODEL_FEATURES)
    return M.adaboost_score(model, test)


@register("m7_linear_svc")
def q_m7(spark, sf):
    return TR.fit_and_score(tx(spark, sf), "linear_svc", maxIter=100)


@register("m7_radial_svc")
def q_m7_radial(spark, sf):
    from fraudlens.operators.kernel import RandomFourierFeatures
    train, test = TR.train_test(tx(spark, sf))
    pipe = M.build_pipeline(TR.MODEL_FEATURES, M.make_classifier("linear_svc", maxIter=100),
                            kernel=RandomFourierFeatures(TR.MODEL_FEATURES))
    return M.score(M.fit(pipe, train), test)


@register("m10_grid_search_trace")
def q_m10(spark, sf):
    train, _ = TR.train_test(tx(spark, sf))
    folds = L.stratified_folds(train, k=3)
    clf = M.make_classifier("gbt", maxIter=5)
    pipe = M.build_pipeline(TR.MODEL_FEATURES, clf)
    grid = M.param_grid(clf, [{"parameter": "maxDepth", "values": "2|3", "value_type": "list[int]"},
                              {"parameter": "stepSize", "values": "0.1|0.3", "value_type": "list[float]"}])
    cv = M.tune(pipe, grid, folds, parallelism=2)
    return M.tuning_trace(cv, spark)


@register("m12_f2_evaluator", f"SELECT f2 FROM ({ORACLE['v3_f2_balanced_accuracy']})")
def q_m12(spark, sf):
    s = scored_transactions(tx(spark, sf)).select(F.col("is_fraud").cast("double"), F.col("prediction").cast("double"))
    f2 = M.f2_evaluator().evaluate(s)
    return spark.createDataFrame([(round(f2, 4),)], "f2 double")


@register("m17_isotonic_calibration")
def q_m17(spark, sf):
    """Calibrated on out-of-fold scores of the train part, applied to the test part."""
    train, test = TR.train_test(tx(spark, sf))
    pipe = M.build_pipeline(TR.MODEL_FEATURES, M.make_classifier("decision_tree", maxDepth=4))
    oof = M.out_of_fold_scores(pipe, materialize(L.stratified_folds(train, k=5), "folds"), 5)
    s = M.score(M.fit(pipe, train), test)
    return M.isotonic_calibrator(oof).transform(s.select("transaction_id", "p1", "is_fraud"))


@register("v6_feature_importance")
def q_v6(spark, sf):
    train, _ = TR.train_test(tx(spark, sf))
    m = M.fit(M.build_pipeline(TR.MODEL_FEATURES, M.make_classifier("gbt", maxIter=10, maxDepth=3)), train)
    return M.feature_importance(m.stages[-1], TR.MODEL_FEATURES, spark)


# ------------------------------------------------------------------ S1, S2

@register("s1_csv_scan_round_trip", ORACLE["s1_transactions"])
def q_s1csv(spark, sf):
    from fraudlens.sources import io as S
    path = S.scratch_path(spark, "tx-csv")
    S.write_table(tx(spark, sf), path, fmt="csv")
    return S.read_csv(spark, path, S.TRANSACTION_SCHEMA)


@register("s2_parquet_sink_round_trip", ORACLE["s1_transactions"])
def q_s2(spark, sf):
    from fraudlens.sources import io as S
    path = S.scratch_path(spark, "tx-parquet")
    S.write_table(tx(spark, sf), path)
    return spark.read.parquet(path)


@register("m13_deploy_scoring_all_rows")
def q_m13(spark, sf):
    """Deploy phase: a model fitted on the training split scores every row."""
    train, test = TR.train_test(tx(spark, sf))
    model = M.fit(M.build_pipeline(TR.MODEL_FEATURES, M.make_classifier("decision_tree", maxDepth=4)), train)
    return M.score(model, train.select(test.columns).unionByName(test))


@register("v6_split_counts_and_gain")
def q_v6b(spark, sf):
    from fraudlens.sources.io import scratch_path
    train, _ = TR.train_test(tx(spark, sf))
    m = M.fit(M.build_pipeline(TR.MODEL_FEATURES, M.make_classifier("gbt", maxIter=5, maxDepth=3)), train)
    return M.split_counts(m.stages[-1], TR.MODEL_FEATURES, spark, scratch_path(spark, "gbt-trees"))
