"""Literal micro-fixtures for edge cases (nulls, ties, window bounds)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from fraudlens.functions import dates as D
from fraudlens.functions.strings import null_if_null_like
from fraudlens.operators import aggregates as A
from fraudlens.operators import evaluate as V
from fraudlens.operators import joins as J
from fraudlens.operators import prep as P
from fraudlens.operators import windows as W
from fraudlens.operators.rules import score_tree
from fraudlens.sources import dims

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)
SCHEMA = "transaction_id long, transaction_date timestamp_ntz, customer_id long, IP_address string, amount double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def col(df, name, order="transaction_id"):
    return [r[name] for r in df.orderBy(order).collect()]


def test_window_lower_bound_inclusive(spark):
    d = dt.timedelta(days=1)
    df = frame(spark, [(1, T0, 1, "A", 1.0), (2, T0 + d, 1, "B", 2.0), (3, T0 + d + dt.timedelta(seconds=1), 1, "C", 3.0)])
    w = W.add_ma_trade_info_by_id(W.add_distinct_ip_window(df, windows=(1,)), windows=(1,))
    assert col(w, "customer_id_ma_count_1d") == [1, 2, 2]
    assert col(w, "customer_id_distinct_ip_1d") == [1, 2, 2]


def test_reused_ip_inside_window(spark):
    h = dt.timedelta(hours=1)
    df = frame(spark, [(1, T0, 1, "A", 1.0), (2, T0 + 12 * h, 1, "A", 1.0), (3, T0 + 28 * h, 1, "B", 1.0)])
    assert col(W.add_distinct_ip_window(df, windows=(1,)), "customer_id_distinct_ip_1d") == [1, 1, 2]


def test_interleaved_customers(spark):
    h = dt.timedelta(hours=1)
    df = frame(spark, [(1, T0, 1, "A", 1.0), (2, T0 + h, 2, "B", 1.0), (3, T0 + 2 * h, 1, "C", 1.0)])
    out = W.add_distinct_ip_window(df, windows=(1, 5))
    assert col(out, "customer_id_distinct_ip_1d") == [1, 1, 2]
    assert col(out, "customer_id_distinct_ip_5d") == [1, 1, 2]


def test_null_and_blank_ip(spark):
    h = dt.timedelta(hours=1)
    df = frame(spark, [(1, T0, 1, None, 1.0), (2, T0 + h, 1, " ", 1.0), (3, T0 + 2 * h, 1, "A", 1.0)])
    assert col(W.add_distinct_ip_window(df, windows=(1,)), "customer_id_distinct_ip_1d") == [0, 0, 1]
    assert col(W.add_time_since_last_ip_per_customer(df), "seconds_since_last_ip") == [0.0, 0.0, 0.0]
    assert col(J.add_ip_used_by_many(df, [1]), "IP_used_by_1_customer_id_or_more") == [0, 1, 1]


def test_single_transaction(spark):
    df = frame(spark, [(1, T0, 1, "A", 5.5)])
    out = W.add_time_since_last_ip_per_customer(W.add_sec_since_last_trade(
        W.add_ma_trade_info_by_id(W.add_distinct_ip_window(df, windows=(1,)), windows=(1,))))
    r = out.first()
    assert (r["customer_id_distinct_ip_1d"], r["customer_id_ma_amount_1d"], r["customer_id_ma_count_1d"],
            r["customer_id_sec_since_last_trade"], r["seconds_since_last_ip"]) == (1, 5.5, 1, 0, 0.0)


def test_all_amounts_null(spark):
    df = frame(spark, [(1, T0, 1, "A", None), (2, T0 + dt.timedelta(hours=1), 1, "A", None)])
    out = W.add_ma_trade_info_by_id(df, windows=(1,))
    assert col(out, "customer_id_ma_amount_1d") == [None, None]
    assert col(out, "customer_id_ma_count_1d") == [1, 2]


def test_same_timestamp_peers(spark):
    df = frame(spark, [(1, T0, 1, "A", 1.0), (2, T0, 1, "B", 3.0)])
    out = W.add_ma_trade_info_by_id(W.add_distinct_ip_window(df, windows=(1,)), windows=(1,))
    assert col(out, "customer_id_ma_count_1d") == [2, 2]
    assert col(out, "customer_id_distinct_ip_1d") == [2, 2]
    assert col(out, "customer_id_ma_amount_1d") == [2.0, 2.0]


def test_unknown_and_null_country(spark):
    df = spark.createDataFrame([(1, "ZZ"), (2, None), (3, "JP")], "transaction_id long, IP_address_country_code string")
    out = J.add_country_timezone(df, dims.country_timezone(spark))
    assert col(out, "timezone") == ["UTC", None, "Asia/Tokyo"]


def test_ip_country_miss_and_hit(spark):
    df = spark.createDataFrame([(1, "11.0.0.1"), (2, "191.2.3.4"), (3, None), (4, "190.255.255.255")],
                               "transaction_id long, IP_address string")
    assert col(J.add_ip_country(df, dims.ip_ranges(spark)), "IP_address_country_code") == ["GB", None, None, "AU"]


def test_missing_timestamp(spark):
    df = spark.createDataFrame([(1, None)], "transaction_id long, t timestamp_ntz")
    r = df.select(D.sec_since_midnight("t").alias("s"), D.is_weekend("t").alias("w")).first()
    assert (r["s"], r["w"]) == (-999, 0)


def test_night_boundary(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 6, 59, 59),), (dt.datetime(2024, 1, 1, 7, 0, 0),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(D.is_night("t")).collect()] == [1, 0]


def test_season_boundary(spark):
    days = [dt.datetime(2023, 11, 23), dt.datetime(2023, 11, 24), dt.datetime(2023, 12, 31),
            dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6)]
    df = spark.createDataFrame([(d,) for d in days], "t timestamp_ntz")
    assert [r[0] for r in df.select(D.is_shopping_season("t")).collect()] == [0, 1, 1, 1, 0]


def test_constant_column(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "x double")
    assert P.VarianceThresholdFilter(["x"]).fit(df).transform(df).columns == []
    assert [r[0] for r in P.ZeroOneScaler(["x"]).fit(df).transform(df).collect()] == [0.0, 0.0, 0.0]


def test_null_like_strings(spark):
    df = spark.createDataFrame([("NA",), ("--",), ("na ",), ("x",)], "s string")
    assert [r[0] for r in df.select(null_if_null_like("s")).collect()] == [None, None, "na ", "x"]


def test_null_group_key_dropped(spark):
    df = spark.createDataFrame([(None, 1), (None, 0), ("a", 1)], "merchant_category string, is_fraud int")
    out = A.group_rate(df, "merchant_category").collect()
    assert [r["merchant_category"] for r in out] == ["a"]


def test_tied_modes(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (1, "b")], "k long, v string")
    assert A.modal_value(df, ["k"], "v").first()["mode_v"] == "a"


def test_amount_bin_edges(spark):
    df = spark.createDataFrame([(0.0, 0), (9.99, 0), (10.0, 0), (5000.0, 1)], "amount double, is_fraud int")
    out = {r["amount_bin"]: (r["n_legit"], r["n_fraud"]) for r in A.amount_bins(df).collect()}
    assert out["[0, 10)"] == (2, 0) and out["[10, 50)"] == (1, 0) and out["[5000, inf)"] == (0, 1)
    assert out["[50, 100)"] == (0, 0)


def test_no_predicted_positives(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "is_fraud int, prediction int")
    r = V.summary_scores(df).first()
    assert (r["f2"], r["recall"], r["precision"]) == (0.0, 0.0, 0.0)


def test_tied_scores_one_curve_point(spark):
    df = spark.createDataFrame([(1, 0.7), (0, 0.7), (1, 0.2)], "is_fraud int, p1 double")
    pts = V.pr_curve(df).orderBy(F.desc("threshold")).collect()
    assert [(p["threshold"], p["precision"], p["recall"]) for p in pts] == [(0.7, 0.5, 0.5), (0.2, 0.666667, 1.0)]
    ap = V.average_precision(df).first()[0]
    assert ap == pytest.approx(0.5 * 0.5 + 0.5 * (2 / 3), abs=1e-6)


def test_tree_null_goes_no_branch(spark):
    df = spark.createDataFrame([(None, 0, 0.0, 0, 100)], "customer_id_distinct_ip_1d int, IP_used_by_2_customer_id_or_more int, "
                               "seconds_since_last_ip double, card_present_or_not int, transaction_date_sec_since_midnight int")
    # NULL distinct-IP count -> "no" branch (node 2) -> seconds < 120 -> card < 1 -> leaf 1.54906702
    assert score_tree(df).first()["margin"] == pytest.approx(1.54906702)


def test_quantiles_keep_null_groups(spark):
    from fraudlens.operators import profile as G
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, 6.0), ("b", None)], "g string, v double")
    assert {r.g: r._q for r in G.quantiles(df, "v", [0.5], "g").collect()} == {"a": [2.0], None: [5.5]}
    d = {r.g: (r["count"], r.p50) for r in G.describe_numeric(df, ["v"], "g").collect()}
    assert d == {"a": (2, 2.0), None: (2, 5.5), "b": (0, None)}
    assert {r.g for r in G.box_stats(df, "v", "g").collect()} == {"a", None}


def test_keyed_running_sum_of_null_key(spark):
    from fraudlens.operators.prefix import with_keyed_cumsum
    df = spark.createDataFrame([(None, i, 1.0) for i in range(40)] + [("x", 0, 7.0)], "k string, i long, v double")
    got = {(r.k, r.i): r.c for r in with_keyed_cumsum(df, "k", ["i"], ["v"], ["c"], num_partitions=4).collect()}
    assert got == {**{(None, i): i + 1.0 for i in range(40)}, ("x", 0): 7.0}


def test_spearman_is_pairwise(spark):
    import pandas as pd
    from fraudlens.operators import profile as G
    p = pd.DataFrame({"a": [1.0, 2, 3, 4, 5, 6], "b": [2.0, 1, 4, 3, 6, 5], "c": [1.0, None, 2, 5, None, 3]})
    df = spark.createDataFrame([tuple(None if pd.isna(x) else x for x in r) for r in p.itertuples(index=False)],
                               "a double, b double, c double")
    want = p.corr("spearman")
    for r in G.spearman_pairs(df, ["a", "b", "c"]).collect():
        assert abs(r.spearman - want.loc[r.feature_1, r.feature_2]) < 1e-4


def test_vif_of_constant_and_collinear_columns(spark):
    from fraudlens.operators import profile as G
    df = spark.createDataFrame([(float(i), 2.0 * i, 1.0, float(i * i % 7)) for i in range(1, 20)], "a double, b double, k double, d double")
    got = {r.feature: r.vif for r in G.vif(df, ["a", "b", "k", "d"]).collect()}
    assert set(got) == {"a", "b", "d"} and got["a"] == got["b"] == float("inf") and got["d"] < 10


def test_schema_checks(spark):
    from fraudlens.operators import quality as Q
    sheet = spark.createDataFrame([("a", "str", "N", "N"), ("b", "int", "Y", "N"), ("zz", "str", "Y", "N")],
                                  "column_name string, data_type string, nullable string, is_categorical string")
    df = spark.createDataFrame([("x", "1")], "a string, b string")
    assert [r.column_name for r in Q.check_missing_columns(df, sheet).collect()] == ["zz"]
    assert [(r.column_name, r.actual) for r in Q.check_data_types(df, sheet).collect()] == [("b", "string")]
