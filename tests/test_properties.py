"""Metamorphic and structural checks on the test tables."""
from pyspark.sql import functions as F

from fraudlens.operators import evaluate as V
from fraudlens.operators import sampling as L
from fraudlens.operators import windows as W
from fraudlens.plans.feature_job import build_transaction_features
from fraudlens.plans.flagship import scored_transactions
from fraudlens.sources import dims
from fraudlens.sources.tables import transactions


def _rows(df, key="transaction_id"):
    return sorted(tuple(r) for r in df.orderBy(key).collect())


def test_invariant_to_repartitioning(spark, sf_small):
    t = transactions(spark, sf_small)
    a = W.add_distinct_ip_window(t).select("transaction_id", "customer_id_distinct_ip_5d")
    b = W.add_distinct_ip_window(t.repartition(5, "transaction_id")).select("transaction_id", "customer_id_distinct_ip_5d")
    assert _rows(a) == _rows(b)


def test_distinct_ips_at_most_row_count(spark, sf_small):
    t = transactions(spark, sf_small)
    x = W.add_ma_trade_info_by_id(W.add_distinct_ip_window(t))
    bad = x.where(F.col("customer_id_distinct_ip_60d") > F.col("customer_id_ma_count_60d")).count()
    assert bad == 0


def test_confusion_cells_sum_to_n(spark, sf_small):
    t = transactions(spark, sf_small)
    c = V.confusion_counts(scored_transactions(t)).first()
    assert c["tp"] + c["fn"] + c["fp"] + c["tn"] == t.count()


def test_stratified_folds_balanced(spark, sf_small):
    t = transactions(spark, sf_small)
    f = L.stratified_folds(t, k=5).groupBy("is_fraud", "fold").count().collect()
    for lab in (0, 1):
        counts = [r["count"] for r in f if r["is_fraud"] == lab]
        assert max(counts) - min(counts) <= 1


def test_positions_are_a_permutation(spark, sf_small):
    t = transactions(spark, sf_small)
    p = W.add_time_position(t, num_partitions=4)
    n = t.count()
    agg = p.agg(F.min("position"), F.max("position"), F.count_distinct("position")).first()
    assert tuple(agg) == (0, n - 1, n)


def test_feature_plan_has_no_nested_loop_or_cartesian(spark, sf_small):
    t = transactions(spark, sf_small)
    f = build_transaction_features(t, dims.ip_ranges(spark), dims.country_timezone(spark), dims.holidays(spark),
                                   ip_thresholds=[2])
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_hot_key_split_matches_plain_windows(spark, sf_small):
    t = transactions(spark, sf_small).select("transaction_id", "transaction_date", "customer_id", "IP_address", "amount")
    plain = W.add_customer_window_features(t)
    split = W.add_customer_window_features(t, hot_threshold=20, bucket_days=2)
    cols = sorted(plain.columns)
    assert sorted(split.columns) == cols
    key = lambda r: repr(r)
    assert sorted((tuple(r) for r in plain.select(*cols).collect()), key=key) == \
        sorted((tuple(r) for r in split.select(*cols).collect()), key=key)


def _range_frames(t, windows):
    """W1 and W2 as plain RANGE frames."""
    from pyspark.sql import Window
    t = t.withColumn("_t", F.unix_micros(F.col("transaction_date").cast("timestamp")))
    ip = F.when(F.trim("IP_address") != "", F.col("IP_address"))
    cents = F.round(F.col("amount") * 100).cast("bigint")
    for w in windows:
        fr = Window.partitionBy("customer_id").orderBy("_t").rangeBetween(-w * 86_400_000_000, 0)
        t = t.withColumns({f"customer_id_distinct_ip_{w}d": F.size(F.collect_set(ip).over(fr)),
                           f"customer_id_ma_amount_{w}d": F.sum(cents).over(fr) / F.count("amount").over(fr) / 100.0,
                           f"customer_id_ma_count_{w}d": F.count("*").over(fr)})
    return t.drop("_t")


def _same(a, b):
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    assert sorted((tuple(r) for r in a.select(*cols).collect()), key=repr) == \
        sorted((tuple(r) for r in b.select(*cols).collect()), key=repr)


def test_event_sums_match_range_frames(spark, sf_small):
    t = transactions(spark, sf_small).select("transaction_id", "transaction_date", "customer_id", "IP_address", "amount")
    a = _range_frames(t, (1, 5, 28))
    for hot in (None, 0, 20):
        _same(a, W.add_window_features_by_events(t, (1, 5, 28), hot_threshold=hot))
    _same(a, W.add_window_features_by_events(t, (1, 5, 28), hot_threshold=0, bucket_days=3))


def test_event_sums_of_null_tied_and_repeated_rows(spark):
    import datetime as dt
    day = lambda d, us=0: dt.datetime(2024, 1, 1) + dt.timedelta(days=d, microseconds=us)
    rows = [(1, day(0), 1, "a", 1.0), (2, day(0), 1, "a", None), (3, day(1), 1, "a", 3.0), (4, day(1, 1), 1, "b", 4.0),
            (5, day(2, 2), 1, "a", 5.0), (6, day(9), 1, None, 6.0), (7, day(9), 1, " ", 7.0), (7, day(9), 1, " ", 7.0),
            (8, day(3), None, "a", 1.0), (9, day(3), None, "b", 2.0), (10, day(8), None, "a", 2.0),
            (11, None, 1, "a", 1.0), (12, None, 1, "a", 2.0), (13, None, 1, "c", None), (14, day(2), 2, "", None)]
    t = spark.createDataFrame(rows, "transaction_id long, transaction_date timestamp, customer_id long, IP_address string, "
                                    "amount double").withColumn("transaction_date", F.col("transaction_date").cast("timestamp_ntz"))
    a = _range_frames(t, (1, 5))
    for hot in (None, 0, 2):
        _same(a, W.add_window_features_by_events(t, (1, 5), hot_threshold=hot))
        _same(a.select("transaction_id"), W.add_customer_window_features(t, (1, 5), hot_threshold=hot).select("transaction_id"))
    _same(W.add_customer_window_features(t, (1, 5), hot_threshold=None), W.add_customer_window_features(t, (1, 5), hot_threshold=0))
    _same(a.limit(0), W.add_window_features_by_events(t.limit(0), (1, 5), hot_threshold=0))


def test_chained_windows_read_their_input_once(spark, sf_small):
    t = transactions(spark, sf_small)
    x = W.add_time_since_last_ip_per_customer(W.add_ma_trade_info_by_id(W.add_distinct_ip_window(t)))
    assert _plan(x).split("Initial Plan")[0].count("Scan parquet") == _plan(t).count("Scan parquet")


def test_hot_customers_of_ip_country_features(spark, sf_small):
    from fraudlens.operators import joins as J
    t = transactions(spark, sf_small).withColumn("IP_address_country_code", F.substring("merchant_category", 1, 2))
    t = t.select("transaction_id", "transaction_date", "customer_id", "IP_address_country_code")
    t = t.withColumn("customer_id", F.when(F.col("customer_id") % 5 > 0, F.col("customer_id") % 3))
    _same(J.add_previous_ip_country(t, hot_threshold=None), J.add_previous_ip_country(t, hot_threshold=0))
    cal = dims.holidays(spark)
    _same(J.add_recent_ip_country_holiday(t, cal, hot_threshold=None), J.add_recent_ip_country_holiday(t, cal, hot_threshold=0))


def test_pos_within_and_beyond_the_radius(spark):
    from fraudlens.operators import joins as J
    tx = spark.createDataFrame([(1, 1, 7, "pos"), (2, 1, 7, "card not present"), (3, 1, 8, "pos"), (4, None, 7, "pos")],
                               "transaction_id long, customer_id long, merchant_id long, card_present_or_not string")
    cust = spark.createDataFrame([(1, 0.0, 0.0)], "customer_id long, location_x double, location_y double")
    pos = spark.createDataFrame([(7, 1, 30.0, 40.0), (7, 2, 60.0, 0.0), (7, 3, None, 1.0)],
                                "merchant_id long, pos_id long, location_x double, location_y double")
    assert [tuple(r) for r in J.pos_within_radius(tx, cust, pos).collect()] == [(1, 1, 7, 1, 50.0)]
    assert [tuple(r) for r in J.pos_within_radius(tx, cust, pos, within=False).collect()] == [(1, 1, 7, 2, 60.0)]


def test_keyed_running_sum_across_partitions(spark):
    from fraudlens.operators.prefix import with_keyed_cumsum
    rows = [(k, i, 1.0) for k in (1, 2) for i in range(50)] + [(3, 0, 5.0)]
    df = spark.createDataFrame(rows, "k long, i long, v double")
    out = with_keyed_cumsum(df, "k", ["i"], ["v"], ["cv"], num_partitions=6)
    got = {(r["k"], r["i"]): r["cv"] for r in out.collect()}
    assert got[(1, 49)] == 50.0 and got[(2, 0)] == 1.0 and got[(2, 25)] == 26.0 and got[(3, 0)] == 5.0


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_ip_range_join_is_an_equi_join(spark, sf_small):
    from fraudlens.operators import joins as J
    x = J.add_ip_country(transactions(spark, sf_small).select("transaction_id", "IP_address"), dims.ip_ranges(spark))
    plan = _plan(x)
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_scalar_attach_plans_no_join(spark, sf_small):
    from fraudlens.operators import aggregates as A
    plan = _plan(A.value_share(transactions(spark, sf_small), "merchant_category", "is_fraud"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Subquery" in plan


def test_customer_windows_share_one_exchange(spark, sf_small):
    t = transactions(spark, sf_small)
    plan = _plan(W.add_customer_window_features(t, hot_threshold=None))
    shuffles = [l for l in plan.splitlines() if "Exchange hashpartitioning" in l]
    assert len(shuffles) == 1 and "customer_id" in shuffles[0]


def test_bucketed_table_skips_window_shuffle(spark, sf_small):
    from fraudlens.sources.io import save_bucketed
    t = transactions(spark, sf_small)
    b = save_bucketed(t, "tx_bucketed_test", "customer_id", 8, ["customer_id", "transaction_date"])
    x = W.add_customer_window_features(b, hot_threshold=None)
    plan = _plan(x)
    assert "Exchange hashpartitioning" not in plan
    plain = W.add_customer_window_features(t, hot_threshold=None)
    cols = sorted(plain.columns)
    key = lambda r: repr(r)
    assert sorted((tuple(r) for r in x.select(*cols).collect()), key=key) == \
        sorted((tuple(r) for r in plain.select(*cols).collect()), key=key)


def test_pos_within_radius_against_brute_force(spark):
    """Negative places, points on cell borders, exact radius, nulls; near and far together are all pairs of a merchant."""
    import math
    import random

    from fraudlens.operators.joins import pos_within_radius
    rnd = random.Random(3)
    place = lambda: rnd.choice([rnd.uniform(-20, 20), float(rnd.randint(-4, 4) * 5)])
    cust = [(i, place(), place()) for i in range(40)] + [(40, None, 1.0)]
    pos = [(m, m * 100 + i, place(), place()) for m in range(3) for i in range(60)] + [(0, 999, 0.0, None)]
    txs = [(i, rnd.randrange(42), rnd.randrange(4), "card present" if i % 5 else "card not present") for i in range(200)]
    t = spark.createDataFrame(txs, "transaction_id int, customer_id int, merchant_id int, card_present_or_not string")
    c = spark.createDataFrame(cust, "customer_id int, location_x double, location_y double")
    p = spark.createDataFrame(pos, "merchant_id int, pos_id int, location_x double, location_y double")
    where = {i: (x, y) for i, x, y in cust}
    pairs = [(i, q, math.dist(where[k], (x, y))) for i, k, m, card in txs if card == "card present" and k in where
             for m2, q, x, y in pos if m == m2 and None not in (*where[k], x, y)]
    for radius in (5.0, 0.5, 0.0):
        for within in (True, False):
            got = {(r.transaction_id, r.near_pos_id) for r in pos_within_radius(t, c, p, radius, within).collect()}
            assert got == {(i, q) for i, q, d in pairs if (d < radius) == within}
    plan = pos_within_radius(t, c, p)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
