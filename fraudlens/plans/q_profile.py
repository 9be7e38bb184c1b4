"""Registered queries: projections/cleaning (P), checks (Q), statistics (G),
grouped reports (A), sorts (T), set operations (U)."""
from __future__ import annotations

from pyspark.sql import functions as F

from fraudlens.functions.ip import first_octet
from fraudlens.operators import aggregates as A
from fraudlens.operators import profile as G
from fraudlens.operators import quality as Q
from fraudlens.plans.oracle import DERIVED_CTES, with_tx
from fraudlens.plans.registry import register, tbl, tx
from fraudlens.sources import derived, dims
from fraudlens.sources.dims import DOMAIN_DROP

TX_COLS = ["transaction_id", "transaction_date", "customer_id", "amount", "date_in_sec", "day_no", "merchant_id",
           "pos_id", "merchant_established_date", "MCCs", "merchant_category", "IP_address", "type_of_credit_card_used",
           "card_present_or_not", "store_card_merchant_id", "is_fraud"]
STR_COLS = ["merchant_category", "IP_address", "type_of_credit_card_used", "card_present_or_not"]


def MM(c):
    """SQL twin of the fixed-point money mean."""
    return f"(CASE WHEN count({c}) > 0 THEN sum(CAST(round({c} * 100.0) AS BIGINT)) / count({c}) / 100.0 END)"


def RATE(c="is_fraud"):
    return f"(sum(CAST({c} AS BIGINT)) / count(*))"


def _union(parts):
    return "\nUNION ALL ".join(parts)


# ------------------------------------------------------------------ P

_P1_CASTS = {"transaction_id": "BIGINT", "transaction_date": "TIMESTAMP", "customer_id": "BIGINT", "amount": "DOUBLE",
             "date_in_sec": "BIGINT", "day_no": "BIGINT", "merchant_id": "BIGINT", "pos_id": "BIGINT",
             "merchant_established_date": "TIMESTAMP", "MCCs": "INTEGER", "merchant_category": "VARCHAR",
             "IP_address": "VARCHAR", "type_of_credit_card_used": "VARCHAR", "card_present_or_not": "VARCHAR",
             "store_card_merchant_id": "BIGINT", "is_fraud": "BOOLEAN"}


@register("p1_convert_datatypes", with_tx("SELECT " + ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in _P1_CASTS.items())
                                          + " FROM transactions"))
def q_p1(spark, sf):
    return Q.convert_datatypes(tx(spark, sf), dims.data_schema(spark))[0]


_NOTES = ["NA", "--", "na ", "x", "missing", "ok", " "]


@register("p2_replace_null_like", with_tx("SELECT transaction_id, " + ", ".join(
    f"CASE WHEN {c} IN ('NA','N/A','null','NULL','-','',' ','--','na','NaN','missing','Missing') THEN NULL ELSE {c} END AS {c}"
    for c in STR_COLS + ["note"]) + " FROM (SELECT *, (['" + "','".join(_NOTES) + "'])[CAST(transaction_id % 7 + 1 AS INTEGER)] AS note FROM transactions)"))
def q_p2(spark, sf):
    t = tx(spark, sf).withColumn("note", F.element_at(F.array(*[F.lit(n) for n in _NOTES]),
                                                      (F.col("transaction_id") % 7 + 1).cast("int")))
    return Q.replace_null_like_values(t.select("transaction_id", *STR_COLS, "note"))


_KEPT = [c for c in TX_COLS if c not in DOMAIN_DROP]


@register("p3_drop_pointless_feats", with_tx("SELECT " + ", ".join(_KEPT) + " FROM transactions"))
def q_p3(spark, sf):
    return Q.drop_columns(tx(spark, sf), DOMAIN_DROP + ["not_a_column"])


@register("p4_features_projection", with_tx("SELECT " + ", ".join(c for c in TX_COLS if c != "is_fraud") + " FROM transactions"))
def q_p4(spark, sf):
    return Q.features_and_target(tx(spark, sf), "is_fraud")[0]


@register("p5_fraud_rows", with_tx("SELECT * FROM transactions WHERE is_fraud = 1"))
def q_p5(spark, sf):
    return tx(spark, sf).where(F.col("is_fraud") == 1)


@register("p6_amount_below_threshold", with_tx("SELECT * FROM transactions WHERE amount < 2000"))
def q_p6(spark, sf):
    return Q.below_threshold(tx(spark, sf), "amount", 2000)


_NUM = ["transaction_id", "customer_id", "amount", "date_in_sec", "day_no", "merchant_id", "pos_id", "MCCs",
        "store_card_merchant_id", "is_fraud"]


@register("p7_numeric_columns", with_tx("SELECT " + ", ".join(_NUM) + " FROM transactions"))
def q_p7(spark, sf):
    t = tx(spark, sf)
    return t.select(*Q.numeric_columns(t))


_KINDS = _union([
    f"""SELECT '{c}' AS column_name, CASE WHEN count(DISTINCT {c}) <= 2 AND CAST(min({c}) AS DOUBLE) IN (0.0, 1.0)
        AND CAST(max({c}) AS DOUBLE) IN (0.0, 1.0) THEN 'binary' WHEN min({c}) < 0 OR max({c}) > 1 THEN 'non_normalised'
        ELSE 'normalised' END AS kind FROM transactions""" for c in _NUM])


@register("p8_non_norm_identifier", with_tx(_KINDS))
def q_p8(spark, sf):
    return Q.non_norm_identifier(tx(spark, sf))


@register("p9_split_num_and_cat", with_tx("""
SELECT kind AS column_group, column_name FROM kinds WHERE kind <> 'normalised'
UNION ALL SELECT 'other', column_name FROM cols WHERE column_name NOT IN (SELECT column_name FROM kinds)
UNION ALL SELECT CASE WHEN is_int THEN 'non_normalised_int' ELSE 'non_normalised_float' END, column_name
  FROM cols JOIN kinds USING (column_name) WHERE kind = 'non_normalised'
UNION ALL SELECT 'no_pipe', column_name FROM cols WHERE column_name NOT LIKE '%|%'""",
    extra="kinds AS (" + _KINDS + "),\ncols AS (" + _union([
        f"SELECT '{c}' AS column_name, coalesce(any_value(typeof({c})) IN ('SMALLINT', 'INTEGER', 'BIGINT'), false) AS is_int FROM transactions"
        for c in TX_COLS]) + ")"))
def q_p9(spark, sf):
    t = tx(spark, sf)
    groups = Q.split_num_and_cat(t)
    rows = [(g, c) for g, cs in groups.items() for c in cs]
    return spark.createDataFrame(rows, "column_group string, column_name string")


@register("p11_trim_reporting_period", """
WITH b AS (SELECT date_trunc('month', CAST(min(o_orderdate) AS DATE) + 400) AS end_m,
                  max(o_orderdate) > CAST(CAST(min(o_orderdate) AS DATE) + 400 AS TIMESTAMP) AS past FROM orders)
SELECT o.* FROM orders o, b WHERE NOT b.past OR date_trunc('month', CAST(o.o_orderdate AS DATE)) <= b.end_m""")
def q_p11(spark, sf):
    return Q.trim_reporting_period(tbl(spark, sf, "orders"), 400, "o_orderdate")


@register("p12_null_policy", with_tx("SELECT * FROM transactions WHERE IP_address IS NOT NULL"))
def q_p12(spark, sf):
    return Q.enforce_null_policy(tx(spark, sf), ["IP_address"])


@register("p13_first_octet", with_tx("SELECT transaction_id, split_part(IP_address, '.', 1) AS ip_first_octet FROM transactions"))
def q_p13(spark, sf):
    return tx(spark, sf).select("transaction_id", first_octet("IP_address").alias("ip_first_octet"))


# ------------------------------------------------------------------ Q

_NOT_NULL = [r[0] for r in dims.DATA_SCHEMA if r[2] == "N" and r[0] in TX_COLS]


@register("q2_non_nullable_violation", with_tx(_union([
    f"SELECT '{c}' AS column_name, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null, "
    f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) > 0 AS violation FROM transactions" for c in _NOT_NULL])))
def q_q2(spark, sf):
    return Q.check_non_nullable_violation(tx(spark, sf), dims.data_schema(spark))


@register("q4_non_negative_violations", _union([
    f"SELECT '{c}' AS column_name, CAST(coalesce(sum(CASE WHEN {c} < 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_negative FROM customer"
    for c in ["c_custkey", "c_nationkey", "c_acctbal"]]))
def q_q4(spark, sf):
    return Q.check_non_negative_violations(tbl(spark, sf, "customer"))


_CAT = {r[0]: r[3] == "Y" for r in dims.DATA_SCHEMA if r[0] in TX_COLS}


@register("q5_categorical_check", with_tx("SELECT * FROM (" + _union([
    f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct, CASE WHEN {str(m).lower()} AND "
    f"count(DISTINCT {c}) >= 50 THEN 'too_many_levels' WHEN NOT {str(m).lower()} AND count(DISTINCT {c}) <= 30 "
    f"THEN 'maybe_categorical' END AS finding FROM transactions" for c, m in _CAT.items()]) + ") WHERE finding IS NOT NULL"))
def q_q5(spark, sf):
    return Q.check_categorical_features(tx(spark, sf), dims.data_schema(spark))


@register("q6_null_counts", with_tx("SELECT * FROM (" + _union([
    f"SELECT '{c}' AS column_name, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null FROM transactions"
    for c in TX_COLS]) + ") WHERE n_null > 0"))
def q_q6(spark, sf):
    return Q.null_counts(tx(spark, sf)).where(F.col("n_null") > 0)


@register("q7_duplicate_rows", with_tx("""SELECT n_rows, n_distinct_rows, n_rows > n_distinct_rows AS has_duplicates FROM
  (SELECT count(*) AS n_rows FROM transactions),
  (SELECT count(*) AS n_distinct_rows FROM (SELECT DISTINCT * FROM transactions))"""))
def q_q7(spark, sf):
    return Q.duplicate_summary(tx(spark, sf))


@register("q8_distinct_counts", with_tx(_union([
    f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM transactions" for c in TX_COLS])))
def q_q8(spark, sf):
    return Q.distinct_counts(tx(spark, sf))


# ------------------------------------------------------------------ G

def _g1_body(c, src):
    return f"""SELECT round(avg({c}), 4) AS mean, round(quantile_cont({c}, 0.5), 4) AS median,
  round(skewness({c}), 4) AS skew, round(kurtosis({c}), 4) AS kurtosis FROM {src}"""


@register("g1_amount_stats", with_tx(_g1_body("amount", "transactions")))
def q_g1(spark, sf):
    return G.prt_stats(tx(spark, sf), "amount")


_DESC_COLS = ["amount", "day_no", "MCCs", "merchant_id"]


def _describe_sql(cols, src, by=None):
    keep = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    return _union([f"""SELECT {keep}'{c}' AS column_name, CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 4) AS mean,
  round(stddev_samp({c}), 4) AS std, round(CAST(min({c}) AS DOUBLE), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS p25,
  round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75,
  round(CAST(max({c}) AS DOUBLE), 4) AS max FROM {src}{grp}""" for c in cols])


@register("g2_describe_numeric", with_tx(_describe_sql(_DESC_COLS, "transactions")))
def q_g2(spark, sf):
    return G.describe_numeric(tx(spark, sf), _DESC_COLS)


_CATS = ["merchant_category", "type_of_credit_card_used", "card_present_or_not"]


@register("g2_describe_categorical", with_tx(_union([f"""SELECT '{c}' AS column_name, CAST(sum(f) AS BIGINT) AS count,
  CAST(count(*) AS BIGINT) AS unique, CAST(arg_min(v, (-f, v)) AS VARCHAR) AS top, CAST(max(f) AS BIGINT) AS freq
  FROM (SELECT {c} AS v, count(*) AS f FROM transactions WHERE {c} IS NOT NULL GROUP BY 1)""" for c in _CATS])))
def q_g2c(spark, sf):
    return G.describe_categorical(tx(spark, sf), _CATS)


@register("g3_describe_amount_by_label", with_tx(_describe_sql(["amount"], "transactions", by="is_fraud")))
def q_g3(spark, sf):
    return G.describe_numeric(tx(spark, sf), ["amount"], by="is_fraud")


@register("g4_overview", with_tx("SELECT count(*) AS n_rows, CAST(16 AS BIGINT) AS n_cols, false AS wide_table_warning FROM transactions"))
def q_g4(spark, sf):
    return G.overview(tx(spark, sf))


@register("g5_class_balance", with_tx("""SELECT is_fraud, n, n / sum(n) OVER () AS share, sum(n) OVER () / min(n) OVER () AS class_weight
  FROM (SELECT is_fraud, count(*) AS n FROM transactions GROUP BY 1)"""))
def q_g5(spark, sf):
    return G.class_balance(tx(spark, sf))


@register("g6_imbalance", """SELECT n0, n1, CASE WHEN n1 > 0 THEN round(n0 / n1, 4) END AS ratio,
  coalesce(round(n0 / n1, 4) > 5, true) AS imbalanced FROM (SELECT CAST(sum(CASE WHEN toxic = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n0,
  CAST(sum(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n1 FROM labels)""")
def q_g6(spark, sf):
    return G.imbalance(tbl(spark, sf, "labels"), "toxic")


@register("g7_basic_stats", with_tx("""SELECT count(*) AS n_rows, CAST(sum(is_fraud) AS BIGINT) AS n_fraud,
  100.0 * sum(is_fraud) / count(*) AS fraud_pct, min(transaction_date) AS min_date, max(transaction_date) AS max_date,
  CAST(sum(CASE WHEN amount IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null_amount, count(DISTINCT customer_id) AS n_customers
  FROM transactions"""))
def q_g7(spark, sf):
    return G.basic_stats(tx(spark, sf))


# the numeric columns of lineitem, for the SQL twins; the queries take them from the schema
_LI = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_PAIRS = [(a, b) for i, a in enumerate(_LI) for b in _LI[i + 1:]]


@register("g8_pearson_pairs", _union([f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, round(corr({a}, {b}), 4) AS corr FROM lineitem"
                                      for a, b in _PAIRS]))
def q_g8(spark, sf):
    return G.correlation_pairs(tbl(spark, sf, "lineitem"))


_RANKS = ",\n".join(f"""r_{c} AS (SELECT v, sum(cnt) OVER (ORDER BY v) - cnt + (cnt + 1) / 2.0 AS rk
  FROM (SELECT {c} AS v, count(*) AS cnt FROM lineitem WHERE {c} IS NOT NULL GROUP BY 1))""" for c in _LI)


SPEARMAN_CTES = ("WITH " + _RANKS + ",\nrk AS (SELECT " + ", ".join(f"r_{c}.rk AS {c}" for c in _LI)
                 + " FROM lineitem " + " ".join(f"LEFT JOIN r_{c} ON lineitem.{c} = r_{c}.v" for c in _LI) + ")")


@register("g9_spearman_pairs", SPEARMAN_CTES + "\n"
          + _union([f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, round(corr({a}, {b}), 4) AS spearman, "
                    f"round(abs(corr({a}, {b})), 4) AS abs_spearman FROM rk" for a, b in _PAIRS]))
def q_g9(spark, sf):
    li = tbl(spark, sf, "lineitem")
    return G.spearman_pairs(li, G.numeric_columns(li))


def _vif_sql(cols: list[str]) -> str:
    """The inverse of the matrix of sums by one sweep a column; VIF is the product of both diagonals."""
    n = range(len(cols))
    at = lambda i, j: f"m{i}_{j}"
    steps = ["g0 AS (SELECT " + ", ".join(f"sum(CAST({cols[i]} AS DOUBLE) * CAST({cols[j]} AS DOUBLE)) AS {at(i, j)}" for i in n for j in n)
             + " FROM lineitem WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in cols) + ")"]
    for k in n:
        d = at(k, k)
        cell = lambda i, j: (f"1 / {d}" if i == j == k else f"{at(k, j)} / {d}" if i == k else f"-{at(i, k)} / {d}" if j == k
                             else f"{at(i, j)} - {at(i, k)} * {at(k, j)} / {d}")
        steps.append(f"g{k + 1} AS (SELECT " + ", ".join(f"{cell(i, j)} AS {at(i, j)}" for i in n for j in n) + f" FROM g{k})")
    last = f"g{len(cols)}"
    return "WITH " + ",\n".join(steps) + "\n" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(g0.{at(i, i)} * {last}.{at(i, i)}, 4) AS vif FROM g0, {last}" for i, c in enumerate(cols))


@register("g10_vif", _vif_sql(_LI))
def q_g10(spark, sf):
    li = tbl(spark, sf, "lineitem")
    return G.vif(li, G.numeric_columns(li))


@register("g11_histogram_amount", with_tx("""
, b AS (SELECT min(amount) AS mn, max(amount) AS mx FROM transactions),
c AS (SELECT CAST(CASE WHEN mx - mn = 0 THEN 0 ELSE least(floor((amount - mn) / (mx - mn) * 50), 49) END AS INTEGER) AS bin,
             count(*) AS n FROM transactions, b WHERE amount IS NOT NULL GROUP BY 1)
SELECT CAST(s.bin AS INTEGER) AS bin, round(mn + s.bin * ((mx - mn) / 50), 4) AS lower,
       round(mn + (s.bin + 1) * ((mx - mn) / 50), 4) AS upper, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM b, (SELECT unnest(range(0, 50)) AS bin) s LEFT JOIN c ON s.bin = c.bin""".replace("\n, b AS", "b AS", 1)
          ).replace("\nb AS (SELECT min", ",\nb AS (SELECT min", 1))
def q_g11(spark, sf):
    return G.histogram(tx(spark, sf), "amount", 50)


@register("g12_box_stats_by_label", with_tx("""
SELECT q.is_fraud, round(q1, 4) AS q1, round(med, 4) AS median, round(q3, 4) AS q3, round(q1 - 1.5 * (q3 - q1), 4) AS lower_fence,
  round(q3 + 1.5 * (q3 - q1), 4) AS upper_fence,
  CAST(sum(CASE WHEN t.amount < q1 - 1.5 * (q3 - q1) OR t.amount > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers
FROM transactions t JOIN (SELECT is_fraud, quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.5) AS med,
                                 quantile_cont(amount, 0.75) AS q3 FROM transactions GROUP BY 1) q ON t.is_fraud = q.is_fraud
GROUP BY q.is_fraud, q1, med, q3"""))
def q_g12(spark, sf):
    return G.box_stats(tx(spark, sf), "amount", by="is_fraud")


_PART = [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
         ("p_size", "int"), ("p_retailprice", "double")]


@register("g13_profile_part", _union([f"""SELECT '{c}' AS column_name, '{t}' AS data_type,
  CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct,
  CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM part""" for c, t in _PART]))
def q_g13(spark, sf):
    return G.profile(tbl(spark, sf, "part"))


@register("g14_amount_q99", with_tx("SELECT round(quantile_cont(amount, 0.99), 4) AS q99 FROM transactions"))
def q_g14(spark, sf):
    return G.quantile(tx(spark, sf), "amount", 0.99)


# ------------------------------------------------------------------ A

@register("a1_value_share", with_tx("""SELECT merchant_category, n, CAST(100 AS DOUBLE) * n / tot AS pct, n_fraud,
  CASE WHEN totf > 0 THEN CAST(100 AS DOUBLE) * n_fraud / totf END AS pct_fraud
  FROM (SELECT merchant_category, count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS n_fraud FROM transactions
        WHERE merchant_category IS NOT NULL GROUP BY 1),
       (SELECT count(*) AS tot, sum(is_fraud) AS totf FROM transactions)"""))
def q_a1(spark, sf):
    return A.value_share(tx(spark, sf), "merchant_category", "is_fraud")


@register("a2_top_merchants_by_count", with_tx(
    "SELECT merchant_id, count(*) AS n FROM transactions GROUP BY 1 ORDER BY n DESC, merchant_id LIMIT 20"))
def q_a2(spark, sf):
    return A.analyze_merchants(tx(spark, sf))[0]


@register("a2_top_merchants_by_fraud_rate", with_tx(
    f"SELECT merchant_id, {RATE()} AS fraud_rate FROM transactions GROUP BY 1 ORDER BY fraud_rate DESC, merchant_id LIMIT 10"))
def q_a2b(spark, sf):
    return A.analyze_merchants(tx(spark, sf))[1]


@register("a3_customer_count_describe", with_tx(
    "SELECT * FROM (" + _describe_sql(["n", "n_fraud"], "(SELECT customer_id, count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS n_fraud FROM transactions GROUP BY 1)") + ")"))
def q_a3(spark, sf):
    return G.describe_numeric(A.customer_counts(tx(spark, sf)), ["n", "n_fraud"])


@register("a3_top_customers", with_tx("""SELECT customer_id, count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS n_fraud
  FROM transactions GROUP BY 1 ORDER BY n DESC, customer_id LIMIT 10"""))
def q_a3b(spark, sf):
    return A.top_k(A.customer_counts(tx(spark, sf)), [F.desc("n"), "customer_id"], 10)


@register("a4_mcc_fraud_rate", with_tx(
    f"SELECT MCCs, count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS n_fraud, {RATE()} AS fraud_rate FROM transactions GROUP BY 1"))
def q_a4(spark, sf):
    return A.group_rate(tx(spark, sf), "MCCs")


@register("a5_octet_fraud_rate_top20", with_tx(f"""SELECT octet, {RATE()} AS fraud_rate FROM
  (SELECT split_part(IP_address, '.', 1) AS octet, is_fraud FROM transactions WHERE IP_address IS NOT NULL)
  GROUP BY 1 ORDER BY fraud_rate DESC, octet LIMIT 20"""))
def q_a5(spark, sf):
    t = tx(spark, sf).where(F.col("IP_address").isNotNull()).withColumn("octet", first_octet("IP_address"))
    return A.top_k(A.group_rate(t, "octet").select("octet", "fraud_rate"), [F.desc("fraud_rate"), "octet"], 20)


@register("a5_octet_fraud_count_top10", with_tx("""SELECT split_part(IP_address, '.', 1) AS octet, count(*) AS n_fraud
  FROM transactions WHERE is_fraud = 1 AND IP_address IS NOT NULL GROUP BY 1 ORDER BY n_fraud DESC, octet LIMIT 10"""))
def q_a5b(spark, sf):
    t = tx(spark, sf).where((F.col("is_fraud") == 1) & F.col("IP_address").isNotNull())
    g = t.groupBy(first_octet("IP_address").alias("octet")).agg(F.count(F.lit(1)).alias("n_fraud"))
    return A.top_k(g, [F.desc("n_fraud"), "octet"], 10)


@register("a6_customer_fraud_patterns_top10", with_tx(f"""SELECT customer_id, count(transaction_date) AS transaction_count,
  (max(epoch_us(transaction_date)) - min(epoch_us(transaction_date))) / 3.6e9 AS time_span_hours,
  {MM('amount')} AS mean_amount, sum(CAST(round(amount * 100.0) AS BIGINT)) / 100.0 AS total_amount
  FROM transactions WHERE is_fraud = 1 GROUP BY 1 ORDER BY transaction_count DESC, customer_id LIMIT 10"""))
def q_a6(spark, sf):
    f = tx(spark, sf).where(F.col("is_fraud") == 1)
    return A.top_k(A.customer_fraud_patterns(f), [F.desc("transaction_count"), "customer_id"], 10)


@register("a7_store_card_merchants_top10", with_tx(f"""SELECT store_card_merchant_id, {RATE()} AS fraud_rate,
  count(customer_id) AS n_customer_rows FROM transactions WHERE store_card_merchant_id IS NOT NULL GROUP BY 1
  ORDER BY fraud_rate DESC, store_card_merchant_id LIMIT 10"""))
def q_a7(spark, sf):
    return A.top_k(A.store_card_merchants(tx(spark, sf)), [F.desc("fraud_rate"), "store_card_merchant_id"], 10)


@register("a8_customer_behavior_top10", with_tx(f"""SELECT customer_id, {MM('amount')} AS mean_amount,
  round(stddev_samp(amount), 4) AS std_amount, count(amount) AS n_amount, CAST(sum(is_fraud) AS BIGINT) AS n_fraud
  FROM transactions GROUP BY 1 ORDER BY n_amount DESC, customer_id LIMIT 10"""))
def q_a8(spark, sf):
    return A.top_k(A.customer_behavior(tx(spark, sf)), [F.desc("n_amount"), "customer_id"], 10)


@register("a9_card_presence_crosstab", with_tx("""SELECT card_present_or_not,
  CAST(100 AS DOUBLE) * sum(CASE WHEN is_fraud = 0 THEN 1 ELSE 0 END) / count(*) AS pct_0,
  CAST(100 AS DOUBLE) * sum(CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END) / count(*) AS pct_1
  FROM transactions WHERE card_present_or_not IS NOT NULL GROUP BY 1"""))
def q_a9(spark, sf):
    return A.normalized_crosstab(tx(spark, sf), "card_present_or_not", "is_fraud")


@register("a10_by_hour", with_tx(f"""SELECT CAST(hour(transaction_date) AS INTEGER) AS hour, count(*) AS n,
  CAST(sum(is_fraud) AS BIGINT) AS n_fraud, {RATE()} AS fraud_rate FROM transactions GROUP BY 1"""))
def q_a10(spark, sf):
    return A.by_time_part(tx(spark, sf), "hour")


@register("a10_by_weekday", with_tx(f"""SELECT CAST(isodow(transaction_date) - 1 AS INTEGER) AS weekday, count(*) AS n,
  CAST(sum(is_fraud) AS BIGINT) AS n_fraud, {RATE()} AS fraud_rate FROM transactions GROUP BY 1"""))
def q_a10b(spark, sf):
    return A.by_time_part(tx(spark, sf), "weekday")


@register("a10_by_day_of_month", with_tx(f"""SELECT CAST(dayofmonth(transaction_date) AS INTEGER) AS day, count(*) AS n,
  CAST(sum(is_fraud) AS BIGINT) AS n_fraud, {RATE()} AS fraud_rate FROM transactions GROUP BY 1"""))
def q_a10c(spark, sf):
    return A.by_time_part(tx(spark, sf), "day")


@register("a11_daily_trend", with_tx("""SELECT CAST(CAST(transaction_date AS DATE) AS VARCHAR) AS date, count(*) AS n,
  CAST(sum(is_fraud) AS BIGINT) AS n_fraud FROM transactions GROUP BY 1"""))
def q_a11(spark, sf):
    return A.daily_trend(tx(spark, sf)).withColumn("date", F.col("date").cast("string"))


@register("a12_transaction_statistics", with_tx("""SELECT day_no, value, stat_type FROM (
  SELECT day_no, count(customer_id) / 50.0 AS a, CAST(sum(is_fraud) AS DOUBLE) AS b,
         CAST(count(DISTINCT CASE WHEN is_fraud > 0 THEN customer_id END) AS DOUBLE) AS c FROM transactions GROUP BY 1)
  UNPIVOT (value FOR stat_type IN (a AS 'nb_tx_per_day', b AS 'nb_fraud_per_day', c AS 'nb_fraudcard_per_day'))"""))
def q_a12(spark, sf):
    return A.transaction_statistics(tx(spark, sf))


@register("a13_card_type_fraud_rate", with_tx(f"""SELECT type_of_credit_card_used, count(*) AS n,
  CAST(sum(is_fraud) AS BIGINT) AS n_fraud, {RATE()} AS fraud_rate FROM transactions
  WHERE type_of_credit_card_used IS NOT NULL GROUP BY 1"""))
def q_a13(spark, sf):
    return A.group_rate(tx(spark, sf), "type_of_credit_card_used")


@register("a13_mcc_top10_by_rate", with_tx(f"""SELECT MCCs, count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS n_fraud,
  {RATE()} AS fraud_rate FROM transactions GROUP BY 1 ORDER BY fraud_rate DESC, MCCs LIMIT 10"""))
def q_a13b(spark, sf):
    return A.top_k(A.group_rate(tx(spark, sf), "MCCs"), [F.desc("fraud_rate"), "MCCs"], 10)


_EDGES = (0, 10, 50, 100, 500, 1000, 5000)
_BIN_LABELS = [f"[{a}, {b})" for a, b in zip(_EDGES, _EDGES[1:])] + [f"[{_EDGES[-1]}, inf)"]


@register("a14_amount_bins", with_tx("""SELECT CAST(b.bin AS INTEGER) AS bin, b.amount_bin, CAST(coalesce(c.n_legit, 0) AS BIGINT) AS n_legit,
  CAST(coalesce(c.n_fraud, 0) AS BIGINT) AS n_fraud FROM (VALUES """ + ", ".join(f"({i}, '{l}')" for i, l in enumerate(_BIN_LABELS))
  + """) b(bin, amount_bin) LEFT JOIN (SELECT CASE """ + " ".join(
      f"WHEN amount >= {a} AND amount < {b} THEN {i}" for i, (a, b) in enumerate(zip(_EDGES, _EDGES[1:])))
  + f""" WHEN amount >= {_EDGES[-1]} THEN {len(_EDGES) - 1} END AS bin, sum(CASE WHEN is_fraud = 0 THEN 1 ELSE 0 END) AS n_legit,
  sum(CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END) AS n_fraud FROM transactions WHERE amount >= 0 GROUP BY 1) c ON b.bin = c.bin"""))
def q_a14(spark, sf):
    return A.amount_bins(tx(spark, sf), edges=_EDGES)


@register("a15_top5_fraud_customers", with_tx(f"""SELECT customer_id, count(*) AS n, sum(CAST(round(amount * 100.0) AS BIGINT)) / 100.0 AS total_amount,
  CAST(sum(is_fraud) AS BIGINT) AS n_fraud, {MM('amount')} AS mean_amount FROM transactions GROUP BY 1
  ORDER BY n_fraud DESC, customer_id LIMIT 5"""))
def q_a15(spark, sf):
    t = tx(spark, sf)
    s = t.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), (F.sum(A.to_units("amount", 2)) / 100.0).alias("total_amount"),
                                     F.sum(F.col("is_fraud").cast("bigint")).alias("n_fraud"), A.money_mean("amount").alias("mean_amount"))
    return A.top_k(s, [F.desc("n_fraud"), "customer_id"], 5)


@register("a15_repeat_fraud_customers", with_tx("""SELECT count(*) AS n_repeat_fraud_customers FROM
  (SELECT customer_id FROM transactions GROUP BY 1 HAVING sum(is_fraud) > 1)"""))
def q_a15b(spark, sf):
    return A.customer_counts(tx(spark, sf)).where(F.col("n_fraud") > 1).agg(F.count(F.lit(1)).alias("n_repeat_fraud_customers"))


_MSUM = f"""ms AS (SELECT merchant_id, count(*) AS n, sum(CAST(round(amount * 100.0) AS BIGINT)) / 100.0 AS total_amount,
  CAST(sum(is_fraud) AS BIGINT) AS n_fraud, {RATE()} AS fraud_rate, {MM('amount')} AS mean_amount FROM transactions GROUP BY 1)"""


@register("a16_merchant_summary", with_tx("SELECT * FROM ms", extra=_MSUM))
def q_a16(spark, sf):
    return A.merchant_summary(tx(spark, sf))


@register("a16_merchant_correlations", with_tx("""SELECT round(corr(n, n_fraud), 4) AS corr_count_fraud,
  round(corr(mean_amount, fraud_rate), 4) AS corr_amount_rate FROM ms""", extra=_MSUM))
def q_a16b(spark, sf):
    return A.merchant_correlations(A.merchant_summary(tx(spark, sf)))


@register("a17_frauds_per_customer", with_tx("""SELECT n_fraud, count(*) AS n_customers FROM
  (SELECT customer_id, CAST(sum(is_fraud) AS BIGINT) AS n_fraud FROM transactions GROUP BY 1) WHERE n_fraud > 0 GROUP BY 1"""))
def q_a17(spark, sf):
    return A.frauds_per_customer_distribution(tx(spark, sf))


@register("a18_target_mean_by_value", with_tx("""SELECT merchant_category, target_mean, target_mean > 0.05 AS Abnormal FROM
  (SELECT merchant_category, sum(CAST(is_fraud AS DOUBLE)) / count(*) AS target_mean FROM transactions GROUP BY 1)"""))
def q_a18(spark, sf):
    return A.target_mean_by_value(tx(spark, sf), "merchant_category", threshold=0.05)


@register("a19_distinct_customers_per_ip", with_tx("""SELECT IP_address, count(DISTINCT customer_id) AS n_distinct_customer_id
  FROM transactions WHERE IP_address IS NOT NULL GROUP BY 1"""))
def q_a19(spark, sf):
    return A.distinct_per_key(tx(spark, sf), "IP_address", "customer_id")


@register("a20_modal_merchant_per_customer", with_tx("""SELECT customer_id, arg_min(merchant_id, (-n, merchant_id)) AS mode_merchant_id
  FROM (SELECT customer_id, merchant_id, count(*) AS n FROM transactions GROUP BY 1, 2) GROUP BY 1"""))
def q_a20(spark, sf):
    return A.modal_value(tx(spark, sf), ["customer_id"], "merchant_id")


@register("a21_modal_card_per_day_customer", with_tx("""SELECT day_no, customer_id,
  arg_min(type_of_credit_card_used, (-n, type_of_credit_card_used)) AS mode_type_of_credit_card_used
  FROM (SELECT day_no, customer_id, type_of_credit_card_used, count(*) AS n FROM transactions
        WHERE type_of_credit_card_used IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2"""))
def q_a21(spark, sf):
    return A.modal_value(tx(spark, sf), ["day_no", "customer_id"], "type_of_credit_card_used")


@register("a22_contingency", with_tx("""SELECT merchant_category, card_present_or_not, count(*) AS n FROM transactions
  GROUP BY 1, 2"""))
def q_a22(spark, sf):
    return A.contingency(tx(spark, sf), "merchant_category", "card_present_or_not")


# ------------------------------------------------------------------ T, U

@register("t1_sort_by_customer_date", with_tx("SELECT transaction_id, customer_id, transaction_date FROM transactions ORDER BY customer_id, transaction_date"))
def q_t1(spark, sf):
    return tx(spark, sf).select("transaction_id", "customer_id", "transaction_date").orderBy("customer_id", "transaction_date", "transaction_id")


@register("t2_top_amounts", with_tx("SELECT transaction_id, amount FROM transactions WHERE amount IS NOT NULL ORDER BY amount DESC, transaction_id LIMIT 10"))
def q_t2(spark, sf):
    return A.top_k(tx(spark, sf).where(F.col("amount").isNotNull()).select("transaction_id", "amount"),
                   [F.desc("amount"), "transaction_id"], 10)


@register("t3_head_tail", with_tx("""SELECT * FROM (SELECT transaction_id, transaction_date, 'head' AS part FROM transactions
  ORDER BY transaction_date, transaction_id LIMIT 5) UNION ALL SELECT * FROM (SELECT transaction_id, transaction_date, 'tail'
  FROM transactions ORDER BY transaction_date DESC, transaction_id DESC LIMIT 5)"""))
def q_t3(spark, sf):
    return A.head_tail(tx(spark, sf).select("transaction_id", "transaction_date"), ["transaction_date", "transaction_id"], 5)


@register("u1_append_tables", with_tx("""SELECT transaction_id, amount, is_fraud, NULL::VARCHAR AS IP_address FROM transactions WHERE is_fraud = 1
  UNION ALL SELECT transaction_id, amount, is_fraud, IP_address FROM transactions WHERE is_fraud = 0"""))
def q_u1(spark, sf):
    t = tx(spark, sf)
    return A.append_tables(t.where(F.col("is_fraud") == 1).select("transaction_id", "amount", "is_fraud"),
                           t.where(F.col("is_fraud") == 0).select("transaction_id", "amount", "is_fraud", "IP_address"))


@register("u2_union_distinct_keys", with_tx("""SELECT customer_id FROM transactions WHERE is_fraud = 1
  UNION SELECT customer_id FROM transactions WHERE amount > 90"""))
def q_u2(spark, sf):
    t = tx(spark, sf)
    return A.union_keys(t.where(F.col("is_fraud") == 1).select("customer_id"), t.where(F.col("amount") > 90).select("customer_id"))


@register("u3_intersect_keys", with_tx("""SELECT customer_id FROM transactions WHERE is_fraud = 1
  INTERSECT SELECT customer_id FROM transactions WHERE type_of_credit_card_used = 'Store Credit Card'"""))
def q_u3(spark, sf):
    t = tx(spark, sf)
    return t.where(F.col("is_fraud") == 1).select("customer_id").intersect(
        t.where(F.col("type_of_credit_card_used") == "Store Credit Card").select("customer_id"))


@register("u5_explode_cards", with_tx("SELECT customer_id, unnest(credit_card_owned) AS card FROM profiles", extra=DERIVED_CTES))
def q_u5(spark, sf):
    p = derived.customer_profiles(tx(spark, sf))
    return p.select("customer_id", F.explode("credit_card_owned").alias("card"))
