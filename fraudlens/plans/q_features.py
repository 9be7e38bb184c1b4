"""Registered queries: adapter, flagship, windows, joins, date and string features."""
from __future__ import annotations

from pyspark.sql import functions as F

from fraudlens.operators import evaluate as V
from fraudlens.operators import joins as J
from fraudlens.operators import windows as W
from fraudlens.operators.rules import FRAUD_TREE, tree_sql
from fraudlens.plans.flagship import scored_transactions
from fraudlens.plans.oracle import with_tx
from fraudlens.plans.registry import register, tx

# ---------------------------------------------------------------- adapter
register("s1_transactions", with_tx("SELECT * FROM transactions"))(lambda s, d: tx(s, d))

# ---------------------------------------------------------------- flagship
_F_SQL_FEATS = """
f1 AS (
 SELECT transaction_id, transaction_date, customer_id, IP_address, card_present_or_not, is_fraud,
  CAST(count(DISTINCT CASE WHEN IP_address IS NOT NULL AND trim(IP_address) <> '' THEN IP_address END)
       OVER (PARTITION BY customer_id ORDER BY epoch_us(transaction_date)
             RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW) AS INTEGER) AS customer_id_distinct_ip_1d,
  CASE WHEN IP_address IS NULL THEN 0.0 ELSE coalesce((epoch_us(transaction_date) - lag(epoch_us(transaction_date))
       OVER (PARTITION BY customer_id, IP_address ORDER BY transaction_date, transaction_id)) / 1e6, 0.0) END
       AS seconds_since_last_ip,
  CAST(hour(transaction_date) * 3600 + minute(transaction_date) * 60 + second(transaction_date) AS INTEGER)
       AS transaction_date_sec_since_midnight
 FROM transactions),
ipc AS (SELECT IP_address, count(DISTINCT customer_id) AS n FROM transactions WHERE IP_address IS NOT NULL GROUP BY 1),
codes AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT card_present_or_not AS v FROM transactions WHERE card_present_or_not IS NOT NULL)),
feats AS (
 SELECT f1.transaction_id, f1.customer_id, f1.customer_id_distinct_ip_1d,
  CAST(coalesce(CAST(ipc.n >= 2 AS INTEGER), 0) AS INTEGER) AS IP_used_by_2_customer_id_or_more,
  f1.seconds_since_last_ip, codes.code AS card_present_or_not, f1.transaction_date_sec_since_midnight, f1.is_fraud
 FROM f1 LEFT JOIN ipc ON f1.IP_address = ipc.IP_address LEFT JOIN codes ON f1.card_present_or_not = codes.v),
scored AS (
 SELECT *, round(1.0 / (1.0 + exp(-margin)), 6) AS p1, round(1.0 - 1.0 / (1.0 + exp(-margin)), 6) AS p0,
        CAST(1.0 / (1.0 + exp(-margin)) >= 0.5 AS INTEGER) AS prediction
 FROM (SELECT *, """ + tree_sql(FRAUD_TREE) + """ AS margin FROM feats))"""

FLAGSHIP_SQL = with_tx("""SELECT transaction_id, customer_id, customer_id_distinct_ip_1d,
 IP_used_by_2_customer_id_or_more, seconds_since_last_ip, card_present_or_not,
 transaction_date_sec_since_midnight, margin, p1, p0, prediction, is_fraud FROM scored""", extra=_F_SQL_FEATS)


@register("e12_flagship_tree_score", FLAGSHIP_SQL)
def q_flagship(spark, sf):
    return scored_transactions(tx(spark, sf))


@register("v1_confusion_matrix", with_tx("""
SELECT CAST(actual AS INTEGER) AS actual, CAST(predicted AS INTEGER) AS predicted, CAST(n AS BIGINT) AS n FROM (
 SELECT 1 AS actual, 1 AS predicted, sum(CASE WHEN is_fraud = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS n FROM scored
 UNION ALL SELECT 1, 0, sum(CASE WHEN is_fraud = 1 AND prediction = 0 THEN 1 ELSE 0 END) FROM scored
 UNION ALL SELECT 0, 1, sum(CASE WHEN is_fraud = 0 AND prediction = 1 THEN 1 ELSE 0 END) FROM scored
 UNION ALL SELECT 0, 0, sum(CASE WHEN is_fraud = 0 AND prediction = 0 THEN 1 ELSE 0 END) FROM scored)""",
                                                 extra=_F_SQL_FEATS))
def q_v1(spark, sf):
    return V.confusion_matrix(scored_transactions(tx(spark, sf)))


_V_COUNTS = """
cm AS (SELECT CAST(sum(CASE WHEN is_fraud = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
              CAST(sum(CASE WHEN is_fraud = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn,
              CAST(sum(CASE WHEN is_fraud = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
              CAST(sum(CASE WHEN is_fraud = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn FROM scored),
pr AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p1,
              CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r1,
              CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS p0,
              CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS r0 FROM cm),
f AS (SELECT *, CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1_1,
             CASE WHEN p0 + r0 = 0 THEN 0.0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f1_0,
             tp + fn AS s1, tn + fp AS s0, tp + fn + fp + tn AS n FROM pr)"""


@register("v2_classification_report", with_tx("""
SELECT class, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1,
       CAST(support AS BIGINT) AS support FROM (
 SELECT '0' AS class, p0 AS precision, r0 AS recall, f1_0 AS f1, s0 AS support FROM f
 UNION ALL SELECT '1', p1, r1, f1_1, s1 FROM f
 UNION ALL SELECT 'accuracy', (tp + tn) / n, (tp + tn) / n, (tp + tn) / n, n FROM f
 UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n FROM f
 UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f1_0 * s0 + f1_1 * s1) / n, n FROM f)""",
                                                      extra=_F_SQL_FEATS + "," + _V_COUNTS))
def q_v2(spark, sf):
    return V.classification_report(scored_transactions(tx(spark, sf)))


@register("v3_f2_balanced_accuracy", with_tx("""
SELECT round(CASE WHEN 4 * p1 + r1 = 0 THEN 0.0 ELSE 5 * p1 * r1 / (4 * p1 + r1) END, 4) AS f2,
       round((r1 + r0) / 2, 4) AS balanced_accuracy, round(r1, 4) AS recall, round(p1, 4) AS precision FROM f""",
                                                     extra=_F_SQL_FEATS + "," + _V_COUNTS))
def q_v3(spark, sf):
    return V.summary_scores(scored_transactions(tx(spark, sf)))


_PR = """
per AS (SELECT p1 AS threshold, sum(CAST(is_fraud AS DOUBLE)) AS pos, CAST(count(*) AS DOUBLE) AS n FROM scored GROUP BY 1),
cum AS (SELECT *, sum(pos) OVER (ORDER BY threshold DESC) AS cpos, sum(n) OVER (ORDER BY threshold DESC) AS cn,
               (SELECT sum(CAST(is_fraud AS DOUBLE)) FROM scored) AS P FROM per)"""


@register("v4_pr_curve", with_tx("""
SELECT threshold, round(CASE WHEN cn = 0 THEN 0.0 ELSE cpos / cn END, 6) AS precision,
       round(CASE WHEN P = 0 THEN 0.0 ELSE cpos / P END, 6) AS recall,
       CAST(cpos AS BIGINT) AS tp, CAST(cn AS BIGINT) AS n_predicted FROM cum""", extra=_F_SQL_FEATS + "," + _PR))
def q_v4(spark, sf):
    return V.pr_curve(scored_transactions(tx(spark, sf)))


@register("v5_average_precision", with_tx("""
SELECT round(coalesce(sum(pos * cpos / cn) / sum(pos), 0.0), 6) AS average_precision FROM cum""",
                                          extra=_F_SQL_FEATS + "," + _PR))
def q_v5(spark, sf):
    return V.average_precision(scored_transactions(tx(spark, sf)))


@register("v7_no_skill_level", with_tx("SELECT round(avg(CAST(is_fraud AS DOUBLE)), 6) AS positive_share FROM transactions"))
def q_v7(spark, sf):
    return V.no_skill(tx(spark, sf))
