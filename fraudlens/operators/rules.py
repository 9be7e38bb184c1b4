"""Rule scoring and simulation rules re-aimed as data operators (E12, D-15)."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the reference's dumped boosted tree (one tree, 9 leaves).
# node = (feature, threshold, yes-branch, no-or-missing-branch); a float is a leaf.
FRAUD_TREE = (
    "customer_id_distinct_ip_1d", 3,
    ("IP_used_by_2_customer_id_or_more", 1,
     ("seconds_since_last_ip", 120,
      ("card_present_or_not", 1, 1.43439639, -0.216110185),
      -0.371806085),
     1.55139554),
    ("seconds_since_last_ip", 120,
     ("card_present_or_not", 1,
      1.54906702,
      ("transaction_date_sec_since_midnight", 15240, 0.749663472, -0.261867702)),
     ("IP_used_by_2_customer_id_or_more", 1, -0.371601909, 1.54973209)),
)
TREE_FEATURES = sorted({"customer_id_distinct_ip_1d", "IP_used_by_2_customer_id_or_more",
                        "seconds_since_last_ip", "card_present_or_not",
                        "transaction_date_sec_since_midnight"})


def tree_expr(node) -> Column:
    """Nested CASE for a tree: ``feature < threshold`` goes to ``yes``; false or
    NULL (missing) goes to ``no``."""
    if isinstance(node, (int, float)):
        return F.lit(float(node))
    feat, thr, yes, no = node
    return F.when(F.coalesce(F.col(feat) < thr, F.lit(False)), tree_expr(yes)).otherwise(tree_expr(no))


def tree_sql(node) -> str:
    """Same tree as SQL text (for the oracle and for SQL users)."""
    if isinstance(node, (int, float)):
        return repr(float(node))
    feat, thr, yes, no = node
    return f"(CASE WHEN coalesce({feat} < {thr}, false) THEN {tree_sql(yes)} ELSE {tree_sql(no)} END)"


def score_tree(df: DataFrame, tree=FRAUD_TREE, base_margin: float = 0.0, threshold: float = 0.5) -> DataFrame:
    """Margin, P(fraud) = sigmoid(margin), prediction = P >= threshold."""
    m = tree_expr(tree) + F.lit(base_margin)
    p1 = 1.0 / (1.0 + F.exp(-F.col("margin")))
    return (df.withColumn("margin", m)
            .withColumn("p1", F.round(p1, 6))
            .withColumn("p0", F.round(1.0 - p1, 6))
            .withColumn("prediction", (p1 >= threshold).cast("int")))


def logit(p: float) -> float:
    return math.log(p / (1 - p))


def holiday_buffer_flag(df: DataFrame, periods: DataFrame, date_col="transaction_date",
                        pre_days: int = 30, buffer_days: int = 30) -> DataFrame:
    """D-15: row date inside a holiday buffer (pre-holiday start - buffer ...
    holiday end + buffer).  Periods are expanded to their days (bounded by the
    period length) and joined on the date - an equi join, not a range scan."""
    days = periods.select(F.explode(F.sequence(
        F.date_sub("holiday_starts", pre_days + buffer_days),
        F.date_add("holiday_ends", buffer_days))).alias("_bd")).distinct().withColumn("_hit", F.lit(1))
    x = df.withColumn("_d", F.to_date(date_col))
    j = x.join(days, x["_d"] == days["_bd"], "left")
    return j.withColumn("in_holiday_buffer", F.coalesce("_hit", F.lit(0))).drop("_d", "_bd", "_hit")
