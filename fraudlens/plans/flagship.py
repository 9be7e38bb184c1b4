"""Flagship: transactions -> the five tree features -> rule score -> evaluation."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.functions.dates import sec_since_midnight
from fraudlens.operators.encode import label_encode_column
from fraudlens.operators.joins import add_ip_used_by_many
from fraudlens.operators.rules import score_tree
from fraudlens.operators.windows import add_customer_window_features

OUT_COLS = ["transaction_id", "customer_id", "customer_id_distinct_ip_1d", "IP_used_by_2_customer_id_or_more",
            "seconds_since_last_ip", "card_present_or_not", "transaction_date_sec_since_midnight",
            "margin", "p1", "p0", "prediction", "is_fraud"]


def tree_features(tx: DataFrame, features=("distinct_ip", "last_ip")) -> DataFrame:
    x = tx.select("transaction_id", "transaction_date", "customer_id", "IP_address",
                  "card_present_or_not", "is_fraud", *(["amount"] if "moving" in features else []))
    x = add_customer_window_features(x, windows=(1,), features=features)
    x = add_ip_used_by_many(x, [2])
    x = label_encode_column(x, "card_present_or_not")
    return x.withColumn("transaction_date_sec_since_midnight", sec_since_midnight("transaction_date"))


def scored_transactions(tx: DataFrame) -> DataFrame:
    return score_tree(tree_features(tx)).select(*OUT_COLS)
