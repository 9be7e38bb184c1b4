"""Side tables the reference keeps next to transactions (customer profiles,
merchant x POS, card preferences), derived by Spark from the transactions
themselves so they grow with the data."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.sources.dims import literal_table

# fixed values: card category -> preferred merchant categories 1 and 2 (test fixture)
CARD_PREFERENCES = [
    ("Cashback", "CAT_0", "CAT_1"),
    ("Travel", "CAT_2", "CAT_3"),
    ("Store Credit Card", "CAT_4", "CAT_5"),
]


def customer_profiles(tx: DataFrame) -> DataFrame:
    """One row per customer: location, cards owned (sorted set), store-card merchant."""
    return (tx.groupBy("customer_id").agg(
        F.sort_array(F.collect_set("type_of_credit_card_used")).alias("credit_card_owned"),
        F.max("store_card_merchant_id").alias("store_card_merchant_id"))
        .withColumn("location_x", (F.col("customer_id") * 37 % 100).cast("double"))
        .withColumn("location_y", (F.col("customer_id") * 61 % 100).cast("double")))


def merchant_pos(tx: DataFrame) -> DataFrame:
    """One row per (merchant, POS) with the POS location."""
    return (tx.where(F.col("pos_id").isNotNull()).select("merchant_id", "pos_id").distinct()
            .withColumn("location_x", (F.col("pos_id") * 13 % 100).cast("double"))
            .withColumn("location_y", (F.col("pos_id") * 29 % 100).cast("double")))


def card_preferences(spark: SparkSession) -> DataFrame:
    return literal_table(spark, CARD_PREFERENCES, "card_category string, prefer_consumption_category_1 string, "
                                                  "prefer_consumption_category_2 string")


def with_postcode(tx: DataFrame) -> DataFrame:
    """A postcode-like text per customer (letters + district) for the London flag."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    c = F.col("customer_id")
    area = F.substring(letters, (c % 26 + 1).cast("int"), (c % 2 + 1).cast("int"))
    return tx.withColumn("postcode_latest", F.concat(area, (c % 20).cast("string"), F.lit(" 1AB")))
