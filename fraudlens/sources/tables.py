"""Table scans and the ``events`` -> ``transactions`` adapter.

The test data ships an ``events`` table; the fraud operators work on a
card-transaction table (customer, timestamp, amount, merchant, IP, card,
label).  ``transactions`` derives one from the other with integer arithmetic
only, so the same rows come out of DuckDB for the oracle check
(see ``fraudlens.plans.oracle.TRANSACTIONS_CTE``).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Fixed values of the adapter (kept equal to the oracle SQL text).
SIM_START = "2024-01-01 00:00:00"      # simulation origin for day_no / date_in_sec
MERCHANT_EPOCH = "2000-01-01"          # merchants established MERCHANT_EPOCH + 97*id days


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one test table (column pruning/pushdown left to Catalyst)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_us(c: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock (NTZ, UTC) timestamp.

    Computed with ``timestampdiff`` against an NTZ origin so the result does
    not depend on ``spark.sql.session.timeZone``.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            c.cast("timestamp_ntz"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card transactions derived from ``events`` (FIXTURES.md section 2)."""
    e = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    e = e.withColumn("k", k)
    x = (F.when(F.col("k") % 3 == 0, F.col("user_id"))
         .when(F.col("k") % 3 == 1, F.col("user_id") % 10)
         .otherwise(F.col("user_id") % 50))
    e = e.withColumn("x", x)
    merchant_id = (F.col("k") % 30 + 1).cast("bigint")
    card_present = F.col("event_type") == "view"
    ip = F.when(card_present, F.lit(None).cast("string")).otherwise(
        F.concat((11 + 20 * (F.col("x") % 10)).cast("string"), F.lit("."),
                 (F.col("x") % 200).cast("string"), F.lit("."),
                 (F.col("k") % 3).cast("string"), F.lit(".1")))
    card = (F.when(F.col("k") % 4 == 0, "Store Credit Card")
            .when(F.col("k") % 4 == 1, "Cashback")
            .when(F.col("k") % 4 == 2, "Travel"))
    start = F.lit(SIM_START).cast("timestamp_ntz")
    ts = F.col("ts").cast("timestamp_ntz")
    return e.select(
        F.col("event_id").cast("bigint").alias("transaction_id"),
        ts.alias("transaction_date"),
        F.col("user_id").cast("bigint").alias("customer_id"),
        F.when(F.col("k") == 99, F.lit(None).cast("double"))
         .otherwise(F.col("value").cast("double")).alias("amount"),
        F.floor(F.timestamp_diff("MICROSECOND", start, ts) / 1_000_000).cast("bigint").alias("date_in_sec"),
        (F.datediff(F.to_date(ts), F.to_date(start)) + 1).cast("int").alias("day_no"),
        merchant_id.alias("merchant_id"),
        F.when(card_present, merchant_id * 1000 + F.col("k") % 5).cast("bigint").alias("pos_id"),
        F.date_add(F.lit(MERCHANT_EPOCH).cast("date"), (merchant_id * 97).cast("int"))
         .cast("timestamp_ntz").alias("merchant_established_date"),
        (5000 + F.col("k") % 7).cast("int").alias("MCCs"),
        F.concat(F.lit("CAT_"), (F.col("k") % 7).cast("string")).alias("merchant_category"),
        ip.alias("IP_address"),
        card.alias("type_of_credit_card_used"),
        F.when(card_present, "card present").otherwise("card not present").alias("card_present_or_not"),
        F.when(F.col("k") % 4 == 0, F.col("user_id") % 30 + 1).cast("bigint").alias("store_card_merchant_id"),
        F.when((F.col("event_type") == "error") & (F.col("k") < 20), 1).otherwise(0).cast("int").alias("is_fraud"),
    )
