"""Feature job: raw transactions -> the processed feature table.

All per-customer windows (distinct IPs, seconds since last trade, moving
amount/count, seconds since the same IP) are placed next to each other so
Catalyst plans them on a single Exchange by customer (the (customer, IP)
window is satisfied by the same hash partitioning; only local sorts differ).
The IP-sharing flag adds one aggregate + join on IP; all dimension lookups
are broadcasts of bounded tables.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.functions import dates as D
from fraudlens.functions import strings as S
from fraudlens.operators import joins as J
from fraudlens.operators import windows as W
from fraudlens.operators.encode import label_encode_column, onehot_encode_column
from fraudlens.operators.windows import HOT_BUCKET_DAYS, HOT_CUSTOMER_ROWS

WINDOWS = (1, 5, 12, 28, 60)


def build_transaction_features(tx: DataFrame, ip_ranges: DataFrame, tz_dim: DataFrame, holidays: DataFrame,
                               as_of: str = "2025-01-01", windows=WINDOWS, ip_thresholds=None,
                               holiday_country: str = "GB", hot_threshold: int | None = HOT_CUSTOMER_ROWS,
                               bucket_days: float = HOT_BUCKET_DAYS) -> DataFrame:
    # per-customer windows: one shuffle by customer (hot customers apart, in time buckets)
    x = W.add_customer_window_features(tx, windows, hot_threshold=hot_threshold, bucket_days=bucket_days)
    # IP sharing: aggregate by IP and join back
    x = J.add_ip_used_by_many(x, ip_thresholds)
    # broadcast lookups and row-wise expressions
    x = J.add_ip_country(x, ip_ranges)
    x = J.add_country_timezone(x, tz_dim)
    x = x.withColumn("country_code_date", D.local_time("transaction_date", "timezone"))
    x = J.add_is_bank_holiday(x, holidays, holiday_country)
    x = x.withColumns({
        "transaction_date_sec_since_midnight": D.sec_since_midnight("transaction_date"),
        "is_weekend": D.is_weekend("transaction_date"),
        **D.weekday_flags("transaction_date", "local"),
        "established_period_in_day": D.days_since("merchant_established_date", as_of),
        **S.merchant_card_flags("type_of_credit_card_used", "merchant_id", "store_card_merchant_id"),
        "country_code_date_sec_since_midnight": D.sec_since_midnight("country_code_date"),
        **D.day_and_month("transaction_date", "transaction_date"),
    }).drop("timezone")
    x = onehot_encode_column(x, "merchant_category")
    return label_encode_column(x, "card_present_or_not")


def run_feature_job(tx: DataFrame, out_path: str, **kw) -> None:
    """Build and write the feature table (Parquet, sorted by time within files)."""
    from fraudlens.sources.io import write_table
    f = build_transaction_features(tx, **kw)
    write_table(f.sortWithinPartitions("transaction_date", "transaction_id"), out_path)
