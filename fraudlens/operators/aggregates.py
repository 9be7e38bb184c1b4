"""Grouped reports (A1-A22), sorts/top-k (T1-T3) and set operations.

Grouping keys are NULL-filtered (pandas drops NULL groups).  Money means
use exact fixed-point sums (``amount_scale`` decimals) so the result does not
depend on partitioning.  Top-k uses ``orderBy(...).limit(k)`` with a unique
tie-break, which Spark plans as a per-partition top-k plus a final merge
(TakeOrderedAndProject), never a full sort into one task.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.operators.windows import fixed_point_mean, to_units
from fraudlens.operators.scalar import attach



def money_mean(c, scale: int = 2):
    return fixed_point_mean(F.sum(to_units(c, scale)), F.count(c), scale)


def _nn(df, *keys):
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond)


def value_share(df: DataFrame, col: str, target: str | None = None) -> DataFrame:
    """A1: count and % share per value; with ``target`` also the fraud-only count and %."""
    total = df.agg(F.count(F.lit(1)).alias("_N"), *([F.sum(F.col(target).cast("bigint")).alias("_NF")] if target else []))
    g = _nn(df, col).groupBy(col).agg(F.count(F.lit(1)).alias("n"),
                                      *([F.sum(F.col(target).cast("bigint")).alias("n_fraud")] if target else []))
    j = attach(g, total)   # one-row totals
    cols = [col, "n", (100.0 * F.col("n") / F.col("_N")).alias("pct")]
    if target:
        cols += ["n_fraud", F.when(F.col("_NF") > 0, 100.0 * F.col("n_fraud") / F.col("_NF")).alias("pct_fraud")]
    return j.select(*cols)


def group_rate(df: DataFrame, key: str, target: str = "is_fraud", amount_col: str | None = None) -> DataFrame:
    """Per key: count, fraud count, fraud rate (mean label) [, mean amount]."""
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("bigint")).alias("n_fraud"),
            (F.sum(F.col(target).cast("bigint")) / F.count(F.lit(1))).alias("fraud_rate")]
    if amount_col:
        aggs.append(money_mean(amount_col).alias("mean_amount"))
    return _nn(df, key).groupBy(key).agg(*aggs)


def top_k(df: DataFrame, order: list, k: int) -> DataFrame:
    """First ``k`` rows by ``order`` (must end in a unique key)."""
    return df.orderBy(*order).limit(k)


def analyze_merchants(df: DataFrame, target="is_fraud") -> tuple[DataFrame, DataFrame]:
    """A2: top 20 merchants by count; top 10 by fraud rate."""
    g = group_rate(df, "merchant_id", target)
    return (top_k(g.select("merchant_id", "n"), [F.desc("n"), "merchant_id"], 20),
            top_k(g.select("merchant_id", "fraud_rate"), [F.desc("fraud_rate"), "merchant_id"], 10))


def customer_counts(df: DataFrame, target="is_fraud") -> DataFrame:
    """A3: per customer: transactions, fraud transactions."""
    return _nn(df, "customer_id").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("bigint")).alias("n_fraud"))


def customer_fraud_patterns(fraud_df: DataFrame, date_col="transaction_date", amount_col="amount") -> DataFrame:
    """Per customer (fraud rows in): count, span in hours, mean and total amount."""
    from fraudlens.sources.tables import epoch_us
    return _nn(fraud_df, "customer_id").groupBy("customer_id").agg(
        F.count(date_col).alias("transaction_count"),
        ((F.max(epoch_us(date_col)) - F.min(epoch_us(date_col))) / 3.6e9).alias("time_span_hours"),
        money_mean(amount_col).alias("mean_amount"),
        (F.sum(to_units(amount_col, 2)) / 100.0).alias("total_amount"))


def store_card_merchants(df: DataFrame, target="is_fraud") -> DataFrame:
    """Per store-card merchant (NULL dropped): mean label, count of customer ids."""
    return _nn(df, "store_card_merchant_id").groupBy("store_card_merchant_id").agg(
        (F.sum(F.col(target).cast("bigint")) / F.count(F.lit(1))).alias("fraud_rate"),
        F.count("customer_id").alias("n_customer_rows"))


def customer_behavior(df: DataFrame, target="is_fraud", amount_col="amount", digits=4) -> DataFrame:
    """Per customer: mean, sample std and count of amount, sum of label."""
    return _nn(df, "customer_id").groupBy("customer_id").agg(
        money_mean(amount_col).alias("mean_amount"), F.round(F.stddev_samp(amount_col), digits).alias("std_amount"),
        F.count(amount_col).alias("n_amount"), F.sum(F.col(target).cast("bigint")).alias("n_fraud"))


def normalized_crosstab(df: DataFrame, row: str, col: str, values=(0, 1)) -> DataFrame:
    """Row-normalised crosstab x 100 (``pivot`` with explicit values: no extra pass)."""
    p = _nn(df, row, col).groupBy(row).pivot(col, list(values)).count().fillna(0)
    total = sum(F.col(str(v)) for v in values)
    return p.select(row, *[(100.0 * F.col(str(v)) / total).alias(f"pct_{v}") for v in values])


def by_time_part(df: DataFrame, part: str, target="is_fraud", date_col="transaction_date") -> DataFrame:
    """A10: transactions, frauds and fraud rate per hour / day of month / weekday."""
    fn = {"hour": F.hour, "day": F.dayofmonth, "weekday": F.weekday, "month": F.month}[part]
    return df.withColumn(part, fn(date_col)).transform(lambda d: _nn(d, part)).groupBy(part).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("bigint")).alias("n_fraud"),
        (F.sum(F.col(target).cast("bigint")) / F.count(F.lit(1))).alias("fraud_rate"))


def daily_trend(df: DataFrame, target="is_fraud", date_col="transaction_date") -> DataFrame:
    """Per calendar date: transactions and frauds (days without fraud -> 0)."""
    return df.withColumn("date", F.to_date(date_col)).transform(lambda d: _nn(d, "date")).groupBy("date").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("bigint")).alias("n_fraud"))


def transaction_statistics(df: DataFrame, day_col="day_no", id_col="customer_id", target="is_fraud",
                           scale_factor: int = 50) -> DataFrame:
    """A12 (+J8): per day: transactions / scale, frauds, distinct fraud customers;
    one conditional aggregation (every day appears, missing -> 0), stacked long."""
    g = _nn(df, day_col).groupBy(day_col).agg(
        (F.count(id_col) / scale_factor).alias("a"), F.sum(F.col(target)).cast("double").alias("b"),
        F.count_distinct(F.when(F.col(target) > 0, F.col(id_col))).cast("double").alias("c"))
    return g.select(day_col, F.expr("stack(3, a, 'nb_tx_per_day', b, 'nb_fraud_per_day', c, 'nb_fraudcard_per_day') "
                                    "AS (value, stat_type)"))


def amount_bins(df: DataFrame, target="is_fraud", amount_col="amount",
                edges=(0, 10, 50, 100, 500, 1000, 5000)) -> DataFrame:
    """Counts per left-closed amount bin and label, empty bins -> 0."""
    labels = [f"[{a}, {b})" for a, b in zip(edges, edges[1:])] + [f"[{edges[-1]}, inf)"]
    x = F.col(amount_col)
    b = None
    for i in range(len(edges) - 1, -1, -1):
        cond = x >= edges[i]
        b = F.when(cond, F.lit(i)) if b is None else F.when(cond & (x < edges[i + 1]), F.lit(i)).otherwise(b)
    counts = df.where(x.isNotNull() & (x >= edges[0])).withColumn("bin", b).groupBy("bin").agg(
        F.sum((F.col(target) == 0).cast("bigint")).alias("n_legit"), F.sum((F.col(target) == 1).cast("bigint")).alias("n_fraud"))
    spark = df.sparkSession
    allb = spark.createDataFrame([(i, l) for i, l in enumerate(labels)], "bin int, amount_bin string")
    return allb.join(counts, "bin", "left").fillna(0, ["n_legit", "n_fraud"]).select("bin", "amount_bin", "n_legit", "n_fraud")


def merchant_summary(df: DataFrame, target="is_fraud", amount_col="amount") -> DataFrame:
    """Per merchant: count, total, fraud count, fraud rate, mean amount."""
    return _nn(df, "merchant_id").groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("n"), (F.sum(to_units(amount_col, 2)) / 100.0).alias("total_amount"),
        F.sum(F.col(target).cast("bigint")).alias("n_fraud"),
        (F.sum(F.col(target).cast("bigint")) / F.count(F.lit(1))).alias("fraud_rate"),
        money_mean(amount_col).alias("mean_amount"))


def merchant_correlations(summary: DataFrame, digits=4) -> DataFrame:
    """Correlation over merchants of count vs frauds and mean amount vs rate."""
    return summary.agg(F.round(F.corr("n", "n_fraud"), digits).alias("corr_count_fraud"),
                       F.round(F.corr("mean_amount", "fraud_rate"), digits).alias("corr_amount_rate"))


def frauds_per_customer_distribution(df: DataFrame, target="is_fraud") -> DataFrame:
    """How many customers have k frauds, for k > 0."""
    per = customer_counts(df, target).where(F.col("n_fraud") > 0)
    return per.groupBy("n_fraud").agg(F.count(F.lit(1)).alias("n_customers"))


def target_mean_by_value(df: DataFrame, feat: str, target="is_fraud", threshold: float = 0.05) -> DataFrame:
    """Mean label per feature value with ``Abnormal = mean > threshold``."""
    g = _nn(df, feat).groupBy(feat).agg((F.sum(F.col(target).cast("double")) / F.count(F.lit(1))).alias("target_mean"))
    return g.withColumn("Abnormal", F.col("target_mean") > threshold)


def distinct_per_key(df: DataFrame, key: str, col: str, name: str | None = None) -> DataFrame:
    """Distinct ``col`` values per ``key`` (pre-aggregated on (key, col) map-side)."""
    return _nn(df, key).groupBy(key).agg(F.count_distinct(col).alias(name or f"n_distinct_{col}"))


def modal_value(df: DataFrame, keys: list[str], col: str, name: str | None = None) -> DataFrame:
    """Most frequent ``col`` per key (ties -> smallest value).

    Counts per (key, value) first, then keeps the best value per key with
    ``min_by`` over a (-count, value) ordering - a two-stage aggregation."""
    c = _nn(df, *keys, col).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n"))
    return c.groupBy(*keys).agg(F.min_by(col, F.struct((-F.col("_n")).alias("a"), F.col(col).alias("b")))
                                .alias(name or f"mode_{col}"))


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Long-form crosstab counts."""
    return _nn(df, a, b).groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ T, U

def head_tail(df: DataFrame, order: list, n: int = 5) -> DataFrame:
    """First and last ``n`` rows by an explicit order, tagged."""
    head = df.orderBy(*order).limit(n).withColumn("part", F.lit("head"))
    rev = [F.col(c).desc() if isinstance(c, str) else c.desc() for c in order]
    tail = df.orderBy(*rev).limit(n).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)


def append_tables(*dfs: DataFrame) -> DataFrame:
    """Append, missing columns -> NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def union_keys(*dfs: DataFrame) -> DataFrame:
    """Distinct union of key sets."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.union(d)
    return out.distinct()


def column_difference(cols: list[str], remove: list[str]) -> list[str]:
    """U4: list difference of column names, order kept."""
    r = set(remove)
    return [c for c in cols if c not in r]
