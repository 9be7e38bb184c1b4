"""Splitting hot keys of per-key time windows.

A per-customer window puts every row of a customer into one task.  If one
customer holds a large share of all rows, that task holds it too.  So rows of
hot keys, those with more than ``hot_threshold`` rows, take a way of their own:

* one job counts rows per key (partial sums before the shuffle).  Without hot
  keys the plan stays as it is, and the input is read once by it;
* hot keys are written to the shared checkpoint folder; Spark broadcasts the
  table if it is small in bytes.  Rows of other keys are windowed by key alone;
* rows of hot keys get a time bucket of ``bucket_days``, are written
  once and windowed by (key, bucket).  What a row needs from
  earlier buckets comes from a summary with one row per (key, bucket).  For
  RANGE frames of at most ``max_days`` rows are also copied, flagged as
  context, into the next ``ceil(max_days / bucket_days)`` buckets and dropped
  afterwards.

The hot rows are written so that operators can be chained: no plan reads its
input more than twice.  NULL keys are one key.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.session import materialize

DAY_US = 86_400 * 1_000_000
BUCKET = "_hb"
CONTEXT = "_hctx"
NO_TIME = -1              # bucket of rows without a time


class Split:
    """Rows of a per-key window computation; ``active``: with a time bucket and context rows."""

    def __init__(self, rows: DataFrame, active: bool, bucket_days: float | None = None):
        self.rows, self.active, self.bucket_days = rows, active, bucket_days

    def keys(self, *keys: str) -> list[str]:
        return [*keys, BUCKET] if self.active else list(keys)


def bucket_of(t_us, bucket_days: float):
    t = F.col(t_us) if isinstance(t_us, str) else t_us
    return F.coalesce(F.floor(t / (bucket_days * DAY_US)), F.lit(NO_TIME)).cast("bigint")


def hot_keys(df: DataFrame, key: str, hot_threshold: int) -> DataFrame:
    """(_hk) keys above the threshold."""
    n = df.groupBy(F.col(key).alias("_hk")).agg(F.count(F.lit(1)).alias("_n"))
    return n.where(F.col("_n") > hot_threshold).select("_hk")


def by_heat(df: DataFrame, key: str, t_us: str, hot_threshold: int | None, bucket_days: float, body,
            max_days: float = 0) -> DataFrame:
    """``body(split)`` over the rows of cold keys and, split by time bucket, of hot keys."""
    if hot_threshold is None:
        return body(Split(df, False))
    hot = hot_keys(df, key, hot_threshold)
    if hot.isEmpty():
        return body(Split(df, False))
    hot = materialize(hot, "hot-keys")
    same = F.col(key).eqNullSafe(F.col("_hk"))
    cold = body(Split(df.join(hot, same, "left_anti"), False))
    rows = df.join(hot, same, "left_semi").withColumn(BUCKET, bucket_of(t_us, bucket_days))
    reach = int(math.ceil(max_days / bucket_days))
    rows = (rows.withColumn("_k", F.explode(F.sequence(F.lit(0), F.when(F.col(t_us).isNull(), 0).otherwise(reach))))
            .withColumns({BUCKET: F.col(BUCKET) + F.col("_k"), CONTEXT: F.col("_k") > 0}).drop("_k"))
    # explicit: an input already partitioned (or bucketed) by the key alone would
    # otherwise satisfy the windows' clustering and keep a hot key in one task
    rows = materialize(rows, "hot-rows").repartition(key, BUCKET)
    out = body(Split(rows, True, bucket_days))
    return cold.unionByName(out.where(~F.col(CONTEXT)).drop(BUCKET, CONTEXT))


def join_null_safe(df: DataFrame, other: DataFrame, keys: list[str], value_cols: list[str]) -> DataFrame:
    """Left join on keys whose NULLs are equal; takes ``value_cols`` of ``other``."""
    o = other.select(*[F.col(k).alias(f"_j{i}") for i, k in enumerate(keys)], *value_cols)
    on = [F.col(k).eqNullSafe(F.col(f"_j{i}")) for i, k in enumerate(keys)]
    return df.join(o, on, "left").drop(*[f"_j{i}" for i in range(len(keys))])


def fill_lag(split: Split, df: DataFrame, keys: list[str], t_us: str, lag_col: str) -> DataFrame:
    """Complete NULL lags of hot keys' rows from the last row of the nearest earlier bucket of the same keys."""
    if not split.active:
        return df
    s = split.rows.where(~F.col(CONTEXT)).groupBy(*keys, BUCKET).agg(F.max(t_us).alias("_last"))
    s = s.withColumn("_prev_last", F.lag("_last").over(Window.partitionBy(*keys).orderBy(BUCKET)))
    out = join_null_safe(df, s.where(F.col("_prev_last").isNotNull()), [*keys, BUCKET], ["_prev_last"])
    return out.withColumn(lag_col, F.coalesce(lag_col, "_prev_last")).drop("_prev_last")
