"""Global order positions without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task.
Instead: range-partition on the order keys (Spark samples the bounds), sort
inside each partition, number rows inside a partition with
``monotonically_increasing_id`` (partition index in the high bits, row index in
the low 33 bits), and add the row count of all earlier partitions.  The
per-partition count table has one row per partition, so broadcasting it is
bounded by the partition count, not by the data.

The range bounds come from a sample whose outcome depends on the row order
inside upstream shuffle partitions, which is not deterministic; two plan
branches over the same lineage could therefore partition differently.  So the
partition index and the in-partition row number (or running sums) are
computed once, in the stage that sorts, and written as a Parquet table in the
shared checkpoint folder; counts, offsets and results all read that one
written copy (one computation, and it survives executor loss).
"""
from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.session import materialize as _written


def _n_parts(df: DataFrame, n: int | None) -> int:
    if n:
        return int(n)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_global_position(df: DataFrame, order_cols: list, name: str = "position",
                         num_partitions: int | None = None) -> DataFrame:
    """0-based position of each row in the total order ``order_cols``.

    ``order_cols`` must end in a unique tie-break so the order is total.
    """
    n = _n_parts(df, num_partitions)
    ranged = _written(df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
                      .withColumn("_pid", F.spark_partition_id())
                      .withColumn("_local", F.monotonically_increasing_id()
                                  - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)), "positions")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # at most n rows: a bounded single-partition window
    offsets = counts.select("_pid", F.coalesce(
        F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"))
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.col("_off") + F.col("_local")).cast("bigint"))
            .drop("_pid", "_local", "_off"))


def dense_codes(df: DataFrame, col: str, name: str = "code") -> DataFrame:
    """Distinct non-NULL values of ``col`` with their 0-based rank in sorted order (distributed global position)."""
    return with_global_position(df.select(col).where(F.col(col).isNotNull()).distinct(), [col], name=name)


def _cumsum_partition(value_cols, out_cols):
    def run(batches):
        carry = None
        for pdf in batches:
            if pdf.empty:
                yield pdf.assign(**{o: pdf[v].astype("float64") for v, o in zip(value_cols, out_cols)})
                continue
            cs = pdf[value_cols].astype("float64").cumsum()
            if carry is not None:
                cs = cs + carry
            carry = cs.iloc[-1].values
            for v, o in zip(value_cols, out_cols):
                pdf[o] = cs[v].values
            yield pdf
    return run


def with_global_cumsum(df: DataFrame, order_cols: list, value_cols: list, out_cols: list | None = None,
                       num_partitions: int | None = None, ascending: bool = True) -> DataFrame:
    """Running sums of ``value_cols`` along a total order, inclusive of the row.

    Two levels: Arrow-batched cumulative sums inside each range partition,
    plus the totals of all earlier partitions (a table of at most
    ``num_partitions`` rows, broadcast).
    """
    out_cols = out_cols or [f"cum_{v}" for v in value_cols]
    order = [F.col(c) if ascending else F.col(c).desc() for c in order_cols]
    n = _n_parts(df, num_partitions)
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id()))
    from pyspark.sql.types import DoubleType, StructField, StructType
    out_schema = StructType(list(ranged.schema.fields) + [StructField(o, DoubleType()) for o in out_cols])
    local = _written(ranged.mapInPandas(_cumsum_partition(value_cols, out_cols), out_schema), "cumsum")
    totals = local.groupBy("_pid").agg(*[F.sum(F.col(v).cast("double")).alias(f"_t{i}")
                                         for i, v in enumerate(value_cols)])
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)   # <= n rows
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_t{i}").over(w), F.lit(0.0)).alias(f"_o{i}")
                                      for i in range(len(value_cols))])
    out = local.join(F.broadcast(offsets), "_pid")
    return (out.withColumns({o: F.col(o) + F.col(f"_o{i}") for i, o in enumerate(out_cols)})
            .drop("_pid", *[f"_o{i}" for i in range(len(value_cols))]))


def _keyed_cumsum_partition(key, value_cols, out_cols):
    def run(batches):
        carry_key, carry = None, None
        for pdf in batches:
            if pdf.empty:
                yield pdf.assign(**{o: pdf[v].astype("float64") for v, o in zip(value_cols, out_cols)})
                continue
            vals = pdf[value_cols].astype("float64")
            cs = vals.groupby(pdf[key].values, sort=False, dropna=False).cumsum()
            if carry is not None:                    # NULL keys are one key
                same = (pdf[key].isna() if pd.isna(carry_key) else pdf[key] == carry_key).values
                cs.loc[same] = cs.loc[same].values + carry
            last = pdf[key].iloc[-1]
            carry = cs.iloc[-1].values
            carry_key = last
            for v, o in zip(value_cols, out_cols):
                pdf[o] = cs[v].values
            yield pdf
    return run


def with_keyed_cumsum(df: DataFrame, key: str, order_cols: list, value_cols: list, out_cols: list,
                      num_partitions: int | None = None) -> DataFrame:
    """Running sums of ``value_cols`` per ``key`` along ``order_cols`` (inclusive),
    with no per-key task: rows are range-partitioned on (key, order) - a hot
    key spans many partitions - summed inside each partition (Arrow batches),
    and keys that continue from earlier partitions add the totals of those
    partitions.  At most one key crosses each partition boundary, so that
    offset table has fewer rows than there are partitions (broadcast)."""
    n = _n_parts(df, num_partitions)
    order = [key, *order_cols]
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id()))
    from pyspark.sql.types import DoubleType, StructField, StructType
    out_schema = StructType(list(ranged.schema.fields) + [StructField(o, DoubleType()) for o in out_cols])
    local = _written(ranged.mapInPandas(_keyed_cumsum_partition(key, value_cols, out_cols), out_schema), "keyed-cumsum")
    totals = local.groupBy("_pid", key).agg(*[F.sum(F.col(v).cast("double")).alias(f"_t{i}")
                                             for i, v in enumerate(value_cols)])
    w = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (totals.select("_pid", key, *[F.sum(f"_t{i}").over(w).alias(f"_o{i}") for i in range(len(value_cols))])
               .where(F.col("_o0").isNotNull()))
    offsets = offsets.select(F.col("_pid").alias("_opid"), F.col(key).alias("_okey"), *[f"_o{i}" for i in range(len(value_cols))])
    out = local.join(F.broadcast(offsets), (F.col("_pid") == F.col("_opid")) & F.col(key).eqNullSafe(F.col("_okey")),
                     "left").drop("_opid", "_okey")
    return (out.withColumns({o: F.col(o) + F.coalesce(F.col(f"_o{i}"), F.lit(0.0)) for i, o in enumerate(out_cols)})
            .drop("_pid", *[f"_o{i}" for i in range(len(value_cols))]))
