"""Attach the values of a one-row result (a global aggregate) to every row.

A cross join with a one-row table plans as a nested-loop join; a scalar
subquery is evaluated once and used like a literal, so no join is planned."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """``df`` plus every column of ``one_row`` (which must have exactly one row)."""
    cols = one_row.columns
    s = one_row.select(F.struct(*cols).alias("_s")).scalar()
    return df.withColumn("_s", s).withColumns({c: F.col("_s").getField(c) for c in cols}).drop("_s")
