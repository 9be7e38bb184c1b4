"""Categorical encoders as joins against a small code table."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.operators.prefix import dense_codes


def label_encode_column(df: DataFrame, column: str, out_col: str | None = None) -> DataFrame:
    """Replace ``column`` by the 0-based rank of its value among the sorted
    distinct non-NULL values (NULL stays NULL).

    The code table is built with a range-partitioned global position (no
    single-task window) and joined back; AQE broadcasts it when it is small.
    """
    out_col = out_col or column
    codes = dense_codes(df, column, name="_code").select(F.col(column).alias("_v"), "_code")
    j = df.join(codes, df[column] == codes["_v"], "left")
    code = F.col("_code").cast("int")
    if out_col == column:
        cols = [code.alias(column) if c == column else F.col(c) for c in df.columns]
        return j.select(*cols)
    return j.withColumn(out_col, code).drop("_v", "_code")


def onehot_encode_column(df: DataFrame, column: str, drop_first: bool = False, prefix: str | None = None,
                         values: list | None = None) -> DataFrame:
    """One 0/1 int column ``{prefix}_{value}`` per distinct non-NULL value in
    sorted order (first dropped if ``drop_first``); NULL -> all 0; the original
    column is dropped.

    ``values``: the categories as fitted before; by default those of ``df``,
    read as they become the schema.  Columns of many values are for
    ``label_encode_column``, by the caller's choice.
    """
    prefix = prefix or column
    if values is None:
        values = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).collect()]
    if drop_first:
        values = values[1:]
    cols = {f"{prefix}_{v}": F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)) for v in values}
    return df.withColumns(cols).drop(column)
