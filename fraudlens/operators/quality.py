"""Schema-driven casting, cleaning and data-quality findings.

Every check is one aggregation pass over the table whose wide result is
unpivoted into a findings table (one row per column); nothing but the
schema and the findings leaves the executors.
"""
from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.functions.strings import null_if_null_like
from fraudlens.sources.dims import NULL_LIKE
from fraudlens.operators.scalar import attach

TYPE_WORDS = {"string": T.StringType(), "int": T.LongType(), "float": T.DoubleType(),
              "boolean": T.BooleanType(), "datetime": T.TimestampNTZType()}


def schema_rows(schema_df: DataFrame) -> list:
    """The schema sheet is configuration (one row per column): collect it."""
    return [r.asDict() for r in schema_df.collect()]


def _stack(cols: list[str], prefix: str, value_type: str = "bigint"):
    """``stack`` expression unpivoting ``{prefix}{i}`` aggregate columns to (column_name, value)."""
    parts = ", ".join(f"'{c}', CAST(`{prefix}{i}` AS {value_type})" for i, c in enumerate(cols))
    return F.expr(f"stack({len(cols)}, {parts}) AS (column_name, value)")


def convert_datatypes(df: DataFrame, schema_df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Cast every scheduled column to its declared type (``try_cast``: bad -> NULL).

    Unknown type words and missing columns leave the table untouched and are
    returned as warnings.
    """
    todo, notes = {}, []
    for r in schema_rows(schema_df):
        name, word = r["column_name"], r["data_type"]
        if name not in df.columns:
            continue
        if word not in TYPE_WORDS:
            notes.append(f"unknown data type '{word}' for column '{name}': left as is")
            continue
        todo[name] = F.col(name).try_cast(TYPE_WORDS[word])
    for n in notes:
        warnings.warn(n)
    return df.withColumns(todo), notes


def replace_null_like_values(df: DataFrame, values=NULL_LIKE) -> DataFrame:
    """In string columns, exact null-like placeholders -> NULL."""
    cols = {f.name: null_if_null_like(f.name, values) for f in df.schema.fields
            if isinstance(f.dataType, T.StringType)}
    return df.withColumns(cols)


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """Drop listed columns, ignoring missing ones."""
    return df.drop(*[c for c in cols if c in df.columns])


def features_and_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """(all columns but the target, the target)."""
    return df.drop(target), df.select(target)


def below_threshold(df: DataFrame, col: str = "amount", threshold: float = 2000) -> DataFrame:
    """Rows with ``col < threshold`` (pushed down to the Parquet scan when ``col`` is stored)."""
    return df.where(F.col(col) < threshold)


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of numeric columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def range_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One pass: min, max, distinct count per numeric column (long form)."""
    cols = cols or numeric_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(F.col(c).cast("double")).alias(f"mn{i}"), F.max(F.col(c).cast("double")).alias(f"mx{i}"),
                 F.count_distinct(c).alias(f"nd{i}")]
    wide = df.agg(*aggs)
    parts = ", ".join(f"'{c}', `mn{i}`, `mx{i}`, CAST(`nd{i}` AS BIGINT)" for i, c in enumerate(cols))
    return wide.select(F.expr(f"stack({len(cols)}, {parts}) AS (column_name, min_value, max_value, n_distinct)"))


def non_norm_identifier(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Classify numeric columns: ``binary`` (values within {0, 1}), ``non_normalised``
    (min < 0 or max > 1), ``normalised`` (inside [0, 1]); three disjoint groups."""
    p = range_profile(df, cols)
    binary = (F.col("n_distinct") <= 2) & F.col("min_value").isin(0.0, 1.0) & F.col("max_value").isin(0.0, 1.0)
    kind = (F.when(binary, "binary")
            .when((F.col("min_value") < 0) | (F.col("max_value") > 1), "non_normalised")
            .otherwise("normalised"))
    return p.select("column_name", kind.alias("kind"))


def split_num_and_cat(df: DataFrame, kinds: DataFrame | None = None) -> dict[str, list[str]]:
    """Column groups from P8 + integer type + names without ``|``."""
    kinds = kinds if kinds is not None else non_norm_identifier(df)
    k = {r["column_name"]: r["kind"] for r in kinds.collect()}      # one row per column
    ints = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType))}
    non_norm = [c for c in df.columns if k.get(c) == "non_normalised"]
    binary = [c for c in df.columns if k.get(c) == "binary"]
    other = [c for c in df.columns if c not in k]
    return {"non_normalised": non_norm, "binary": binary, "other": other,
            "non_normalised_int": [c for c in non_norm if c in ints],
            "non_normalised_float": [c for c in non_norm if c not in ints],
            "no_pipe": [c for c in df.columns if "|" not in c]}


def name_rule_columns(cols: list[str], exclude=()) -> dict[str, list[str]]:
    """P10: numeric = name has ``|`` or prefix ``num trans__``; categorical =
    prefixes ``cat trans__``, ``remainder__``, ``to cat trans__`` or no ``|``."""
    ex = set(exclude)
    num = [c for c in cols if c not in ex and ("|" in c or c.startswith("num trans__"))]
    cat = [c for c in cols if c not in ex and c not in num and (
        c.startswith(("cat trans__", "remainder__", "to cat trans__")) or "|" not in c)]
    return {"numeric": num, "categorical": cat}


def trim_reporting_period(df: DataFrame, period_days: int, date_col="transaction_date") -> DataFrame:
    """end = min(date) + period days; keep rows whose (year, month) <= end's
    (year, month), only when the data runs past ``end`` (a scalar aggregate joined in)."""
    b = df.agg(F.min(date_col).alias("_mn"), F.max(date_col).alias("_mx")).select(
        F.trunc(F.date_add(F.to_date("_mn"), period_days), "MM").alias("_end_m"),
        (F.col("_mx") > F.date_add(F.to_date("_mn"), period_days).cast("timestamp_ntz")).alias("_past"))
    j = attach(df, b)   # one-row scalar
    keep = (~F.col("_past")) | (F.trunc(F.to_date(date_col), "MM") <= F.col("_end_m"))
    return j.where(keep).drop("_end_m", "_past")


def enforce_null_policy(df: DataFrame, fk_cols: list[str]) -> DataFrame:
    """Drop rows with a NULL foreign key."""
    return df.na.drop(subset=[c for c in fk_cols if c in df.columns])


# ------------------------------------------------------------------ checks

def check_missing_columns(df: DataFrame, schema_df: DataFrame) -> DataFrame:
    """Q1: schema columns absent from the table."""
    present = df.sparkSession.createDataFrame([(c,) for c in df.columns], "column_name string")
    return schema_df.select("column_name").join(present, "column_name", "left_anti")


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Q6 (and the core of Q2): NULL count per column, one pass."""
    cols = cols or df.columns
    wide = df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(f"n{i}") for i, c in enumerate(cols)])
    return wide.select(_stack(cols, "n")).withColumnRenamed("value", "n_null")


def check_non_nullable_violation(df: DataFrame, schema_df: DataFrame) -> DataFrame:
    """Q2: NULL counts of columns declared ``nullable = 'N'`` that exist; flag > 0."""
    cols = [r["column_name"] for r in schema_rows(schema_df) if r["nullable"] == "N" and r["column_name"] in df.columns]
    return null_counts(df, cols).withColumn("violation", F.col("n_null") > 0)


def check_data_types(df: DataFrame, schema_df: DataFrame) -> DataFrame:
    """Q3: declared type word vs actual Spark type, mismatches only."""
    actual = dict(df.dtypes)
    rows = []
    for r in schema_rows(schema_df):
        name, word = r["column_name"], r["data_type"]
        if name in actual and word in TYPE_WORDS and TYPE_WORDS[word].simpleString() != actual[name]:
            rows.append((name, word, actual[name]))
    return df.sparkSession.createDataFrame(rows, "column_name string, declared string, actual string")


def check_non_negative_violations(df: DataFrame) -> DataFrame:
    """Q4: count of negative values in every numeric column."""
    cols = numeric_columns(df)
    wide = df.agg(*[F.sum((F.col(c) < 0).cast("bigint")).alias(f"n{i}") for i, c in enumerate(cols)])
    return (wide.select(_stack(cols, "n")).withColumnRenamed("value", "n_negative")
            .withColumn("n_negative", F.coalesce("n_negative", F.lit(0).cast("bigint"))))


def distinct_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Q8: exact distinct non-NULL values per column, one pass."""
    cols = cols or df.columns
    wide = df.agg(*[F.count_distinct(c).alias(f"n{i}") for i, c in enumerate(cols)])
    return wide.select(_stack(cols, "n")).withColumnRenamed("value", "n_distinct")


def check_categorical_features(df: DataFrame, schema_df: DataFrame, high: int = 50, low: int = 30) -> DataFrame:
    """Q5: marked categorical but >= ``high`` distinct values (``too_many_levels``);
    not marked, <= ``low`` distinct values (``maybe_categorical``)."""
    marked = {r["column_name"]: r["is_categorical"] == "Y" for r in schema_rows(schema_df)}
    cols = [c for c in df.columns if c in marked]
    d = distinct_counts(df, cols)
    m = df.sparkSession.createDataFrame([(c, marked[c]) for c in cols], "column_name string, is_categorical boolean")
    j = d.join(F.broadcast(m), "column_name")
    finding = (F.when(F.col("is_categorical") & (F.col("n_distinct") >= high), "too_many_levels")
               .when(~F.col("is_categorical") & (F.col("n_distinct") <= low), "maybe_categorical"))
    return j.withColumn("finding", finding).where(F.col("finding").isNotNull()).select("column_name", "n_distinct", "finding")


def duplicate_summary(df: DataFrame) -> DataFrame:
    """Q7: rows, distinct full rows, whether duplicates exist.

    Rows are grouped on all columns (shuffle keyed by the row hash), so the
    distinct count is exact and spreads over the cluster."""
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    d = df.groupBy(*df.columns).count().agg(F.count(F.lit(1)).alias("n_distinct_rows"))
    return attach(n, d).withColumn("has_duplicates", F.col("n_rows") > F.col("n_distinct_rows"))
