"""Scans, sinks, config sheets, JDBC options and the model-version store."""
from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.operators.quality import TYPE_WORDS

TRANSACTION_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.LongType(), False),
    T.StructField("transaction_date", T.TimestampNTZType(), False),
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("amount", T.DoubleType(), True),
    T.StructField("date_in_sec", T.LongType(), False),
    T.StructField("day_no", T.IntegerType(), False),
    T.StructField("merchant_id", T.LongType(), False),
    T.StructField("pos_id", T.LongType(), True),
    T.StructField("merchant_established_date", T.TimestampNTZType(), False),
    T.StructField("MCCs", T.IntegerType(), False),
    T.StructField("merchant_category", T.StringType(), False),
    T.StructField("IP_address", T.StringType(), True),
    T.StructField("type_of_credit_card_used", T.StringType(), True),
    T.StructField("card_present_or_not", T.StringType(), False),
    T.StructField("store_card_merchant_id", T.LongType(), True),
    T.StructField("is_fraud", T.IntegerType(), False),
])


NTZ_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"    # keep microseconds through CSV


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV scan with a declared schema (no inference pass); ``No._of_day``
    style headers are renamed to Spark-safe names."""
    r = (spark.read.option("header", True).option("mode", "PERMISSIVE")
         .option("timestampNTZFormat", NTZ_FORMAT))
    if schema is not None:
        r = r.schema(schema)
    df = r.csv(path)
    return df.toDF(*[safe_name(c) for c in df.columns])


def safe_name(c: str) -> str:
    """Dots break column paths: ``No._of_day`` -> ``day_no``, other dots -> ``_``."""
    return "day_no" if c == "No._of_day" else re.sub(r"[.]", "_", c)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir (never a machine-local temp dir on a cluster)."""
    import uuid
    from fraudlens.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Sink of a stage's table (Parquet by default, CSV with header)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("timestampNTZFormat", NTZ_FORMAT).csv(path)
    else:
        w.format(fmt).save(path)


def save_bucketed(df: DataFrame, table: str, by: str = "customer_id", n_buckets: int = 64,
                  sort_by: list[str] | None = None, mode: str = "overwrite") -> DataFrame:
    """Write a table bucketed (and sorted) by ``by``.  Later per-``by``
    windows, aggregations and joins on the table reuse the bucketing and skip
    their shuffle of the big table."""
    w = df.write.mode(mode).format("parquet").bucketBy(n_buckets, by)
    if sort_by:
        w = w.sortBy(*sort_by)
    w.saveAsTable(table)
    return df.sparkSession.table(table)


def schema_sheet(spark: SparkSession, path: str) -> DataFrame:
    """S3: schema sheet as CSV (column_name, data_type, nullable, is_categorical)."""
    return read_csv(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in
                                               ("column_name", "data_type", "nullable", "is_categorical")]))


def struct_from_sheet(rows: list[dict]) -> T.StructType:
    """S3: declared ``StructType`` from schema-sheet rows (unknown type words -> string)."""
    return T.StructType([T.StructField(r["column_name"], TYPE_WORDS.get(r["data_type"], T.StringType()),
                                       r.get("nullable", "Y") != "N") for r in rows])


def drop_list(spark: SparkSession, path: str) -> list[str]:
    """One-column CSV of names (configuration: collected)."""
    df = spark.read.option("header", True).csv(path)
    return [r[0] for r in df.collect()]


def holiday_periods(spark: SparkSession, path: str) -> DataFrame:
    """Holiday periods with day-first dates."""
    df = spark.read.option("header", True).csv(path)
    return df.select(F.to_date("holiday_starts", "dd/MM/yyyy").alias("holiday_starts"),
                     F.to_date("holiday_ends", "dd/MM/yyyy").alias("holiday_ends"))


def jdbc_options(server: str, database: str, driver: str, table: str | None = None, query: str | None = None,
                 user: str | None = None, password: str | None = None, fetchsize: int = 10_000,
                 partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                 num_partitions: int | None = None, scheme: str = "sqlserver") -> dict:
    """Options for ``spark.read.format('jdbc')``; a partition column splits the
    read into parallel range queries."""
    opts = {"url": f"jdbc:{scheme}://{server};databaseName={database}", "driver": driver,
            "fetchsize": str(fetchsize)}
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    opts["dbtable" if table else "query"] = table or query
    if user:
        opts["user"] = user
    if password:
        opts["password"] = password
    if partition_column:
        if None in (lower, upper, num_partitions):
            raise ValueError("partitioned reads need lower, upper and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                    numPartitions=str(num_partitions))
    return opts


def read_jdbc(spark: SparkSession, **kw) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kw)).load()


# ------------------------------------------------------------------ S8, S9

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def model_versions(spark: SparkSession, root: str, target: str) -> list[int]:
    """Saved versions ``{root}/{target}/v{n}``."""
    fs, p = _fs(spark, f"{root}/{target}")
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        m = re.fullmatch(r"v(\d+)", st.getPath().getName())
        if m:
            out.append(int(m.group(1)))
    return sorted(out)


def save_model(spark: SparkSession, model, root: str, target: str) -> int:
    """Save as the next version (1 + highest existing)."""
    v = (max(model_versions(spark, root, target)) if model_versions(spark, root, target) else 0) + 1
    model.write().overwrite().save(f"{root}/{target}/v{v}")
    return v


def load_model(spark: SparkSession, root: str, target: str, version: int | None = None):
    """Load a version >= 1 (default: latest); error when missing."""
    from pyspark.ml import PipelineModel
    vs = model_versions(spark, root, target)
    if version is None:
        if not vs:
            raise FileNotFoundError(f"no saved model for {target}")
        version = vs[-1]
    if version < 1 or version not in vs:
        raise FileNotFoundError(f"model {target} version {version} not found (have {vs})")
    return PipelineModel.load(f"{root}/{target}/v{version}")


def save_run_record(spark: SparkSession, root: str, target: str, version: int, params: dict, best_score: float | None,
                    grid: dict | None = None) -> DataFrame:
    """One row per parameter of the run, appended to ``{root}/{target}/runs``."""
    best_score = None if best_score is None else float(best_score)
    rows = [(target, version, k, json.dumps(v, default=str), best_score, json.dumps(grid or {}, default=str))
            for k, v in sorted(params.items())]
    df = spark.createDataFrame(rows, "target string, version int, param string, value string, best_score double, grid string")
    df.write.mode("append").parquet(f"{root}/{target}/runs")
    return df
