"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""
from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "fraudlens", extra: dict | None = None) -> SparkSession:
    """A local session configured like the cluster one (AQE, UTC, no UI)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="fraudlens-warehouse-")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared folder (HDFS/S3/...) and is used
    as is.  Only when it is unset (local tests) do we pick a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="fraudlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df, name: str = "table"):
    """Write ``df`` once as Parquet to a fresh folder under the shared checkpoint
    dir and read it back: later jobs read the written rows instead of
    recomputing the lineage (one computation, unlike ``checkpoint()`` which
    computes an uncached plan twice), and the copy survives executor loss."""
    import uuid
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


# Settings for a large cluster (~100 TB input, ~1000 executors).  Applied only
# where the cluster has not set them already; runtime SQL settings only.
CLUSTER_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
}


def suggest_shuffle_partitions(shuffle_bytes: float, target_bytes: float = 256 * 1024 ** 2,
                               cores: int | None = None) -> int:
    """Initial shuffle partitions so a partition is about ``target_bytes``
    (AQE coalesces small ones afterwards); at least 2x the cores."""
    n = int(shuffle_bytes // target_bytes) + 1
    return max(n, 2 * (cores or 1))


def apply_cluster_conf(spark: SparkSession, shuffle_bytes: float | None = None, overrides: dict | None = None) -> dict:
    """Set the large-cluster SQL settings that are not set yet; returns what was set."""
    conf = dict(CLUSTER_SQL_CONF)
    if shuffle_bytes:
        cores = spark.sparkContext.defaultParallelism
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(
            suggest_shuffle_partitions(shuffle_bytes, cores=cores))
    conf.update(overrides or {})
    done = {}
    explicit = dict(spark.sparkContext.getConf().getAll())
    for k, v in conf.items():
        if k in explicit:
            continue
        spark.conf.set(k, v)
        done[k] = v
    ensure_checkpoint_dir(spark)
    return done
