"""Deploy-phase batch scoring (M13) over arriving files, as a Structured
Streaming query: new feature-table files are scored by a saved
``PipelineModel`` and appended to a Parquet sink.  Exactly-once via the
query's checkpoint location (under ``spark.checkpoint.dir`` by default)."""
from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from fraudlens.operators.models import score
from fraudlens.session import ensure_checkpoint_dir


def start_scoring_stream(spark: SparkSession, model_path: str, in_dir: str, out_dir: str, schema: StructType,
                         checkpoint_location: str | None = None, available_now: bool = True,
                         keep=("transaction_id", "is_fraud"), max_files_per_trigger: int | None = None):
    model = PipelineModel.load(model_path)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    scored = score(model, reader.parquet(in_dir), keep=keep)
    loc = checkpoint_location or f"{ensure_checkpoint_dir(spark).rstrip('/')}/scoring-stream"
    w = (scored.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", loc)
         .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
