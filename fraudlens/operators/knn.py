"""k-NN imputation (F2) and the k-NN classifier (M8) as ``pyspark.ml`` stages over the exact neighbour search.

Both keep what they were fitted on as written tables: in the folder ``store`` if one is given (the model
then outlives the job), else in the shared checkpoint folder.  Rows are identified by ``id_col``, which has to be
unique.
"""
from __future__ import annotations


from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from fraudlens.operators.neighbors import MAX_SPACES, NeighborIndex, vectors
from fraudlens.operators.prep import FittedModel, _FitBase
from fraudlens.session import ensure_checkpoint_dir


def _store(df: DataFrame, cfg: dict, name: str) -> str:
    import uuid
    return cfg.get("store") or f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------------ F2

class KnnImputerModel(FittedModel):
    def _apply(self, df: DataFrame, st: dict, cfg: dict) -> DataFrame:
        cols, id_col, k = self._cols(), cfg.get("id_col", "transaction_id"), cfg.get("n_neighbors", 2)
        full = (1 << len(cols)) - 1
        lacking = vectors(df, id_col, cols).where(F.col("have") != full)
        asked = [r[0] for r in lacking.select("have").distinct().limit(MAX_SPACES + 1).collect()]
        if not asked:
            return df
        index = NeighborIndex.build(df.sparkSession.read.parquet(st["donors"]), cols, k, asked, fill=True)
        near = index.search(lacking, fill=True).join(lacking.select(F.col("id").alias("q"), "have"), "q")
        # a donor serves every column that it has and the row lacks; each column takes its own nearest
        each = near.select("q", "id", "d2", "have", F.posexplode("nx").alias("j", "value")).where(
            F.col("value").isNotNull() & (F.getbit("have", "j") == 0))
        rank = F.row_number().over(Window.partitionBy("q", "j").orderBy("d2", "id"))
        best = each.withColumn("r", rank).where(F.col("r") <= k).groupBy("q", "j").agg(F.avg("value").alias("value"))
        best = best.groupBy("q").agg(F.map_from_entries(F.collect_list(F.struct("j", "value"))).alias("_filled"))
        out = df.join(best.withColumnRenamed("q", id_col), id_col, "left")
        fill = {}
        for j, c in enumerate(cols):
            have = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
            fill[c] = F.coalesce(have, F.element_at("_filled", F.lit(j)), F.lit(st["mean"][c]).cast("double"))
        return out.withColumns(fill).select(*df.columns)


class KnnImputer(_FitBase):
    """a missing value becomes the mean over the ``n_neighbors`` nearest fitted rows that have the column.

    Distance skips coordinates missing on either side and scales the rest up; ties go to the smaller id; fewer
    donors than asked for are all used; a row without a common coordinate with any donor gets the column's mean; a
    column that no fitted row has stays null.  NaN counts as missing."""
    model_cls = KnnImputerModel

    def _state(self, df: DataFrame, cols: list[str], cfg: dict) -> dict:
        rows = vectors(df, cfg.get("id_col", "transaction_id"), cols)
        path = _store(df, cfg, "knn-donors")
        rows.where(F.col("have") != 0).write.mode("overwrite").parquet(path)
        mean = df.agg(*[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))).alias(f"m{i}") for i, c in enumerate(cols)]).first()
        return {"donors": path, "mean": {c: mean[f"m{i}"] for i, c in enumerate(cols)}}


# ------------------------------------------------------------------ M8

class KnnClassifierModel(FittedModel):
    def _apply(self, df: DataFrame, st: dict, cfg: dict) -> DataFrame:
        cols, id_col = self._cols(), cfg.get("id_col", "transaction_id")
        index = NeighborIndex.load(df.sparkSession, st["index"])
        near = index.search(vectors(df, id_col, cols).where(F.col("have") == (1 << len(cols)) - 1))
        p1 = near.groupBy("q").agg(F.avg("y").alias("p1")).withColumnRenamed("q", id_col)
        out = df.join(p1, id_col, "left")
        return out.withColumn("prediction", (F.col("p1") > 0.5).cast("double")).withColumn(
            "probability", F.when(F.col("p1").isNotNull(), array_to_vector(F.array(1 - F.col("p1"), F.col("p1"))))).drop("p1")


class KnnClassifier(_FitBase):
    """M8: the share of positives among the ``n_neighbors`` nearest train rows (uniform votes, ties of distance by id).

    Its model holds the partitioned index as a saved table and can be scored after loading.  Labels are 0 and 1;
    equal votes predict 0; rows with a missing feature are not fitted, and get no prediction."""
    model_cls = KnnClassifierModel

    def _state(self, df: DataFrame, cols: list[str], cfg: dict) -> dict:
        rows = vectors(df, cfg.get("id_col", "transaction_id"), cols, cfg.get("label", "is_fraud"))
        rows = rows.where((F.col("have") == (1 << len(cols)) - 1) & F.col("y").isNotNull())
        path = _store(df, cfg, "knn-index")
        NeighborIndex.build(rows, cols, cfg.get("n_neighbors", 5)).save(path)
        return {"index": path}
