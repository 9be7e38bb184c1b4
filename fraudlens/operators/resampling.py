"""Re-sampling of the train part (L8) by exact neighbours, and pipelines that re-sample in ``fit`` alone.

``label`` is 0 or 1, 1 the class to be strengthened; rows with a missing feature or label are passed on as they are
and neither interpolated nor compared.  Every choice is a hash of the row's id, the copy's number and the seed, so the same
rows come out after any repartitioning, and after a lost executor.  ``id_col`` has to be unique; a synthetic row has a
null id, its features and label, and nulls elsewhere.
"""
from __future__ import annotations

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.operators.neighbors import nearest
from fraudlens.operators.prefix import with_global_position
from fraudlens.operators.sampling import uniform
from fraudlens.session import materialize

COPIES = 1 << 20                  # copies of a row are numbered below this in the hashed key


def _complete(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    ok = F.col(label).isNotNull()
    for c in cols:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return df.where(ok)


def _counts(df: DataFrame, label: str) -> tuple[int, int]:
    r = df.agg(F.count(F.when(F.col(label) == 0, 1)), F.count(F.when(F.col(label) == 1, 1))).first()
    return r[0], r[1]


def _even_copies(base: DataFrame, n_new: int, id_col: str, seed: int, method: str) -> DataFrame:
    """(id, copies): ``n_new`` copies dealt evenly, the remainder to the rows of least hash."""
    n = base.count()
    if not n or n_new <= 0:
        return base.select(id_col).limit(0).withColumn("copies", F.lit(0).cast("bigint"))
    placed = with_global_position(base.select(id_col).withColumn("_u", uniform(id_col, seed, method)), ["_u", id_col], "_at")
    return placed.select(id_col, (F.lit(n_new // n) + (F.col("_at") < n_new % n).cast("bigint")).alias("copies")).where("copies > 0")


def interpolated(base: DataFrame, copies: DataFrame, near: DataFrame, cols: list[str], label: str, id_col: str, seed: int = 42,
                 method: str = "xxhash") -> DataFrame:
    """Synthetic rows: copy c of a row lies between it and one of its neighbours ``near`` (q, rank, nx), at a hashed place.

    A row without a neighbour yields none."""
    known = near.groupBy("q").agg(F.max("rank").alias("_k"))
    x = base.select(id_col, F.array(*[F.col(c).cast("double") for c in cols]).alias("_x")).join(copies, id_col)
    x = x.join(known.withColumnRenamed("q", id_col), id_col)
    x = x.withColumn("_c", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    x = x.withColumn("_s", F.col(id_col).cast("bigint") * COPIES + F.col("_c"))
    x = x.withColumn("rank", (F.floor(uniform("_s", seed + 1, method) * F.col("_k")) + 1).cast("int")).withColumn(
        "_gap", uniform("_s", seed + 2, method))
    x = x.join(near.select(F.col("q").alias(id_col), "rank", "nx"), [id_col, "rank"])
    made = F.zip_with("_x", "nx", lambda a, b: a + F.col("_gap") * (b - a))
    return x.select(F.col(id_col).alias("base_id"), F.col("_c").alias("copy"), F.lit(1.0).alias(label), made.alias("_m")).select(
        "base_id", "copy", label, *[F.col("_m")[i].alias(c) for i, c in enumerate(cols)])


def smote_rows(df: DataFrame, cols: list[str], label: str = "is_fraud", id_col: str = "transaction_id", k: int = 5, ratio: float = 1.0,
               seed: int = 42, method: str = "xxhash") -> DataFrame:
    """SMOTE: (base_id, copy, label, cols) until the positives are ``ratio`` times the others; neighbours among positives."""
    whole = _complete(df, cols, label)
    n0, n1 = _counts(whole, label)
    mine = materialize(whole.where(F.col(label) == 1).select(id_col, *cols), "minority")
    near = nearest(mine, mine, cols, k, id_col, exclude_self=True)
    return interpolated(mine, _even_copies(mine, int(ratio * n0) - n1, id_col, seed, method), near, cols, label, id_col, seed, method)


def danger_rows(df: DataFrame, cols: list[str], label: str = "is_fraud", id_col: str = "transaction_id", m: int = 10) -> DataFrame:
    """(id, n_other) of the positives of whose ``m`` nearest rows half or more, but not all, are of the other class."""
    whole = materialize(_complete(df, cols, label).select(id_col, label, *cols), "labelled")
    near = nearest(whole.where(F.col(label) == 1), whole, cols, m, id_col, y=label, exclude_self=True, nx=False)
    n = near.groupBy(F.col("q").alias(id_col)).agg(F.count(F.when(F.col("y") == 0, 1)).alias("n_other"))
    return n.where((F.col("n_other") >= m / 2) & (F.col("n_other") < m))


def borderline_smote_rows(df: DataFrame, cols: list[str], label: str = "is_fraud", id_col: str = "transaction_id", k: int = 5, m: int = 10,
                          ratio: float = 1.0, seed: int = 42, method: str = "xxhash") -> DataFrame:
    """Borderline-SMOTE (first kind): SMOTE from the positives in danger alone; without any, no rows."""
    whole = _complete(df, cols, label)
    n0, n1 = _counts(whole, label)
    mine = materialize(whole.where(F.col(label) == 1).select(id_col, *cols), "minority")
    edge = materialize(mine.join(danger_rows(df, cols, label, id_col, m).select(id_col), id_col, "left_semi"), "danger")
    near = nearest(edge, mine, cols, k, id_col, exclude_self=True)
    return interpolated(edge, _even_copies(edge, int(ratio * n0) - n1, id_col, seed, method), near, cols, label, id_col, seed, method)


def adasyn_rows(df: DataFrame, cols: list[str], label: str = "is_fraud", id_col: str = "transaction_id", k: int = 5, ratio: float = 1.0,
                seed: int = 42, method: str = "xxhash") -> DataFrame:
    """ADASYN: copies in proportion to the share of the other class among a positive's ``k`` nearest rows, rounded half to even."""
    whole = materialize(_complete(df, cols, label).select(id_col, label, *cols), "labelled")
    n0, n1 = _counts(whole, label)
    mine = whole.where(F.col(label) == 1)
    around = nearest(mine, whole, cols, k, id_col, y=label, exclude_self=True, nx=False)
    hard = materialize(around.groupBy(F.col("q").alias(id_col)).agg(F.count(F.when(F.col("y") == 0, 1)).alias("n_other")), "hardness")
    total = hard.agg(F.sum("n_other")).first()[0] or 0
    wanted = int(ratio * n0) - n1
    copies = F.rint(F.col("n_other") * F.lit(float(max(wanted, 0))) / F.lit(float(max(total, 1)))).cast("bigint")
    copies = hard.select(id_col, copies.alias("copies")).where("copies > 0")
    near = nearest(mine, mine, cols, k, id_col, exclude_self=True)
    return interpolated(mine, copies, near, cols, label, id_col, seed, method)


def edited_nearest_neighbours(df: DataFrame, cols: list[str], label: str = "is_fraud", id_col: str = "transaction_id", k: int = 3) -> DataFrame:
    """ENN: negatives stay only where their ``k`` nearest rows all are negatives; positives and incomplete rows stay."""
    whole = materialize(_complete(df, cols, label).select(id_col, label, *cols), "labelled")
    near = nearest(whole.where(F.col(label) == 0), whole, cols, k, id_col, y=label, exclude_self=True, nx=False)
    gone = near.where("y <> 0").select(F.col("q").alias(id_col)).distinct()
    return df.join(gone, id_col, "left_anti").select(df.columns)


_ROWS = {"smote": smote_rows, "borderline_smote": borderline_smote_rows, "adasyn": adasyn_rows}


def resample(df: DataFrame, kind: str, cols: list[str], label: str = "is_fraud", id_col: str = "transaction_id", **kw) -> DataFrame:
    """The re-sampled table: ``df`` with the synthetic rows of ``kind``, or without the rows that ``enn`` removes."""
    if kind == "enn":
        return edited_nearest_neighbours(df, cols, label, id_col, **kw)
    new = _ROWS[kind](df, cols, label, id_col, **kw)
    return df.unionByName(new.select(*[F.col(c).cast(df.schema[c].dataType).alias(c) for c in (label, *cols)]), allowMissingColumns=True)


# ------------------------------------------------------------------ M14

class Resampler(Estimator):
    """A pipeline stage that changes train rows only: ``resample`` gives the rows that later stages are fitted on.

    On its own it is a stage without effect: its ``fit`` gives a model that passes rows through."""

    def __init__(self, kind: str, cols: list[str], label: str = "is_fraud", id_col: str = "transaction_id", weight_col: str | None = None, **kw):
        super().__init__()
        self.kind, self.cols, self.label, self.id_col, self.weight_col, self.kw = kind, cols, label, id_col, weight_col, kw

    def resample(self, df: DataFrame) -> DataFrame:
        out = resample(df, self.kind, self.cols, self.label, self.id_col, **self.kw)
        if self.weight_col and self.weight_col in out.columns:
            out = out.withColumn(self.weight_col, F.lit(1.0))                # the classes are balanced by rows now
        return materialize(out, "resampled")

    def _fit(self, df: DataFrame) -> Transformer:
        return PipelineModel([])


TASK_BYTES = 128 << 20            # of the rows that a fit keeps for one task


class Dealer(Resampler):
    """Deals train rows evenly to tasks of ``TASK_BYTES`` at most, for stages that make ``row_bytes`` of each row.

    Few bytes of input can become many for each row, and a fit keeps and reads them by task.  Rows that fit one task stay as they are."""

    def __init__(self, row_bytes: int):
        Estimator.__init__(self)
        self.row_bytes = row_bytes

    def resample(self, df: DataFrame) -> DataFrame:
        parts = -(-df.count() * self.row_bytes // TASK_BYTES)
        return df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism)) if parts > 1 else df


class ResamplingPipeline(Pipeline):
    """A pipeline with ``Resampler`` slots.

    ``fit`` re-samples the rows on their way to the later stages, anew in every fold that it is fitted in; the fitted
    model has no such stage, so scored rows are never changed."""

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        fitted = []
        stages = self.getStages()
        last = max((i for i, s in enumerate(stages) if isinstance(s, Estimator)), default=-1)
        for i, stage in enumerate(stages):
            if isinstance(stage, Resampler):
                dataset = stage.resample(dataset)
                continue
            model = stage if isinstance(stage, Transformer) else stage.fit(dataset)
            fitted.append(model)
            if i < last:
                dataset = model.transform(dataset)
        return PipelineModel(fitted)

    def copy(self, extra=None):
        stages = [s if isinstance(s, Resampler) else s.copy(extra) for s in self.getStages()]
        return ResamplingPipeline(stages=stages)
