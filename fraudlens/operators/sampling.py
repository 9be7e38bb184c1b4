"""Splits, folds, samples and class weights.

Randomness is a hash of the row id and a seed, so a split is stable under
repartitioning and task retries (``randomSplit`` is not).  Order-based
splits use the range-partitioned global position (W8), never a
single-task window.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.operators.prefix import with_global_position

LEHMER_M = 2147483647   # fixed values: Lehmer (MINSTD) modulus and multiplier
LEHMER_A = 48271


def uniform(id_col: str, seed: int = 42, method: str = "xxhash"):
    """Deterministic pseudo-uniform value in [0, 1) per row id.

    ``xxhash``: Spark's 64-bit xxhash of (id, seed).  ``lehmer``: one MINSTD
    step on (id mod M + seed) - plain integer arithmetic that any SQL engine
    reproduces (used by the oracle check)."""
    if method == "xxhash":
        h = F.xxhash64(F.col(id_col), F.lit(seed))
        return F.pmod(h, F.lit(1 << 30)).cast("double") / float(1 << 30)
    x = F.pmod(F.pmod(F.col(id_col), F.lit(LEHMER_M)) + F.lit(seed), F.lit(LEHMER_M))
    return F.pmod(x * LEHMER_A, F.lit(LEHMER_M)).cast("double") / float(LEHMER_M)


def random_split(df: DataFrame, id_col: str = "transaction_id", test_size: float = 0.2, seed: int = 42,
                 method: str = "xxhash") -> tuple[DataFrame, DataFrame]:
    """L1: (train, test), not stratified."""
    u = uniform(id_col, seed, method)
    return df.where(u >= test_size), df.where(u < test_size)


def with_split_flag(df: DataFrame, id_col="transaction_id", test_size=0.2, seed=42, method="xxhash") -> DataFrame:
    return df.withColumn("is_test", uniform(id_col, seed, method) < test_size)


def time_split(df: DataFrame, date_col="transaction_date", id_col="transaction_id",
               test_ratio: float = 0.2) -> DataFrame:
    """L2: first int(N * (1 - test_ratio)) rows by time are train (``is_test`` flag)."""
    n = df.count()
    cut = int(n * (1 - test_ratio))
    return with_global_position(df, [date_col, id_col], "_pos").withColumn(
        "is_test", F.col("_pos") >= cut).drop("_pos")


def stratified_folds(df: DataFrame, label="is_fraud", id_col="transaction_id", k: int = 5, seed: int = 42,
                     method: str = "xxhash", name: str = "fold") -> DataFrame:
    """L3: fold = (position inside the label, ordered by hash) mod k, so every fold
    gets floor or ceil of each class's share.  The position comes from one
    global range-partitioned order over (label, hash, id) minus the label's
    start offset - no window over a whole class."""
    x = df.withColumn("_u", uniform(id_col, seed, method))
    pos = with_global_position(x, [label, "_u", id_col], "_gpos")
    starts = pos.groupBy(label).agg(F.min("_gpos").alias("_start"))    # one row per class
    return (pos.join(F.broadcast(starts), label)
            .withColumn(name, ((F.col("_gpos") - F.col("_start")) % k).cast("int"))
            .drop("_u", "_gpos", "_start"))


def repeated_stratified_folds(df: DataFrame, label="is_fraud", id_col="transaction_id", k=5, repeats=3,
                              seed=42) -> list[DataFrame]:
    """L3: ``repeats`` fold assignments with different seeds."""
    return [stratified_folds(df, label, id_col, k, seed + r) for r in range(repeats)]


def hash_folds(df: DataFrame, id_col="transaction_id", k: int = 2, seed: int = 42, method="xxhash",
               name="fold") -> DataFrame:
    """L4: plain shuffled k folds: floor(u * k)."""
    return df.withColumn(name, F.floor(uniform(id_col, seed, method) * k).cast("int"))


def time_series_folds(df: DataFrame, n_splits: int = 5, date_col="transaction_date", id_col="transaction_id",
                      name="test_fold") -> DataFrame:
    """Expanding-window folds (sklearn TimeSeriesSplit): test block i covers
    positions [n - (n_splits - i) * t, n - (n_splits - i - 1) * t) with
    t = n // (n_splits + 1); fold i trains on everything before its block.
    Rows before the first test block get -1."""
    n = df.count()
    t = n // (n_splits + 1)
    if t == 0:
        raise ValueError(f"cannot make {n_splits} time-series folds from {n} rows")
    first = n - n_splits * t
    p = with_global_position(df, [date_col, id_col], "_pos")
    fold = F.when(F.col("_pos") < first, F.lit(-1)).otherwise(F.floor((F.col("_pos") - first) / t))
    return p.withColumn(name, fold.cast("int")).drop("_pos")


def sample_rows(df: DataFrame, n: int, id_col="transaction_id", seed=42, method="xxhash") -> DataFrame:
    """N rows chosen by smallest hash (a top-n by hash: a per-partition
    top-n plus a merge, never a full sort); deterministic."""
    return df.withColumn("_u", uniform(id_col, seed, method)).orderBy("_u", id_col).limit(n).drop("_u")


def class_weight(df: DataFrame, label="is_fraud") -> float:
    """N / min class count (one small aggregation)."""
    rows = df.groupBy(label).count().collect()
    return sum(r["count"] for r in rows) / min(r["count"] for r in rows)


def with_weights(df: DataFrame, label="is_fraud", positive_weight: float | None = None, name="weight") -> DataFrame:
    """Weight column: ``positive_weight`` for label 1 (default N / min count), 1 otherwise."""
    w = positive_weight if positive_weight is not None else class_weight(df, label)
    return df.withColumn(name, F.when(F.col(label) == 1, F.lit(float(w))).otherwise(F.lit(1.0)))


def random_oversample(df: DataFrame, label="is_fraud", ratio: float = 1.0, id_col="transaction_id",
                      seed=42, method: str = "xxhash") -> DataFrame:
    """Replicate minority rows until minority ~= ratio * majority.  Each
    minority row is emitted floor(f) times plus once more when its hash < frac(f)
    (``explode`` of a per-row sequence; no shuffle)."""
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    f = ratio * counts.get(0, 0) / max(counts.get(1, 0), 1)
    whole, frac = int(f), f - int(f)
    u = uniform(id_col, seed, method)
    reps = F.when(F.col(label) == 1, F.lit(whole) + (u < frac).cast("int")).otherwise(F.lit(1))
    # every row is kept at least once: over-sampling never drops minority rows
    return df.withColumn("_rep", F.explode(F.sequence(F.lit(1), F.greatest(reps, F.lit(1))))).drop("_rep")


def random_undersample(df: DataFrame, label="is_fraud", ratio: float = 1.0, id_col="transaction_id",
                       seed=42, method: str = "xxhash") -> DataFrame:
    """Keep majority rows with hash < ratio * minority / majority."""
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    keep = min(1.0, ratio * counts.get(1, 0) / max(counts.get(0, 1), 1))
    return df.where((F.col(label) == 1) | (uniform(id_col, seed, method) < keep))
