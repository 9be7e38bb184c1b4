"""Evaluation tables from a (label, prediction, score) DataFrame (V1-V7).

Everything is a conditional aggregate over the scored rows; the PR curve
uses per-score aggregation followed by a two-level running sum, never a
single-task window.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.operators.prefix import with_global_cumsum
from fraudlens.operators.scalar import attach


def _div(a, b):
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def confusion_counts(scored: DataFrame, label="is_fraud", pred="prediction") -> DataFrame:
    """V1: one row ``tp, fn, fp, tn`` (matrix with labels [1, 0])."""
    y, p = F.col(label), F.col(pred)
    return scored.agg(
        F.sum(((y == 1) & (p == 1)).cast("bigint")).alias("tp"),
        F.sum(((y == 1) & (p == 0)).cast("bigint")).alias("fn"),
        F.sum(((y == 0) & (p == 1)).cast("bigint")).alias("fp"),
        F.sum(((y == 0) & (p == 0)).cast("bigint")).alias("tn"))


def confusion_matrix(scored: DataFrame, label="is_fraud", pred="prediction") -> DataFrame:
    """V1 long form: (actual, predicted, n) for labels [1, 0], zero cells kept."""
    c = confusion_counts(scored, label, pred)
    return c.select(F.expr("stack(4, 1, 1, tp, 1, 0, fn, 0, 1, fp, 0, 0, tn) AS (actual, predicted, n)")) \
        .select(F.col("actual").cast("int"), F.col("predicted").cast("int"), F.col("n").cast("bigint"))


def classification_report(scored: DataFrame, label="is_fraud", pred="prediction", digits=4) -> DataFrame:
    """V2: per class precision/recall/f1/support, accuracy, macro and weighted avg (0/0 -> 0)."""
    c = confusion_counts(scored, label, pred)
    tp, fn, fp, tn = (F.col(x).cast("double") for x in ("tp", "fn", "fp", "tn"))
    n = tp + fn + fp + tn
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    f1_1, f1_0 = _div(2 * p1 * r1, p1 + r1), _div(2 * p0 * r0, p0 + r0)
    s1, s0 = tp + fn, tn + fp
    acc = _div(tp + tn, n)
    rows = F.array(
        F.struct(F.lit("0").alias("class"), p0.alias("precision"), r0.alias("recall"), f1_0.alias("f1"), s0.alias("support")),
        F.struct(F.lit("1").alias("class"), p1.alias("precision"), r1.alias("recall"), f1_1.alias("f1"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("class"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1"), n.alias("support")),
        F.struct(F.lit("macro avg").alias("class"), ((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"),
                 ((f1_0 + f1_1) / 2).alias("f1"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), _div(p0 * s0 + p1 * s1, n).alias("precision"),
                 _div(r0 * s0 + r1 * s1, n).alias("recall"), _div(f1_0 * s0 + f1_1 * s1, n).alias("f1"),
                 n.alias("support")))
    out = c.select(F.inline(rows))
    return out.select("class", *[F.round(x, digits).alias(x) for x in ("precision", "recall", "f1")],
                      F.col("support").cast("bigint").alias("support"))


def summary_scores(scored: DataFrame, label="is_fraud", pred="prediction", beta: float = 2.0,
                   digits=4) -> DataFrame:
    """V3: F-beta (beta=2, positive class), balanced accuracy, recall, precision."""
    c = confusion_counts(scored, label, pred)
    tp, fn, fp, tn = (F.col(x).cast("double") for x in ("tp", "fn", "fp", "tn"))
    prec, rec = _div(tp, tp + fp), _div(tp, tp + fn)
    b2 = beta * beta
    fb = _div((1 + b2) * prec * rec, b2 * prec + rec)
    bal = (rec + _div(tn, tn + fp)) / 2
    return c.select(F.round(fb, digits).alias("f2"), F.round(bal, digits).alias("balanced_accuracy"),
                    F.round(rec, digits).alias("recall"), F.round(prec, digits).alias("precision"))


def pr_curve(scored: DataFrame, label="is_fraud", score="p1", digits=6) -> DataFrame:
    """V4: one point per distinct score, thresholds descending: precision and
    recall of predicting positive for score >= threshold."""
    per = scored.groupBy(score).agg(F.sum(F.col(label).cast("double")).alias("_pos"),
                                    F.count(F.lit(1)).cast("double").alias("_n"))
    cum = with_global_cumsum(per, [score], ["_pos", "_n"], ["_cpos", "_cn"], ascending=False)
    total = scored.agg(F.sum(F.col(label).cast("double")).alias("_P"))
    out = attach(cum, total)   # one-row scalar
    return out.select(F.col(score).alias("threshold"),
                      F.round(_div(F.col("_cpos"), F.col("_cn")), digits).alias("precision"),
                      F.round(_div(F.col("_cpos"), F.col("_P")), digits).alias("recall"),
                      F.col("_cpos").cast("bigint").alias("tp"), F.col("_cn").cast("bigint").alias("n_predicted"))


def average_precision(scored: DataFrame, label="is_fraud", score="p1", digits=6) -> DataFrame:
    """V5: AP = sum over thresholds of (R_n - R_{n-1}) * P_n (step rule).

    R_n - R_{n-1} is the positives at that threshold over all positives, so
    no lag over the curve is needed."""
    per = scored.groupBy(score).agg(F.sum(F.col(label).cast("double")).alias("_pos"),
                                    F.count(F.lit(1)).cast("double").alias("_n"))
    cum = with_global_cumsum(per, [score], ["_pos", "_n"], ["_cpos", "_cn"], ascending=False)
    ap = cum.agg((F.sum(F.col("_pos") * F.col("_cpos") / F.col("_cn")) / F.sum("_pos")).alias("ap"))
    return ap.select(F.round(F.coalesce("ap", F.lit(0.0)), digits).alias("average_precision"))


def no_skill(scored: DataFrame, label="is_fraud", digits=6) -> DataFrame:
    """V7: the no-skill precision level = share of positives."""
    return scored.agg(F.round(F.avg(F.col(label).cast("double")), digits).alias("positive_share"))
