"""End-to-end jobs mirroring the reference's three entry points.

* ``cleanse_and_profile``: schema casts, quality findings, profile and EDA
  report tables (each a small DataFrame; written as Parquet when ``out`` is given);
* ``train_and_evaluate``: time split, repeated stratified tuning with F2,
  model store + run record, scoring and evaluation tables;
* the feature job lives in ``feature_job.py``.
"""
from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.operators import aggregates as A
from fraudlens.operators import evaluate as V
from fraudlens.operators import models as M
from fraudlens.operators import profile as G
from fraudlens.operators import quality as Q
from fraudlens.operators.windows import rapid_share_by_label
from fraudlens.operators.prep import ExactImputer
from fraudlens.plans import training as TR
from fraudlens.sources import io as S


def _write(reports: dict, out: str | None) -> dict:
    if out:
        for name, df in reports.items():
            S.write_table(df, f"{out.rstrip('/')}/{name}")
    return reports


def cleanse_and_profile(tx: DataFrame, schema_df: DataFrame, target: str = "is_fraud",
                        out: str | None = None) -> tuple[DataFrame, dict]:
    """Entry 3: returns (cleaned table, report tables)."""
    clean, notes = Q.convert_datatypes(Q.replace_null_like_values(tx), schema_df)
    label = F.col(target).cast("int")
    lab = clean.withColumn(target, label)
    reports = {
        "type_warnings": tx.sparkSession.createDataFrame([(n,) for n in notes] or [("",)], "note string")
                           .where(F.col("note") != ""),
        "missing_columns": Q.check_missing_columns(clean, schema_df),
        "non_nullable_violations": Q.check_non_nullable_violation(clean, schema_df),
        "type_mismatches": Q.check_data_types(clean, schema_df),
        "negative_values": Q.check_non_negative_violations(clean),
        "categorical_findings": Q.check_categorical_features(clean, schema_df),
        "null_counts": Q.null_counts(clean),
        "duplicates": Q.duplicate_summary(clean),
        "describe_numeric": G.describe_numeric(lab),
        "class_balance": G.class_balance(lab, target),
        "imbalance": G.imbalance(lab, target),
        "merchant_rates": A.group_rate(lab, "merchant_id", target),
        "customer_counts": A.customer_counts(lab, target),
        "mcc_rates": A.group_rate(lab, "MCCs", target),
        "card_presence_crosstab": A.normalized_crosstab(lab, "card_present_or_not", target),
        "by_hour": A.by_time_part(lab, "hour", target),
        "rapid_transactions": rapid_share_by_label(lab, target=target),
        "correlations": G.correlation_pairs(lab),
    }
    return clean, _write(reports, out)


def train_and_evaluate(tx: DataFrame, family: str = "gbt", grid_rows: list[dict] | None = None,
                       model_root: str | None = None, target: str = "is_fraud", k: int = 5, repeats: int = 3,
                       out: str | None = None, grid_file: str | None = None, model_name: str | None = None,
                       drop: list[str] = (), prep_stages=None, selectors=(), forest=None, resampling=None, **params) -> dict:
    """Entry 2: tune on the time-ordered training part, keep the model and its
    run record, score the test part and evaluate it.

    The tuned pipeline is the whole of it: features without the ``drop`` list, imputer (``prep_stages``; the median by
    default), ``selectors``, ``resampling``, ``forest`` selection and classifier, all fitted inside each fold.  The grid comes
    from ``grid_rows`` or from the lines of ``model_name`` in ``grid_file``; the trace has test and train scores."""
    train, test = TR.train_test(tx, impute=False)
    features = [c for c in TR.MODEL_FEATURES if c not in set(drop)]
    if prep_stages is None:
        prep_stages = [ExactImputer([c for c in ("amount", "customer_id_ma_amount_1d") if c in features], strategy="median")]
    clf = M.make_classifier(family, label=target, **params)
    pipe = M.build_pipeline(features, clf, prep_stages, selectors, forest, resampling)
    clf = pipe.getStages()[-1]
    spark = tx.sparkSession
    values = {r["parameter"]: r["values"] for r in grid_rows or []}
    grid = M.param_grid(clf, grid_rows) if grid_rows else None
    if grid_file:
        values = M.read_grid(spark, grid_file, model_name or family)
        grid = M.grid_of(clf, values)
    trace = None
    if grid:
        model, trace = M.tune_with_trace(pipe, grid, train, target, k=k, repeats=repeats)
        first = trace.where("rank = 1").first()
        best, params_used = first["mean_test_score"], json.loads(first["params"])
    else:
        model, best, params_used = M.fit(pipe, train), None, dict(params)
    version = None
    if model_root:
        version = S.save_model(spark, model, model_root, target)
        S.save_run_record(spark, model_root, target, version, params_used, best,
                          values)
    scored = M.score(model, test, keep=("transaction_id", target))
    reports = {"confusion": V.confusion_matrix(scored, target), "report": V.classification_report(scored, target),
               "scores": V.summary_scores(scored, target)}
    if trace is not None:
        reports["tuning_trace"] = trace
    if "p1" in scored.columns:
        reports["pr_curve"] = V.pr_curve(scored, target)
        reports["average_precision"] = V.average_precision(scored, target)
    _write(reports, out)
    return {"model": model, "version": version, "best_score": best, "params": params_used, **reports}
