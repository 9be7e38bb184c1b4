"""Registered queries on exact neighbours: k-NN imputation (F2), k-NN classifier (M8), the SMOTE family and ENN."""
from __future__ import annotations

from pyspark.sql import functions as F

from fraudlens.operators import knn as K
from fraudlens.operators import resampling as R
from fraudlens.operators.sampling import LEHMER_A, LEHMER_M
from fraudlens.plans.oracle import with_tx
from fraudlens.plans.registry import register, tx

_FILL = ["amount", "day_no", "MCCs", "store_card_merchant_id", "pos_id"]
_NEAR = ["amount", "day_no", "merchant_id", "date_in_sec"]


def _gap(j: str) -> str:
    return f"(a.{j} - b.{j}) * (a.{j} - b.{j})"


# in column order, as the neighbour search adds them up; common coordinates only
_SKIP = "(0.0 + " + " + ".join(f"coalesce({_gap(c)}, 0.0)" for c in _FILL) + ")"
_COMMON = "(" + " + ".join(f"CAST(a.{c} IS NOT NULL AND b.{c} IS NOT NULL AS INTEGER)" for c in _FILL) + ")"


def _filled(c: str) -> str:
    return f"""n_{c} AS (SELECT q, avg(v) AS v FROM (
  SELECT a.id AS q, unnest(min_by(b.{c}, {{'d': {_SKIP} * {float(len(_FILL))} / {_COMMON}, 'id': b.id}}, 2)) AS v
  FROM f a JOIN f b ON a.{c} IS NULL AND b.{c} IS NOT NULL AND {_COMMON} > 0 GROUP BY a.id) GROUP BY q)"""


@register("f2_knn_impute", with_tx(
    "SELECT f.id AS transaction_id, " + ", ".join(
        f"round(coalesce(f.{c}, n_{c}.v, (SELECT avg({c}) FROM f)), 6) AS {c}" for c in _FILL)
    + " FROM f " + " ".join(f"LEFT JOIN n_{c} ON n_{c}.q = f.id" for c in _FILL),
    extra="f AS (SELECT transaction_id AS id, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _FILL) + " FROM transactions),\n"
    + ",\n".join(map(_filled, _FILL))))
def q_f2(spark, sf):
    t = tx(spark, sf).select("transaction_id", *[F.col(c).cast("double").alias(c) for c in _FILL])
    out = K.KnnImputer(_FILL, n_neighbors=2).fit(t).transform(t)
    return out.select("transaction_id", *[F.round(c, 6).alias(c) for c in _FILL])


# ------------------------------------------------------------------ labelled rows

_D = "(0.0 + " + " + ".join(map(_gap, _NEAR)) + ")"
_R = ("r AS (SELECT transaction_id AS id, is_fraud AS y, coalesce(amount, 0.0) AS amount, "
      + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _NEAR[1:]) + " FROM transactions),\nc AS (SELECT count(*) FILTER (WHERE y = 0) AS n0, "
      "count(*) FILTER (WHERE y = 1) AS n1 FROM r)")


def _near(name: str, of: str, among: str, k: int, what: str = "b.y") -> str:
    """(q, rank, v): the k nearest other rows."""
    return f"""{name} AS (SELECT q, unnest(range(1, len(l) + 1)) AS rank, unnest(l) AS v FROM (
  SELECT a.id AS q, min_by({what}, {{'d': {_D}, 'id': b.id}}, {k}) AS l FROM r a JOIN r b ON a.id <> b.id AND {of} AND {among} GROUP BY a.id))"""


def _uniform(key: str, seed: int) -> str:
    return f"(CAST((((({key}) % {LEHMER_M}) + {seed}) % {LEHMER_M}) * {LEHMER_A} % {LEHMER_M} AS DOUBLE) / {LEHMER_M}.0)"


def _interpolated(copies: str) -> str:
    """Rows made from ``copies`` (id, copies) and neighbours ``k5`` (q, rank, v as struct)."""
    cols = ", ".join(f"round(r.{c} + gap * (v.{c} - r.{c}), 6) AS {c}" for c in _NEAR)
    return f"""SELECT base_id, copy, 1.0::DOUBLE AS is_fraud, {cols} FROM (
  SELECT id AS base_id, copy, n, {_uniform(f"id * {R.COPIES} + copy", 44)} AS gap,
         CAST(floor({_uniform(f"id * {R.COPIES} + copy", 43)} * n) AS INTEGER) + 1 AS pick
  FROM (SELECT id, unnest(range(1, copies + 1)) AS copy FROM ({copies}) WHERE copies > 0)
  JOIN (SELECT q, max(rank) AS n FROM k5 GROUP BY q) ON q = id) JOIN r ON r.id = base_id JOIN k5 ON k5.q = base_id AND k5.rank = pick"""


_K5 = _near("k5", "a.y = 1", "b.y = 1", 5, "{" + ", ".join(f"'{c}': b.{c}" for c in _NEAR) + "}")


def _even(base: str) -> str:
    return f"""SELECT id, (n0 - n1) // n + CAST(row_number() OVER (ORDER BY {_uniform("id", 42)}, id) <= (n0 - n1) % n AS BIGINT) AS copies
  FROM (SELECT id, count(*) OVER () AS n FROM {base}), c"""


def _labelled(spark, sf):
    t = tx(spark, sf)
    return t.select("transaction_id", F.col("is_fraud").cast("double").alias("is_fraud"), F.coalesce("amount", F.lit(0.0)).alias("amount"),
                    *[F.col(c).cast("double").alias(c) for c in _NEAR[1:]])


def _rounded(df):
    return df.select("base_id", "copy", "is_fraud", *[F.round(c, 6).alias(c) for c in _NEAR])


@register("l8_smote", with_tx(_interpolated(_even("r WHERE y = 1")), extra=f"{_R},\n{_K5}"))
def q_l8_smote(spark, sf):
    return _rounded(R.smote_rows(_labelled(spark, sf), _NEAR, method="lehmer"))


@register("l8_borderline_smote", with_tx(_interpolated(_even("danger")), extra=f"{_R},\n{_K5},\n" + _near("m10", "a.y = 1", "true", 10) + """,
danger AS (SELECT q AS id FROM m10 GROUP BY q HAVING count(*) FILTER (WHERE v = 0) BETWEEN 5 AND 9)"""))
def q_l8_borderline(spark, sf):
    return _rounded(R.borderline_smote_rows(_labelled(spark, sf), _NEAR, method="lehmer"))


@register("l8_adasyn", with_tx(_interpolated("""SELECT id, CAST(round_even(n_other * CAST(n0 - n1 AS DOUBLE) / CAST(sum(n_other) OVER () AS DOUBLE), 0) AS BIGINT) AS copies
  FROM (SELECT q AS id, count(*) FILTER (WHERE v = 0) AS n_other FROM m5 GROUP BY q), c"""),
    extra=f"{_R},\n{_K5},\n" + _near("m5", "a.y = 1", "true", 5)))
def q_l8_adasyn(spark, sf):
    return _rounded(R.adasyn_rows(_labelled(spark, sf), _NEAR, method="lehmer"))


@register("l8_edited_neighbours", with_tx("SELECT id AS transaction_id, CAST(y AS DOUBLE) AS is_fraud FROM r WHERE y = 1 OR id NOT IN (SELECT q FROM m3 WHERE v <> 0)",
                                          extra=f"{_R},\n" + _near("m3", "a.y = 0", "true", 3)))
def q_l8_enn(spark, sf):
    return R.edited_nearest_neighbours(_labelled(spark, sf), _NEAR).select("transaction_id", "is_fraud")


@register("m8_knn_classifier", with_tx("""SELECT q AS transaction_id, CAST(avg(v) > 0.5 AS INTEGER) AS prediction, round(1 - avg(v), 6) AS p0, round(avg(v), 6) AS p1
FROM (""" + _near("k", "a.id % 5 = 0", "b.id % 5 <> 0", 5).removeprefix("k AS (").removesuffix(")") + ") GROUP BY q", extra=_R))
def q_m8(spark, sf):
    """Fitted, saved and loaded on four fifths of the rows, scored on the others."""
    from fraudlens.operators import models as M
    t = _labelled(spark, sf)
    model = K.KnnClassifier(_NEAR, n_neighbors=5).fit(t.where(F.col("transaction_id") % 5 != 0))
    s = M.score(model, t.where(F.col("transaction_id") % 5 == 0), keep=("transaction_id",))
    return s.select("transaction_id", "prediction", F.round("p0", 6).alias("p0"), F.round("p1", 6).alias("p1"))
