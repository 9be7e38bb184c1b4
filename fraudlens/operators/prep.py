"""Fit/transform feature preparation as ``pyspark.ml`` stages.

Fitting is one aggregation pass over the data; the fitted state (fill
values, edges, means, kept columns) is a handful of numbers per column,
stored as a JSON param so models save/load with ``Pipeline`` persistence.
Transforms are plain column expressions with those numbers as literals.
"""
from __future__ import annotations

import json
import math

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.operators.profile import correlation_pairs, spearman_pairs


def _p(name, doc, conv=TypeConverters.identity):
    return Param(Params._dummy(), name, doc, typeConverter=conv)


class _Common(Params):
    inputCols = _p("inputCols", "columns to work on", TypeConverters.toListString)
    config = _p("config", "JSON options", TypeConverters.toString)

    def _cfg(self) -> dict:
        return json.loads(self.getOrDefault(self.config)) if self.isDefined(self.config) else {}

    def _cols(self) -> list[str]:
        return self.getOrDefault(self.inputCols)


class FittedModel(Model, _Common, DefaultParamsReadable, DefaultParamsWritable):
    """A model whose fitted state is JSON; subclasses implement ``_apply``."""
    state = _p("state", "fitted state as JSON", TypeConverters.toString)

    def __init__(self, inputCols=None, config="{}", state="{}"):
        super().__init__()
        self._set(inputCols=inputCols or [], config=config, state=state)

    def fitted(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    def _transform(self, df: DataFrame) -> DataFrame:
        return self._apply(df, self.fitted(), self._cfg())


class _FitBase(Estimator, _Common, DefaultParamsReadable, DefaultParamsWritable):
    model_cls = FittedModel

    def __init__(self, inputCols=None, **cfg):
        super().__init__()
        self._set(inputCols=list(inputCols or []), config=json.dumps(cfg))

    def _fit(self, df: DataFrame):
        cols = [c for c in self._cols() if c in df.columns]     # earlier selectors may have dropped some
        st = self._state(df, cols, self._cfg())
        return self.model_cls(inputCols=cols, config=self.getOrDefault(self.config), state=json.dumps(st))


# ------------------------------------------------------------------ F1 impute

class ImputerModel(FittedModel):
    def _apply(self, df, st, cfg):
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in st.items() if v is not None})


class ExactImputer(_FitBase):
    """fill NULLs by ``strategy`` = mean | median (exact, interpolated) |
    most_frequent (ties -> smallest) | constant (``fill_value``)."""
    model_cls = ImputerModel

    def _state(self, df, cols, cfg):
        s = cfg.get("strategy", "mean")
        if s == "constant":
            return {c: cfg.get("fill_value", 0) for c in cols}
        if s == "mean":
            r = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)]).first()
            return {c: r[f"v{i}"] for i, c in enumerate(cols)}
        if s == "median":
            from fraudlens.operators.profile import quantiles
            out = {}
            for c in cols:
                r = quantiles(df, c, [0.5]).first()
                out[c] = r["_q"][0] if r is not None and r["_q"] else None
            return out
        if s == "most_frequent":
            out = {}
            for c in cols:
                g = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
                r = g.agg(F.min_by(c, F.struct((-F.col("_n")).alias("a"), F.col(c).alias("b"))).alias("m")).first()
                out[c] = r["m"]
            return out
        raise ValueError(f"unknown strategy {s}")


# ------------------------------------------------------------------ F3 binning

class BinnerModel(FittedModel):
    def _apply(self, df, st, cfg):
        cols = {}
        for c, edges in st.items():
            inner = edges[1:-1]
            b = sum((F.col(c) >= F.lit(e)).cast("int") for e in inner) if inner else F.lit(0)
            cols[c] = F.when(F.col(c).isNotNull(), b.cast("double"))
        return df.withColumns(cols)


class EqualWidthBinner(_FitBase):
    """equal-width bins (``bins``: {column: n}); ordinal codes 0..n-1; edges kept
    in the model (``edges_``)."""
    model_cls = BinnerModel

    def _state(self, df, cols, cfg):
        bins = cfg["bins"]
        r = df.agg(*[F.min(F.col(c).cast("double")).alias(f"a{i}") for i, c in enumerate(bins)],
                   *[F.max(F.col(c).cast("double")).alias(f"b{i}") for i, c in enumerate(bins)]).first()
        st = {}
        for i, (c, n) in enumerate(bins.items()):
            mn, mx = r[f"a{i}"], r[f"b{i}"]
            st[c] = [mn + k * ((mx - mn) / n) for k in range(n)] + [mx]
        return st


def bins_from_config(cfg_df: DataFrame) -> dict[str, int]:
    """``bin_n`` groups -> {column: n} (the config table is tiny)."""
    g = cfg_df.groupBy("bin").agg(F.sort_array(F.collect_list("column_name")).alias("cols")).collect()
    return {c: int(r["bin"].split("_")[1]) for r in g for c in r["cols"]}


# ------------------------------------------------------------------ F4, F5 scaling

class StandardModel(FittedModel):
    def _apply(self, df, st, cfg):
        return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s if s else 1.0) for c, (m, s) in st.items()})


class PopulationStandardScaler(_FitBase):
    """(x - mean) / population std (std 0 -> scale 1, as sklearn)."""
    model_cls = StandardModel

    def _state(self, df, cols, cfg):
        r = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
                   *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        return {c: (r[f"m{i}"], r[f"s{i}"]) for i, c in enumerate(cols)}


class MinMaxModel(FittedModel):
    def _apply(self, df, st, cfg):
        return df.withColumns({c: (F.col(c) - F.lit(a)) / F.lit((b - a) if b != a else 1.0) for c, (a, b) in st.items()})


class ZeroOneScaler(_FitBase):
    """(x - min) / (max - min); a constant column maps to 0 (sklearn rule)."""
    model_cls = MinMaxModel

    def _state(self, df, cols, cfg):
        r = df.agg(*[F.min(F.col(c).cast("double")).alias(f"a{i}") for i, c in enumerate(cols)],
                   *[F.max(F.col(c).cast("double")).alias(f"b{i}") for i, c in enumerate(cols)]).first()
        return {c: (r[f"a{i}"], r[f"b{i}"]) for i, c in enumerate(cols)}


# ------------------------------------------------------------------ selectors

class SelectModel(FittedModel):
    """Keeps ``keep`` out of ``inputCols``; other columns pass through."""

    def _apply(self, df, st, cfg):
        drop = [c for c in self._cols() if c not in set(st["keep"])]
        return df.drop(*drop)


class VarianceThresholdFilter(_FitBase):
    """F8: keep columns whose population variance > ``threshold`` (0.001)."""
    model_cls = SelectModel

    def _state(self, df, cols, cfg):
        t = cfg.get("threshold", 0.001)
        r = df.agg(*[F.var_pop(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)]).first()
        return {"keep": [c for i, c in enumerate(cols) if r[f"v{i}"] is not None and r[f"v{i}"] > t],
                "variance": {c: r[f"v{i}"] for i, c in enumerate(cols)}}


class NullRatioFilter(_FitBase):
    """keep columns with at least int(threshold * N) non-NULL values."""
    model_cls = SelectModel

    def _state(self, df, cols, cfg):
        t = cfg.get("threshold", 0.5)
        r = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(f"c{i}") for i, c in enumerate(cols)]).first()
        need = int(t * r["_n"])
        return {"keep": [c for i, c in enumerate(cols) if r[f"c{i}"] >= need]}


def _components(nodes, edges):
    """Union-find over feature names (p nodes, on the driver)."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    groups = {}
    for n in nodes:
        groups.setdefault(find(n), []).append(n)
    return [sorted(g) for g in groups.values()]


class SpearmanCorrelationFilter(_FitBase):
    """features linked by |Spearman| > threshold (0.85) form connected
    components; keep one per component (first by name) plus every feature
    without a strong link.  The p x p pair table comes from one pass."""
    model_cls = SelectModel

    def _state(self, df, cols, cfg):
        t = cfg.get("threshold", 0.85)
        pairs = spearman_pairs(df, cols, unrounded=True).collect()       # p(p-1)/2 rows
        strong = [(r["feature_1"], r["feature_2"]) for r in pairs if r["corr"] is not None and abs(r["corr"]) > t]
        linked = {x for e in strong for x in e}
        comps = _components(sorted(linked), strong)
        keep = [c for c in cols if c not in linked or any(c == g[0] for g in comps)]
        return {"keep": keep, "groups": comps}


class PearsonCorrelationFilter(_FitBase):
    """drop a column when any earlier column has |Pearson| > threshold (0.9)."""
    model_cls = SelectModel

    def _state(self, df, cols, cfg):
        t = cfg.get("threshold", 0.9)
        pairs = correlation_pairs(df, cols, digits=12).collect()
        drop = {r["feature_2"] for r in pairs if r["corr"] is not None and abs(r["corr"]) > t}
        return {"keep": [c for c in cols if c not in drop]}


def _chi2_sf(x: float, dof: int) -> float:
    """Upper tail of the chi-square distribution (regularised gamma Q(dof/2, x/2))."""
    if x <= 0:
        return 1.0
    a, z = dof / 2.0, x / 2.0
    if z < a + 1:      # series for P, then Q = 1 - P
        term = s = 1.0 / a
        n = a
        for _ in range(10_000):
            n += 1
            term *= z / n
            s += term
            if abs(term) < abs(s) * 1e-15:
                break
        return max(0.0, 1.0 - s * math.exp(-z + a * math.log(z) - math.lgamma(a)))
    b, c, d = z + 1 - a, 1e300, 1.0 / (z + 1 - a)     # continued fraction for Q
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-15:
            break
    return math.exp(-z + a * math.log(z) - math.lgamma(a)) * h


def chi_square_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Chi-square statistic per categorical pair (as scipy: Yates-corrected when
    dof = 1), with dof and the mean expected count.

    One scan for all pairs: each row emits one (pair, a, b) triple per pair,
    counted with map-side partial aggregation.  Only observed cells are
    materialised (no r x c grid): cells with count 0 contribute their expected
    count, so their total is n - sum(expected over observed cells).  A 2 x 2
    table (the Yates case) gets its four expected counts from the two row and
    two column margins."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "feature_1 string, feature_2 string, chi2 double, dof int, "
                                                   "expected_mean double")
    trip = F.explode(F.array(*[F.struct(F.lit(k).alias("_k"), F.col(a).cast("string").alias("_a"),
                                        F.col(b).cast("string").alias("_b")) for k, (a, b) in enumerate(pairs)]))
    ct = (df.select(trip.alias("_p")).select("_p._k", "_p._a", "_p._b")
          .where(F.col("_a").isNotNull() & F.col("_b").isNotNull())
          .groupBy("_k", "_a", "_b").agg(F.count(F.lit(1)).cast("double").alias("o")))
    ra = ct.groupBy("_k", "_a").agg(F.sum("o").alias("ra"))
    cb = ct.groupBy("_k", "_b").agg(F.sum("o").alias("cb"))
    tot = ct.groupBy("_k").agg(F.sum("o").alias("n"), F.count_distinct("_a").alias("r"),
                               F.count_distinct("_b").alias("c"))          # one row per pair
    cells = ct.join(ra, ["_k", "_a"]).join(cb, ["_k", "_b"]).join(F.broadcast(tot), "_k")
    e = F.col("ra") * F.col("cb") / F.col("n")
    d = F.abs(F.col("o") - e)

    def f0(ev):      # Yates term of a cell with count 0
        return F.pow(F.greatest(ev - F.least(F.lit(0.5), ev), F.lit(0.0)), 2) / ev
    yd = F.greatest(d - F.least(F.lit(0.5), d), F.lit(0.0))
    g = cells.groupBy("_k", "r", "c", "n").agg(
        F.sum(d * d / e).alias("_obs"), F.sum(e).alias("_eobs"), F.sum(yd * yd / e).alias("_yobs"),
        F.sum(f0(e)).alias("_f0obs"))
    m = ra.groupBy("_k").agg(F.min("ra").alias("r1"), F.max("ra").alias("r2")).join(
        cb.groupBy("_k").agg(F.min("cb").alias("c1"), F.max("cb").alias("c2")), "_k")
    names = df.sparkSession.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)],
                                            "_k int, feature_1 string, feature_2 string")
    g = g.join(F.broadcast(m), "_k").join(F.broadcast(names), "_k")     # one row per pair each
    dof = (F.col("r") - 1) * (F.col("c") - 1)
    all4 = sum(f0(F.col(x) * F.col(y) / F.col("n")) for x in ("r1", "r2") for y in ("c1", "c2"))
    return g.select("feature_1", "feature_2",
                    F.when(dof == 1, F.col("_yobs") + all4 - F.col("_f0obs"))
                     .otherwise(F.col("_obs") + F.col("n") - F.col("_eobs")).alias("chi2"),
                    dof.cast("int").alias("dof"), (F.col("n") / (F.col("r") * F.col("c"))).alias("expected_mean"))


class ChiSquareFilter(_FitBase):
    """for every categorical pair with p < alpha (0.05): drop the first
    when chi2 >= mean expected count, else the second."""
    model_cls = SelectModel

    def _state(self, df, cols, cfg):
        alpha = cfg.get("alpha", 0.05)
        drop = set()
        for r in chi_square_pairs(df, cols).collect():     # p(p-1)/2 rows
            if r["dof"] > 0 and _chi2_sf(r["chi2"], r["dof"]) < alpha:
                drop.add(r["feature_1"] if r["chi2"] >= r["expected_mean"] else r["feature_2"])
        return {"keep": [c for c in cols if c not in drop]}


# ------------------------------------------------------------------ F14

class KBestFilter(_FitBase):
    """the ``k`` numeric columns of highest ANOVA F against ``label`` (all, if fewer); rows with a NULL or NaN in one
    of the columns take no part in the test."""
    model_cls = SelectModel

    def _state(self, df, cols, cfg):
        from pyspark.ml.feature import UnivariateFeatureSelector, VectorAssembler
        label, k = cfg["label"], int(cfg["k"])
        if k >= len(cols):
            return {"keep": cols}
        x = df.select(*[F.col(c).cast("double").alias(c) for c in cols], F.col(label).cast("double").alias("_label"))
        x = VectorAssembler(inputCols=cols, outputCol="_v", handleInvalid="skip").transform(x.where(F.col("_label").isNotNull()))
        st = UnivariateFeatureSelector(featuresCol="_v", labelCol="_label", outputCol="_o", selectionMode="numTopFeatures")
        best = st.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(k).fit(x).selectedFeatures
        return {"keep": [c for i, c in enumerate(cols) if i in set(best)]}


def stats_selection_stages(numeric: list[str], variance: float = 0.001, spearman: float = 0.85, k_best: int | None = None,
                           label: str | None = None) -> list:
    """stages that select the numeric columns by variance, by rank correlation and, if ``k_best`` is given, by F
    against ``label``.  All other columns pass through."""
    stages = [VarianceThresholdFilter(numeric, threshold=variance), SpearmanCorrelationFilter(numeric, threshold=spearman)]
    return stages + ([KBestFilter(numeric, k=k_best, label=label)] if k_best else [])


# ------------------------------------------------------------------ F15

class FunctionTransformer(Transformer):
    """any ``DataFrame -> DataFrame`` function as a pipeline stage."""

    def __init__(self, func, **kwargs):
        super().__init__()
        self.func, self.kwargs = func, kwargs

    def _transform(self, df):
        return self.func(df, **self.kwargs)
