"""M7: a radial kernel for linear learners by random Fourier features.

A kernel machine needs all pairs of rows; here every row is mapped to ``dim``
numbers whose inner products approach ``exp(-gamma |x - y|^2)``, and the linear
SVM is fitted on them.  The mean error of the kernel falls as ``1 / sqrt(dim)``
whatever the number of rows.

A fit reads its rows some hundred times, and ``dim`` numbers a row are many times the table.  ``FourierSVC`` therefore
writes the few inputs of each row once and makes the features anew in every pass; the steps are those of Spark's fit.
"""
from __future__ import annotations

import math
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC, LinearSVCModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.operators.prep import FittedModel, _FitBase
from fraudlens.session import materialize

#: Rows of a written chunk, and of those the rows whose features are made at a time (they stay in a core's cache).
CHUNK_ROWS, SLICE_ROWS = 4096, 128


def fourier_basis(n_inputs: int, dim: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and phases; the same on every machine for a seed."""
    rng = np.random.Generator(np.random.PCG64(seed))
    return rng.normal(0.0, math.sqrt(2.0 * gamma), (dim, n_inputs)), rng.uniform(0.0, 2.0 * math.pi, dim)


class RandomFourierModel(FittedModel):
    def _apply(self, df, st, cfg):
        cols, dim, out = self._cols(), cfg.get("dim", 256), cfg.get("outputCol", "features")
        mean, std = np.array(st["mean"]), np.array(st["std"])
        weights, phase = fourier_basis(len(cols), dim, st["gamma"], cfg.get("seed", 42))

        @F.arrow_udf("array<double>")
        def spread(*parts: pa.Array) -> pa.Array:
            x = np.stack([p.to_numpy(zero_copy_only=False) for p in parts], axis=1)
            x = np.where(np.isfinite(x), (x - mean) / std, 0.0)
            z = math.sqrt(2.0 / dim) * np.cos(x @ weights.T + phase)
            return pa.ListArray.from_arrays(pa.array(np.arange(0, z.size + 1, dim, dtype=np.int32)), pa.array(z.ravel()))
        made = {"fourier": {"cols": cols, "mean": st["mean"], "std": st["std"], "gamma": st["gamma"], "dim": dim, "seed": cfg.get("seed", 42)}}
        return df.withColumn(out, array_to_vector(spread(*[F.col(c).cast("double") for c in cols])).alias(out, metadata=made))


class RandomFourierFeatures(_FitBase):
    """Standardises ``inputCols`` and maps them to ``dim`` (256) numbers in the vector column ``outputCol`` ("features").

    ``gamma`` is the kernel's; unset it is one over the number of columns (their variance is 1 then).  Fitting is one
    aggregate.  The basis follows from ``seed``, so a saved model gives the same features.  NULL, NaN and infinite
    values count as the column's mean, a constant column as zero; ``dim`` bounds the memory of a row."""
    model_cls = RandomFourierModel

    def row_bytes(self) -> int:
        """Of the numbers made of a row."""
        return 8 * self._cfg().get("dim", 256)

    def _state(self, df, cols, cfg):
        if not cols:
            raise ValueError("no input columns")
        x = [F.col(c).cast("double") for c in cols]
        x = [F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v) for v in x]
        row = df.agg(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(x)],
                     *[F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(x)]).first()
        gamma = cfg.get("gamma")
        return {"mean": [row[f"m{i}"] or 0.0 for i in range(len(cols))], "std": [row[f"s{i}"] or 1.0 for i in range(len(cols))],
                "gamma": 1.0 / len(cols) if gamma is None else float(gamma)}


# ------------------------------------------------------------------ the linear SVM on features made in every pass

def _cosine_terms(n: int = 7) -> list[float]:
    """c with sqrt(2) * cos(pi / 2 * sqrt(u)) = sum(c[k] * u ** k) for u in [0, 1/4], to 1e-15."""
    wide = np.longdouble
    u = (1 + np.cos((np.arange(n, dtype=wide) + wide(0.5)) * wide(math.pi) / n)) / 8
    c = np.sqrt(wide(2)) * np.cos(2 * np.arctan(wide(1)) * np.sqrt(u))
    for j in range(1, n):                                                # divided differences
        c[j:] = (c[j:] - c[j - 1:-1]) / (u[j:] - u[:n - j])
    terms = np.zeros(n, wide)
    for i in reversed(range(n)):
        terms = np.concatenate([[wide(0)], terms[:-1]]) - u[i] * terms
        terms[0] += c[i]
    return [float(t) for t in terms]


_TERMS = _cosine_terms()


def half_cosine(turns: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """(1 + cos(2 pi turns)) / 2, in place: the cosine of a quarter of the angle by a polynomial, its angle doubled twice."""
    np.rint(turns, out=spare)
    turns -= spare
    np.multiply(turns, turns, out=spare)
    np.multiply(spare, _TERMS[-1], out=turns)
    turns += _TERMS[-2]
    for t in _TERMS[-3::-1]:
        turns *= spare
        turns += t
    np.multiply(turns, turns, out=turns)
    turns -= 1.0
    return np.multiply(turns, turns, out=turns)


class _Rows:
    """Written chunks of rows (inputs, 1, weight with the label as its sign) and passes over the features made of them."""

    def __init__(self, df: DataFrame, made: dict, label: str, weight: str | None):
        cols, mean, std = made["cols"], np.array(made["mean"]), np.array(made["std"])
        self.dim, self.width = made["dim"], len(cols) + 2
        directions, phase = fourier_basis(len(cols), self.dim, made["gamma"], made["seed"])
        self.turns = np.vstack([directions.T, phase]) / (2.0 * math.pi)

        def pack(batches):
            for b in batches:
                rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]).astype(np.float64, copy=False)
                x, y, w = rows[:, :-2], rows[:, -2], rows[:, -1]
                x = np.where(np.isfinite(x), (x - mean) / std, 0.0)
                rows = np.column_stack([x, np.ones(len(x)), (2 * y - 1) * w])
                bad = ~((y == 0) | (y == 1)) | ~((w >= 0) & (w < math.inf))
                for at in range(0, len(rows), CHUNK_ROWS):
                    here = slice(at, at + CHUNK_ROWS)
                    yield pa.RecordBatch.from_arrays([pa.array([rows[here].tobytes()], pa.binary()), pa.array([int(bad[here].sum())], pa.int64()),
                                                      pa.array([int((y[here] == 1).sum())], pa.int64())], ["rows", "bad", "ones"])
        w = F.col(weight).cast("double") if weight else F.lit(1.0)
        rows = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)], F.col(label).cast("double").alias("y"), w.alias("w"))
        chunks = materialize(rows.mapInArrow(pack, "rows binary, bad bigint, ones bigint"), "fourier")
        seen = chunks.agg(F.sum("bad"), F.sum("ones")).first()
        if seen[0]:
            raise ValueError(f"{seen[0]} rows without a label of 0 or 1 or with a missing, negative or infinite weight")
        if not seen[1]:
            raise ValueError("no rows of label 1")
        self.chunks = chunks.select("rows")

    def passed(self, sums, start) -> list[np.ndarray]:
        """One pass: ``sums(state, s, w)`` takes slices, s * 2 - 1 the cosines of the features; the last state of each task."""
        width, turns, dim = self.width, self.turns, self.dim

        def run(batches):
            state, a, spare = start(), np.empty((SLICE_ROWS, dim)), np.empty((SLICE_ROWS, dim))
            for b in batches:
                for packed in b.column(0):
                    rows = np.frombuffer(packed.as_buffer(), np.float64).reshape(-1, width)
                    for at in range(0, len(rows), SLICE_ROWS):
                        part = rows[at:at + SLICE_ROWS]
                        n = len(part)
                        state = sums(state, half_cosine(np.matmul(part[:, :-1], turns, out=a[:n]), spare[:n]), part[:, -1])
            yield pa.RecordBatch.from_arrays([pa.array([state.tobytes()], pa.binary())], ["state"])
        return [np.frombuffer(r[0]) for r in self.chunks.mapInArrow(run, "state binary").collect()]      # some 2 * dim numbers a task

    def moments(self) -> tuple[float, np.ndarray, np.ndarray]:
        """Sum of the weights, weighted mean and unbiased standard deviation of the features."""
        dim, scale = self.dim, math.sqrt(2.0 / self.dim)

        def merged(p, q):
            if not q[0] or not p[0]:
                return p if p[0] else q
            total, apart = p[0] + q[0], q[2:2 + dim] - p[2:2 + dim]
            return np.concatenate([[total, p[1] + q[1]], p[2:2 + dim] + apart * (q[0] / total), p[2 + dim:] + q[2 + dim:] + apart ** 2 * (p[0] * q[0] / total)])

        def sums(state, s, w):
            w = np.abs(w)
            total = w.sum()
            mean = w @ s / total if total else np.zeros(dim)
            return merged(state, np.concatenate([[total, w @ w], mean, w @ (s - mean) ** 2]))
        out = np.zeros(2 + 2 * dim)
        for state in self.passed(sums, lambda: np.zeros(2 + 2 * dim)):
            out = merged(out, state)
        left = out[0] - out[1] / out[0] if out[0] else 0.0
        std = 2 * scale * np.sqrt(out[2 + dim:] / left) if left > 0 else np.zeros(dim)
        return float(out[0]), scale * (2 * out[2:2 + dim] - 1), std

    def hinge(self, by_feature: np.ndarray, at_zero: float) -> tuple[float, float, np.ndarray]:
        """Of the linear function: sum of the hinge losses, of its derivatives, and of these times each feature."""
        scale = math.sqrt(2.0 / self.dim)
        slope, base = 2 * scale * by_feature, at_zero - scale * by_feature.sum()

        def sums(state, s, w):
            short = 1 - np.sign(w) * (s @ slope + base)
            pull = np.where(short > 0, -w, 0.0)
            state[0] += np.abs(w) @ np.maximum(short, 0.0)
            state[1] += pull.sum()
            state[2:] += pull @ s
            return state
        out = sum(self.passed(sums, lambda n=self.dim: np.zeros(2 + n)))
        return out[0], out[1], scale * (2 * out[2:] - out[1])


class _Failed(Exception):
    """A step that the search gives up."""


def _direction(grad: np.ndarray, steps, changes) -> np.ndarray:
    """Quasi-Newton direction from the last steps and changes of the gradient, where it descends in every coordinate."""
    d, used = grad.copy(), []
    first = 1.0
    if steps:
        sy = steps[0] @ changes[0]
        if not sy >= 0:
            raise _Failed
        first = sy / (changes[0] @ changes[0])
    for s, c in zip(steps, changes):
        rho = s @ c
        a = s @ d / rho
        if math.isnan(a):
            raise _Failed
        used.append((a, rho, s, c))
        d -= a * c
    d *= first
    for a, rho, s, c in reversed(used):
        d += (a - c @ d / rho) * s
    return np.where(-d * grad < 0, -d, 0.0)


def minimised(evaluate, n: int, most: int, tol: float) -> tuple[np.ndarray, list[float]]:
    """The point that the steps of Spark's linear SVM (OWL-QN of 10 corrections without an L1 term) reach from zero, and the values on the way.

    ``evaluate(x)`` gives value and gradient."""
    x = np.zeros(n)
    value, grad = evaluate(x)
    first, values, last = value, [value], deque([math.inf], maxlen=20)
    steps, changes = deque(maxlen=10), deque(maxlen=10)
    at, failed = 0, False
    while at < most and np.linalg.norm(grad) > max(tol * abs(value), 1e-8):
        try:
            with np.errstate(all="ignore"):
                d = _direction(grad, steps, changes)
            side = np.where(x != 0, np.sign(x), np.sign(-grad))

            def taken(step, x=x, d=d, side=side):
                to = x + step * d
                return np.where(np.sign(to) == side, to, 0.0)
            shrink, slope = (0.5 if at else 0.1), grad @ d
            # Spark's search tests its first length against the value where it starts, so that it always shortens it
            step, to, v, g = (1.0 if at else 0.5 / np.linalg.norm(grad)) * shrink, x, value, grad
            for again in range(1, 21 if slope < 0 else 1):
                if not 1e-10 <= step <= 1e10:
                    raise _Failed
                to = taken(step)
                v, g = evaluate(to)
                along = g @ d
                if v > value + step * slope * 1e-4:
                    by = shrink
                elif along < 0.9 * slope:
                    by = 2.1
                elif along > -0.9 * slope:
                    by = shrink
                else:
                    break
                if again == 20:
                    raise _Failed
                step *= by
        except _Failed:
            if failed:
                break
            failed = True
            steps.clear()
            changes.clear()
            values.append(value)
            continue
        failed = False
        steps.appendleft(to - x)
        changes.appendleft(g - grad)
        x, value, grad, at = to, v, g, at + 1
        values.append(value)
        last.append(value)
        if abs(value - max(last)) <= tol * abs(first):
            break
    return x, values


class FourierSVC(LinearSVC):
    """M7: Spark's linear SVM; over the features of a ``RandomFourierModel`` it keeps the inputs of a row, not its features."""

    def _fit(self, df: DataFrame) -> LinearSVCModel:
        made = df.schema[self.getFeaturesCol()].metadata.get("fourier")
        if made is None or not {*made["cols"]} <= {*df.columns}:
            return super()._fit(df)
        rows = _Rows(df, made, self.getLabelCol(), self.getWeightCol() if self.isDefined(self.weightCol) else None)
        total, mean, std = rows.moments()
        inverse = np.divide(1.0, std, out=np.zeros(len(std)), where=std > 0)
        mid, n, centred = mean * inverse, rows.dim, self.getFitIntercept()
        ridge = self.getRegParam() * (np.ones(n) if self.getStandardization() else inverse ** 2)

        def evaluate(v):
            w = v[:n]
            loss, pull, by_feature = rows.hinge(w * inverse, v[n] - w @ mid if centred else 0.0)
            grad = (by_feature * inverse - (mid * pull if centred else 0.0)) / total + ridge * w
            return loss / total + 0.5 * (ridge * w) @ w, np.append(grad, pull / total) if centred else grad
        v, _ = minimised(evaluate, n + centred, self.getMaxIter(), self.getTol())
        intercept = float(v[n] - v[:n] @ mid) if centred else 0.0
        java = self._new_java_obj("org.apache.spark.ml.classification.LinearSVCModel", self.uid,
                                  _py2java(df.sparkSession.sparkContext, Vectors.dense(v[:n] * inverse)), intercept)
        return self._copyValues(LinearSVCModel(java))
