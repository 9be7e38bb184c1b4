"""forests of thousands of shallow trees over rows that are binned once.

A tree sees a row only through its bins, its class and how often its bootstrap draws the row.  ``binned`` writes the
bins once, in chunks of rows of one class.  A draw is Poisson of mean 1, as in Spark's forests; it follows from
the seed, the chunk and the tree, so every pass draws the same and no count is stored for a row and tree.  A level of all
trees of a fit is one pass: the draws of a chunk's rows in each open node, times the indicators of a feature's bins,
are the class sums behind every split of that feature, and the sums of all tasks meet by feature.  Thresholds, Gini
gain, merging of leaves of one prediction and importances are those of Spark's trees.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import classification
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.operators.boosting import SAMPLE_ROWS, thresholds
from fraudlens.session import materialize

#: Rows of a chunk: its draws for a part of the forest stay in a core's cache.
CHUNK_ROWS = 4096
#: Chunks of a written file at most.
FILE_CHUNKS = 1024
#: Cells of the matrix of a chunk's rows and a pass's open nodes.
NODE_CELLS = 1 << 22

# P(Poisson(1) <= k) on the scale of 32 random bits
_UP_TO = np.minimum(np.round(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(13)]) * 2.0 ** 32), 2 ** 32 - 1).astype(np.uint32)


class Binned:
    """Chunks of a table for the parts of a forest, each with thresholds of its own sample, as each of Spark's fits has.

    The bins written are those between the thresholds of all parts; ``rows(part)`` says by its metadata where those of the part lie."""

    def __init__(self, chunks: DataFrame, features: str, classes: int, cuts: list):
        self.chunks, self.features, self.classes, self.cuts = chunks, features, classes, cuts
        self.fine = _union(cuts)

    def rows(self, part: int) -> DataFrame:
        """(chunk, label, features), the last the bins of a chunk's rows, feature by feature."""
        at = [{"at": np.searchsorted(fine, c).tolist()} for fine, c in zip(self.fine, self.cuts[part % len(self.cuts)])]
        shape = {"classes": self.classes, "fine": [len(c) + 1 for c in self.fine], "cuts": at}
        return self.chunks.withColumn(self.features, F.col(self.features).alias(self.features, metadata=shape))


def _union(cuts: list) -> list[np.ndarray]:
    return [np.unique(np.concatenate(c)) for c in zip(*cuts)]


def _width(fine: list[int]):
    return np.uint16 if max(fine) <= 1 << 16 else np.uint32


def _cuts(x: DataFrame, rows: int, n: int, parts: int, bins: int, seed: int) -> list:
    """Thresholds by part and feature of the vectors ``x``: of all rows (one part) or, of larger tables, of a random sample a part."""
    most = max(bins * bins, SAMPLE_ROWS)
    if rows <= most:
        parts, drawn = 1, x.select(F.lit(0).alias("part"), "x")
    else:
        def draw(batches):
            rng = np.random.default_rng([seed % (1 << 64), TaskContext.get().partitionId()])
            for b in batches:
                size = rng.binomial(len(b), most / rows, parts)
                at = np.concatenate([rng.choice(len(b), k, replace=False) for k in size]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(parts, dtype=np.int32), size)), b.column(0).take(pa.array(at))], ["part", "x"])
        drawn = x.mapInArrow(draw, "part int, x array<double>")

    def cut(key, table):
        values = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
        cuts = [thresholds(values[:, f], np.ones(len(values)), bins - 1) for f in range(n)]
        return pa.table({"part": [key[0]] * n, "f": pa.array(range(n), pa.int32()), "cuts": pa.array([c.tolist() for c in cuts], pa.list_(pa.float64()))})
    out = [[np.zeros(0)] * n for _ in range(parts)]
    for r in drawn.groupBy("part").applyInArrow(cut, "part int, f int, cuts array<double>").collect():     # ``bins`` numbers a part and feature
        out[r["part"]][r["f"]] = np.array(r["cuts"], np.float64)
    return out


def binned(df: DataFrame, features: str, n: int, label: str, parts: int = 1, bins: int = 32, seed: int = 42) -> Binned:
    """The rows of ``df``, of which ``features`` is a vector of ``n`` numbers, as chunks for forests in ``parts`` parts."""
    rows = df.select(F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x"))
    y = F.col("y")
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max(y).alias("most"),
                    F.count(F.when(F.coalesce(F.isnan(y) | (y < 0) | (y > 99) | (y != F.floor(y)), F.lit(True)), 1)).alias("bad"),
                    F.count(F.when(F.coalesce(F.exists("x", lambda v: F.isnan(v) | (F.abs(v) == math.inf)), F.lit(True)), 1)).alias("open")).first()
    if not seen["n"]:
        raise ValueError("no rows to fit")
    if seen["bad"] or seen["open"]:
        raise ValueError(f"{seen['bad']} rows without a class number, {seen['open']} rows with a missing or infinite feature")
    cuts = _cuts(rows.select("x"), seen["n"], n, parts, bins, seed)
    fine = _union(cuts)
    width = _width([len(c) + 1 for c in fine])

    def run(batches):
        held, chunks = {}, TaskContext.get().partitionId() << 32

        def packed(of, rows):
            nonlocal chunks
            chunks += 1
            return pa.RecordBatch.from_arrays([pa.array([chunks], pa.int64()), pa.array([of], pa.int32()),
                                               pa.array([np.ascontiguousarray(rows.T).tobytes()], pa.binary())], ["chunk", label, features])
        for b in batches:
            of = b.column(0).to_numpy(zero_copy_only=False).astype(np.int32)
            values = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(of), n)
            rows = np.column_stack([np.searchsorted(fine[f], values[:, f]).astype(width) for f in range(n)])
            for c in np.unique(of).tolist():
                mine = np.concatenate([held[c], rows[of == c]]) if c in held else rows[of == c]
                whole = len(mine) - len(mine) % CHUNK_ROWS
                for at in range(0, whole, CHUNK_ROWS):
                    yield packed(c, mine[at:at + CHUNK_ROWS])
                held[c] = mine[whole:]
        for c, mine in held.items():
            if len(mine):
                yield packed(c, mine)
    most = seen["n"] // CHUNK_ROWS + 1
    files = max(min(most, 4 * df.sparkSession.sparkContext.defaultParallelism), most // FILE_CHUNKS)
    chunks = rows.mapInArrow(run, f"chunk bigint, `{label}` int, `{features}` binary").repartition(files)
    return Binned(materialize(chunks, "forest"), features, max(int(seen["most"]) + 1, 2), cuts)


def draws(seed: int, chunk: int, trees: int, rows: int) -> np.ndarray:
    """How often each tree's bootstrap draws each row of a chunk."""
    n = trees * rows
    bits = np.random.SFC64(np.random.SeedSequence([seed, chunk])).random_raw(-(-n // 2)).view(np.uint32)[:n]
    out = (bits >= _UP_TO[0]).view(np.uint8)
    for up in _UP_TO[1:4]:
        out += bits >= up
    many = np.flatnonzero(bits >= _UP_TO[4])
    out[many] = np.searchsorted(_UP_TO, bits[many], "right")
    return out.reshape(trees, rows)


def _gini(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Impurity and weight of class sums (nodes, classes, ...)."""
    total = sums.sum(1)
    return 1 - ((sums / np.where(total > 0, total, 1)[:, None]) ** 2).sum(1), total


def _best(sums: np.ndarray):
    """Of class sums (nodes, classes, bins): gain, number of the threshold, class sums left and right of each node's best split."""
    left = sums.cumsum(2)[:, :, :-1]
    right = sums.sum(2, keepdims=True) - left
    (whole, weight), (li, lw), (ri, rw) = _gini(sums.sum(2)), _gini(left), _gini(right)
    weight = np.where(weight > 0, weight, 1)[:, None]
    gain = np.where((lw > 0) & (rw > 0), whole[:, None] - lw / weight * li - rw / weight * ri, -1.0)
    at = gain.argmax(1)
    rows = np.arange(len(sums))
    return gain[rows, at], at, left[rows, :, at], right[rows, :, at]


def _splits(rows: DataFrame, label: str, features: str, shape: dict, seed: int, trees: int, nodes: list[dict]) -> None:
    """One pass: gives each open node that has a split of positive gain its best one, among its own features."""
    cuts, classes, n, width = [c["at"] for c in shape["cuts"]], shape["classes"], len(shape["cuts"]), _width(shape["fine"])
    sizes = [len(c) + 1 for c in cuts]
    bin_of = [np.searchsorted(c, np.arange(fine)).astype(np.uint8) for c, fine in zip(cuts, shape["fine"])]
    users = {f: [i for i, node in enumerate(nodes) if f in node["among"]] for f in range(n) if sizes[f] > 1}
    users = {f: at for f, at in users.items() if at}
    if not users:
        return
    of = np.array([node["tree"] for node in nodes])
    # step by step from the root: the feature that the way to a node asks, its threshold's number and the side taken
    way = [tuple(np.array(step) for step in zip(*steps)) for steps in zip(*[node["way"] for node in nodes])]

    def run(batches):
        sums = {f: np.zeros((len(at), classes, sizes[f])) for f, at in users.items()}
        for b in batches:
            for chunk, y, packed in zip(*(c.to_pylist() for c in b.columns)):
                x = np.stack([of_fine[v] for of_fine, v in zip(bin_of, np.frombuffer(packed, width).reshape(n, -1))])
                drawn = draws(seed, chunk, trees, x.shape[1])
                step = max(NODE_CELLS // len(nodes), 64)
                for lo in range(0, x.shape[1], step):
                    part = np.ascontiguousarray(x[:, lo:lo + step])
                    w = drawn[of, lo:lo + step]
                    for f, cut, left in way:
                        w *= (part[f] <= cut.astype(np.uint8)[:, None]) == left[:, None]
                    w = w.astype(np.float32)
                    for f, at in users.items():
                        hot = (part[f][:, None] == np.arange(sizes[f], dtype=np.uint8)).astype(np.float32)
                        sums[f][:, y] += w[at] @ hot                    # whole numbers below 2 ** 24: exact
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["f", "sums"])

    def best(key, table):
        f = key[0].as_py()
        total = sum(np.frombuffer(s.as_buffer(), np.float64) for s in table.column("sums")).reshape(len(users[f]), classes, sizes[f])
        gain, at, left, right = _best(total)
        return pa.table({"f": pa.array([f], pa.int32()), "gain": [gain.tobytes()], "at": [at.astype(np.int64).tobytes()],
                         "below": [np.ascontiguousarray(left).tobytes()], "above": [np.ascontiguousarray(right).tobytes()]})
    found = (rows.select("chunk", label, features).mapInArrow(run, "f int, sums binary").groupBy("f")
             .applyInArrow(best, "f int, gain binary, at binary, below binary, above binary").collect())       # a row a feature
    for r in sorted(found, key=lambda r: r["f"]):
        gain, at = np.frombuffer(r["gain"]), np.frombuffer(r["at"], np.int64)
        below, above = np.frombuffer(r["below"]).reshape(-1, classes), np.frombuffer(r["above"]).reshape(-1, classes)
        for k, i in enumerate(users[r["f"]]):
            nodes[i].setdefault("sums", below[k] + above[k])
            if gain[k] > nodes[i].get("gain", 0.0):
                nodes[i].update(feature=r["f"], cut=int(at[k]), gain=float(gain[k]), below=below[k], above=above[k])


def _importance(node: dict, out: np.ndarray) -> int | None:
    """Adds gain times weight of the splits below ``node`` to ``out``; the prediction of a leaf.  Leaves of one prediction are one leaf."""
    if "feature" not in node:
        return int(node["sums"].argmax()) if "sums" in node else 0
    left, right = (_importance(child, out) for child in node["children"])
    if left is not None and left == right:
        return left
    out[node["feature"]] += node["gain"] * node["sums"].sum()
    return None


class GrownTree:
    def __init__(self, root: dict, n: int):
        self.root = root
        out = np.zeros(n)
        _importance(root, out)
        self.featureImportances = DenseVector(out / out.sum() if out.sum() > 0 else out)


class GrownForest:
    """What F13 reads of a fitted forest: ``trees`` with their ``featureImportances``."""

    def __init__(self, trees: list[GrownTree]):
        self.trees = trees


class RandomForestClassifier(classification.RandomForestClassifier):
    """Spark's forest; over ``Binned`` rows, its trees are grown by one pass a level and no row is kept for a tree."""

    def _fit(self, df: DataFrame):
        features, label = self.getFeaturesCol(), self.getLabelCol()
        if not isinstance(df.schema[features].dataType, T.BinaryType):
            return super()._fit(df)
        if odd := [p.name for p in self.params if self.isSet(p) and p.name not in
                   ("featuresCol", "labelCol", "numTrees", "maxDepth", "seed", "featureSubsetStrategy")]:
            raise ValueError(f"not over binned rows: {', '.join(odd)}")
        shape, seed = df.schema[features].metadata, self.getSeed() % (1 << 64)
        n = len(shape["cuts"])
        most = n if self.getFeatureSubsetStrategy() == "all" else min(int(self.getFeatureSubsetStrategy()), n)

        def node(tree, place, way):
            among = np.random.default_rng([seed, tree, place]).choice(n, most, replace=False) if most < n else range(n)
            return {"tree": tree, "place": place, "way": way, "among": {int(f) for f in among}}
        roots = [node(t, 0, []) for t in range(self.getNumTrees())]
        growing = roots
        for _ in range(self.getMaxDepth()):
            if not growing:
                break
            _splits(df, label, features, shape, seed, len(roots), growing)
            after = []
            for g in growing:
                if "feature" in g:
                    g["children"] = [{**node(g["tree"], 2 * g["place"] + 1 + side, g["way"] + [(g["feature"], g["cut"], not side)]), "sums": s}
                                     for side, s in enumerate((g["below"], g["above"]))]
                    after += g["children"]
            growing = after
        return GrownForest([GrownTree(r, n) for r in roots])
