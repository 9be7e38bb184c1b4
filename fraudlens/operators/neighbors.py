"""Exact k nearest neighbours of many rows (behind F2, M8 and the L8 re-samplers).

Donors are dealt to the cells of a k-d tree, cut along the widest column at the medians of a bounded sample; a cell of
more than ``BLOCK_ROWS`` rows is dealt by hash to parts, so no block is large whatever the data.  A query first visits
the cell whose box is nearest; the k-th distance found there bounds what it still has to look at: the tree is walked
from its root and every box farther than the bound is left out, so choosing cells costs the depth of the tree and not
the number of cells.  The cells left are visited in a second round, with that bound.  Inside a block the donors form
such a tree again, with leaves of a few rows, so a visit does not compare a query with the whole block.  Each visit
returns k rows at most; no pair of rows is ever written.

Equal donors beyond the k + 1 of least id cannot be among anyone's neighbours and are dropped before the search, and
equal queries are searched once: a vector that a third of the rows share costs one search and k + 1 donors.

Missing values: coordinates missing on either side are skipped and the rest scaled up (the squared distance times
the number of columns over the number of common ones).  That is a Euclidean distance for each pattern
of common columns, so each (donor pattern, common columns) is a space of its own, with its own tree, and donors that are
equal in the common columns are equal there.

Distances are sums in column order; ties are ordered by donor id.  The driver holds the trees: a few hundred bytes for each
``BLOCK_ROWS`` / 4 rows or more, of at most ``SAMPLE_ROWS`` sampled rows, and at most ``MAX_SPACES`` spaces (more raise).
"""
from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.session import materialize

BLOCK_ROWS, QUERY_ROWS = 32768, 16384     # donors and queries that meet in one block
LEAF_ROWS = 32                            # donors of a leaf of the tree inside a block
CELL_SAMPLE, SAMPLE_ROWS = 16, 1 << 18    # sampled donors of a cell, and of all cells
MAX_SPACES = 256
_VISIT = "space int, cell int, part int, v bigint, x array<double>, bound double"
_TABLE = "space int, cell int, id bigint, x array<double>, y double"


def _vector(cols: list[str]):
    return F.array(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols])


def _pattern(x: str = "x"):
    """Bit i is set where component i is present."""
    bits = F.transform(x, lambda v, i: F.when(v.isNull(), F.lit(0).cast("bigint")).otherwise(F.pow(F.lit(2.0), i).cast("bigint")))
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, b: a + b)


def vectors(df: DataFrame, id_col: str, cols: list[str], y: str | None = None) -> DataFrame:
    """(id, x, y, have): NaN counts as missing."""
    if len(cols) > 52:
        raise ValueError("at most 52 columns")
    out = df.select(F.col(id_col).cast("bigint").alias("id"), _vector(cols).alias("x"),
                    (F.col(y).cast("double") if y else F.lit(None).cast("double")).alias("y"))
    return out.withColumn("have", _pattern())


def _matrix(column, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, np.float64).reshape(-1, width)


class KdTree:
    """A k-d tree over points: nodes as arrays, children after their parents, boxes around what they hold.

    ``order`` lists the points leaf by leaf; a node holds ``count`` of them from ``start`` on.  ``leaf`` numbers the
    leaves, and is -1 elsewhere."""

    def __init__(self, dim, cut, left, right, leaf, start, count, lo, hi, order=None):
        self.dim, self.cut, self.left, self.right, self.leaf = dim, cut, left, right, leaf
        self.start, self.count, self.lo, self.hi, self.order = start, count, lo, hi, order

    @classmethod
    def over(cls, x: np.ndarray, rows: int) -> KdTree:
        """Cut at medians until a leaf has ``rows`` points at most, or equal points alone."""
        width = x.shape[1]
        order, todo, nodes, lows, highs = np.arange(len(x)), [(0, len(x), -1, 0)], [], [], []
        leaves = 0
        while todo:
            start, end, parent, side = todo.pop()
            me = len(nodes)
            if parent >= 0:
                nodes[parent][2 + side] = me
            some = order[start:end]
            pts = x[some]
            lo = pts.min(0) if len(pts) else np.full(width, np.inf)
            hi = pts.max(0) if len(pts) else np.full(width, -np.inf)
            lows.append(lo)
            highs.append(hi)
            dim = int((hi - lo).argmax()) if width and end - start > rows else -1
            if dim >= 0 and hi[dim] > lo[dim]:
                v = pts[:, dim]
                cut = np.partition(v, len(v) // 2)[len(v) // 2]
                if cut == lo[dim]:                         # the lower half is one value
                    cut = v[v > cut].min()
                below = v < cut
                order[start:end] = np.concatenate([some[below], some[~below]])
                at = start + int(below.sum())
                nodes.append([dim, cut, -1, -1, -1, start, end - start])
                todo += [(at, end, me, 1), (start, at, me, 0)]
            else:
                nodes.append([-1, 0.0, -1, -1, leaves, start, end - start])
                leaves += 1
        n = np.array(nodes, np.float64)
        whole = [n[:, i].astype(np.int64) for i in (0, 2, 3, 4, 5, 6)]
        return cls(whole[0], n[:, 1], *whole[1:], np.array(lows), np.array(highs), order)

    def cells(self, x: np.ndarray) -> np.ndarray:
        """The leaf in which each point lies by the cuts."""
        node = np.zeros(len(x), np.int64)
        while len(todo := np.flatnonzero(self.left[node] >= 0)):
            at = node[todo]
            node[todo] = np.where(x[todo, self.dim[at]] < self.cut[at], self.left[at], self.right[at])
        return self.leaf[node]

    def filled(self, count: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> KdTree:
        """The same cuts with the counts and boxes of other points, given by leaf."""
        n = len(self.leaf)
        at = np.flatnonzero(self.leaf >= 0)
        counts, low, high = np.zeros(n, np.int64), np.full((n, lo.shape[1]), np.inf), np.full((n, lo.shape[1]), -np.inf)
        counts[at], low[at], high[at] = count[self.leaf[at]], lo[self.leaf[at]], hi[self.leaf[at]]
        for i in np.flatnonzero(self.left >= 0)[::-1]:
            two = [self.left[i], self.right[i]]
            counts[i], low[i], high[i] = counts[two].sum(), low[two].min(0), high[two].max(0)
        return KdTree(self.dim, self.cut, self.left, self.right, self.leaf, self.start, counts, low, high)

    def _gaps(self, x: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Squared distances to boxes, added up in column order: never above that to a point in the box."""
        out = np.zeros(len(x))
        for j in range(x.shape[1]):
            v = x[:, j]
            gap = np.maximum(0, np.maximum(self.lo[node, j] - v, v - self.hi[node, j]))
            out += gap * gap
        return out

    def home(self, x: np.ndarray, least: int) -> np.ndarray:
        """The node of ``least`` points or more that a walk to the nearer box ends in."""
        node = np.zeros(len(x), np.int64)
        todo = np.arange(len(x))
        while len(todo := todo[self.left[node[todo]] >= 0]):
            two = [self.left[node[todo]], self.right[node[todo]]]
            far = [np.where(self.count[c] >= least, self._gaps(x[todo], c), np.inf) for c in two]
            some = np.isfinite(np.minimum(*far))
            node[todo[some]] = np.where(far[0] <= far[1], *two)[some]
            todo = todo[some]
        return node

    def reach(self, x: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) of all leaves whose box is within the squared distance ``bound``."""
        q, node, out = np.arange(len(x)), np.zeros(len(x), np.int64), []
        while len(q):
            gap = self._gaps(x[q], node)
            near = (gap <= bound[q]) & np.isfinite(gap)
            q, node = q[near], node[near]
            end = self.leaf[node] >= 0
            out.append((q[end], self.leaf[node[end]]))
            q, node = q[~end], node[~end]
            q, node = np.concatenate([q, q]), np.concatenate([self.left[node], self.right[node]])
        return tuple(np.concatenate([o[i] for o in out] or [np.zeros(0, np.int64)]) for i in (0, 1))

    def state(self) -> dict:
        return {k: getattr(self, k).tolist() for k in ("dim", "cut", "left", "right", "leaf", "start", "count", "lo", "hi")}

    @classmethod
    def from_state(cls, s: dict) -> KdTree:
        kind = dict.fromkeys(("cut", "lo", "hi"), np.float64)
        return cls(**{k: np.array(v, kind.get(k, np.int64)).reshape(len(s["dim"]), *([-1] if k in ("lo", "hi") else [])) for k, v in s.items()})


def best(queries: np.ndarray, donors: np.ndarray, k: int, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, donor, squared distance) of the ``k`` nearest donors of each query, or those within ``bound``, by distance and
    place among the donors.  Distances are summed in column order."""
    tree = KdTree.over(donors, max(LEAF_ROWS, 4 * k))
    at = np.flatnonzero(tree.leaf >= 0)
    at = at[np.argsort(tree.leaf[at])]
    wide = int(tree.count[at].max())
    slot = tree.start[at][:, None] + np.arange(wide)
    held = np.arange(wide) < tree.count[at][:, None]
    member = tree.order[np.minimum(slot, len(donors) - 1)]
    points = [np.where(held, donors[member, j], np.inf) for j in range(donors.shape[1])]
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]

    def squares(x, cols):
        d2 = np.zeros(cols[0].shape)
        for j, c in enumerate(cols):
            d = x[:, j, None] - c
            d2 += d * d
        return d2
    for begin in range(0, len(queries), 2048):
        x, limit = queries[begin:begin + 2048], bound[begin:begin + 2048].copy()
        open_ = np.flatnonzero(np.isinf(limit))
        if len(open_) and len(donors) >= k:
            node = tree.home(x[open_], k)
            some = tree.start[node][:, None] + np.arange(min(wide, len(donors)))
            here = tree.order[np.minimum(some, len(donors) - 1)]
            d2 = squares(x[open_], [donors[here, j] for j in range(donors.shape[1])])
            d2[some >= (tree.start + tree.count)[node][:, None]] = np.inf
            limit[open_] = np.partition(d2, k - 1, axis=1)[:, k - 1] if d2.shape[1] >= k else np.inf
        q, leaf = tree.reach(x, limit)
        found = []
        for i in range(0, len(q), 1 << 14):
            qi, li = q[i:i + (1 << 14)], leaf[i:i + (1 << 14)]
            d2 = squares(x[qi], [p[li] for p in points])
            r, c = np.nonzero((d2 <= limit[qi][:, None]) & held[li])
            found.append((qi[r], member[li[r], c], d2[r, c]))
        if not found:
            continue
        q, donor, d2 = (np.concatenate(f) for f in zip(*found))
        order = np.lexsort((donor, d2, q))
        q, donor, d2 = q[order], donor[order], d2[order]
        keep = np.arange(len(q)) - np.searchsorted(q, q, "left") < k
        out.append((q[keep] + begin, donor[keep], d2[keep]))
    return tuple(np.concatenate(o) for o in zip(*out))


def _columns(common: int, width: int) -> list[int]:
    return [j for j in range(width) if common >> j & 1]


class NeighborIndex:
    """Donors in blocks (a written table) with the trees by which queries choose blocks."""

    def __init__(self, table: DataFrame, cols: list[str], k: int, spaces: list[tuple[int, int]], trees: list[KdTree], blocks: np.ndarray):
        self.table, self.cols, self.k, self.spaces, self.trees, self.blocks = table, cols, k, spaces, trees, blocks

    # -------------------------------------------------------------- building
    @classmethod
    def build(cls, donors: DataFrame, cols: list[str], k: int, asked: list[int] | None = None, fill: bool = False) -> NeighborIndex:
        """``donors``: ``vectors(...)`` rows.  ``asked``: patterns of the queries (default: complete rows).
        ``fill``: only donors that have a column which the asked pattern lacks are of use."""
        width = len(cols)
        asked = sorted(set(asked if asked is not None else [(1 << width) - 1]))
        w = Window.partitionBy("x").orderBy("id")
        rows = materialize(donors.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1).drop("r"), "donors")
        have = [r[0] for r in rows.select("have").distinct().limit(MAX_SPACES + 1).collect()]
        spaces = sorted({(d, d & a) for d in have for a in asked if d & a and (not fill or d & ~a)})
        if len(spaces) > MAX_SPACES:
            raise ValueError(f"more than {MAX_SPACES} patterns of missing values")
        half = BLOCK_ROWS / 2
        share = min(1.0, CELL_SAMPLE / half, SAMPLE_ROWS / max(1, rows.count()))
        picked = F.pmod(F.xxhash64("id", "x"), F.lit(1 << 30)) < int(np.ceil(share * (1 << 30)))
        sample = rows.where(picked).select("have", "x").collect()          # bounded: see above
        points, pattern = np.array([r[1] for r in sample], np.float64).reshape(-1, width), np.array([r[0] for r in sample], np.int64)
        order = np.lexsort((*points.T, pattern))                           # the same cuts in any order of rows
        points, pattern = points[order], pattern[order]
        trees = [KdTree.over(points[pattern == d][:, _columns(c, width)], max(CELL_SAMPLE, int(share * half))) for d, c in spaces]
        table = rows.mapInArrow(_assign(trees, spaces, width), _TABLE)
        if any(d != c for d, c in spaces):
            # equal in the common columns is equal in the space
            cut = [i for i, (d, c) in enumerate(spaces) if d != c]
            common = F.element_at(F.create_map(*[x for i in cut for x in (F.lit(i), F.lit(spaces[i][1]).cast("bigint"))]), F.col("space"))
            seen = table.where(F.col("space").isin(cut)).withColumn("common", common).withColumn(
                "p", F.transform("x", lambda v, i: F.when(F.getbit("common", i) == 1, v)))
            seen = seen.withColumn("r", F.row_number().over(Window.partitionBy("space", "p").orderBy("id"))).where(F.col("r") <= k + 1)
            table = table.where(~F.col("space").isin(cut)).union(seen.select(*table.columns))
        table = materialize(table, "cells")
        # boxes of the rows that are there, not of the cuts
        ends = [f(F.get("x", F.lit(j))) for j in range(width) for f in (F.min, F.max)]
        cell = np.array([[np.nan if v is None else v for v in r] for r in table.groupBy("space", "cell").agg(
            F.count(F.lit(1)), *ends).collect()], np.float64).reshape(-1, 3 + 2 * width)
        for s, (_, c) in enumerate(spaces):
            mine, on = cell[cell[:, 0] == s], _columns(c, width)
            leaves = int(trees[s].leaf.max()) + 1
            count, lo, hi = np.zeros(leaves, np.int64), np.full((leaves, len(on)), np.inf), np.full((leaves, len(on)), -np.inf)
            at = mine[:, 1].astype(int)
            count[at], lo[at], hi[at] = mine[:, 2], mine[:, [3 + 2 * j for j in on]], mine[:, [4 + 2 * j for j in on]]
            trees[s] = trees[s].filled(count, lo, hi)
        blocks = np.column_stack([cell[:, :2], np.zeros(len(cell)), np.ceil(cell[:, 2] / BLOCK_ROWS), cell[:, 2]])
        blocks = blocks[np.lexsort(blocks[:, 1::-1].T)]
        parts = [[int(s), int(c), int(p)] for s, c, _, p, _ in blocks if p > 1]
        if parts:
            large = table.sparkSession.createDataFrame(parts, "space int, cell int, parts int")
            table = table.join(F.broadcast(large), ["space", "cell"], "left")
            table = table.withColumn("part", F.coalesce(F.pmod(F.xxhash64("id"), F.col("parts")), F.lit(0)).cast("int")).drop("parts")
        else:
            table = table.withColumn("part", F.lit(0))
        return cls(table, cols, k, spaces, trees, blocks)

    def save(self, path: str) -> None:
        """The donor table and the bounded rest, as Parquet in one folder."""
        self.table.write.mode("overwrite").parquet(f"{path}/donors")
        spark = self.table.sparkSession
        meta = json.dumps({"cols": self.cols, "k": self.k, "spaces": self.spaces, "trees": [t.state() for t in self.trees],
                           "blocks": self.blocks.tolist()})
        spark.createDataFrame([(meta,)], "meta string").write.mode("overwrite").parquet(f"{path}/index")

    @classmethod
    def load(cls, spark, path: str) -> NeighborIndex:
        m = json.loads(spark.read.parquet(f"{path}/index").first()[0])
        return cls(spark.read.parquet(f"{path}/donors"), m["cols"], m["k"], [tuple(s) for s in m["spaces"]],
                   [KdTree.from_state(t) for t in m["trees"]], np.array(m["blocks"], np.float64).reshape(-1, 5))

    # -------------------------------------------------------------- searching
    def search(self, queries: DataFrame, exclude_self: bool = False, fill: bool = False, nx: bool = True) -> DataFrame:
        """(q, space, id, d2, nx, y, rank): for each query row (id, x, have) and space its ``k`` nearest donors.

        ``d2`` is the scaled squared distance, ``rank`` counts from 1.  ``exclude_self``: not the donor of the same id.
        Without ``nx`` the vectors of the donors are left out."""
        distinct, found = self._found(queries, fill, nx)
        both = queries.select(F.col("id").alias("q"), "x").join(distinct.select("v", "x"), "x").select("q", "v").join(found, "v").drop("v")
        # rows that repeat an id share one list
        twice = materialize(queries.groupBy(F.col("id").alias("q")).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("q"), "repeated")
        if not twice.isEmpty():
            again = F.col("q").eqNullSafe(F.col("t"))
            twice = twice.withColumnRenamed("q", "t")
            more = both.join(twice, again, "left_semi").groupBy("q", "space").agg(F.array_sort(F.flatten(F.collect_list("near"))).alias("near"))
            both = both.join(twice, again, "left_anti").unionByName(more)
        if exclude_self:
            both = both.withColumn("near", F.filter("near", lambda n: n["id"] != F.col("q")))
        both = both.select("q", "space", F.posexplode(F.slice("near", 1, self.k)).alias("rank", "n"))
        return both.select("q", "space", "n.id", "n.d2", *(["n.nx"] if nx else []), "n.y", (F.col("rank") + 1).alias("rank"))

    def _found(self, queries: DataFrame, fill: bool, nx: bool) -> tuple[DataFrame, DataFrame]:
        # null components must meet in joins: equal arrays with equal nulls are equal
        distinct = queries.select("x", "have").distinct().withColumn("v", F.monotonically_increasing_id())
        distinct = materialize(distinct, "distinct-queries")
        near = self._visit(materialize(distinct.withColumn("bound", F.lit(None).cast("map<int,double>")).mapInArrow(
            self._choose(False, fill), _VISIT), "first-visits"), nx)
        # k + 1 rows: one of them may be the query itself
        bound = near.groupBy("v", "space").agg(F.flatten(F.collect_list("near.d2")).alias("d2")).where(F.size("d2") > self.k)
        bound = bound.select("v", "space", F.get(F.array_sort("d2"), F.lit(self.k)).alias("far"))
        bound = bound.groupBy("v").agg(F.map_from_entries(F.collect_list(F.struct("space", "far"))).alias("bound"))
        rest = distinct.join(bound, "v", "left").select("x", "have", "v", "bound").mapInArrow(self._choose(True, fill), _VISIT)
        self.visits = materialize(rest, "visits")
        every = near.union(self._visit(self.visits, nx))
        found = every.groupBy("v", "space").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, self.k + 1).alias("near"))
        if any(c != (1 << len(self.cols)) - 1 for _, c in self.spaces):
            scale = F.element_at(F.create_map(*[x for i, (_, c) in enumerate(self.spaces) for x in (F.lit(i), F.lit(float(bin(c).count("1"))))]),
                                 F.col("space"))
            # complete rows keep their exact sum
            scaled = F.transform("near", lambda n: n.withField("d2", n["d2"] * float(len(self.cols)) / scale))
            found = found.withColumn("near", F.when(scale == len(self.cols), F.col("near")).otherwise(F.array_sort(scaled)))
        return distinct, materialize(found, "found")

    def _choose(self, second: bool, fill: bool):
        """Blocks that queries visit: first the cell they lie in, then all others that may hold a nearer row."""
        trees, spaces, blocks, k, width = self.trees, self.spaces, self.blocks, self.k, len(self.cols)

        def run(batches):
            large = {(int(s), int(c)): (int(p), int(n)) for s, c, _, p, n in blocks if p > 1}
            for b in batches:
                x, have = _matrix(b.column(0), width), np.asarray(b.column(1), np.int64)
                v, bounds = np.asarray(b.column(2), np.int64), b.column(3).to_pylist() if second else None
                out = [np.zeros((0, 4), np.int64)]
                rows, limits = [np.zeros(0, np.int64)], [np.zeros(0)]
                for s, (donor, common) in enumerate(spaces):
                    mine = np.flatnonzero(((have & donor) == common) & (((donor & ~have) > 0) | (not fill)))
                    tree = trees[s]
                    if not tree.count[0] or not len(mine):
                        continue
                    on = _columns(common, width)
                    pts = x[mine][:, on]
                    node = tree.home(pts, k + 1)
                    while len(todo := np.flatnonzero(tree.leaf[node] < 0)):
                        two = [tree.left[node[todo]], tree.right[node[todo]]]
                        node[todo] = np.where(tree.count[two[0]] >= tree.count[two[1]], *two)
                    home = tree.leaf[node]
                    limit = np.full(len(mine), np.inf)
                    if second:
                        limit = np.array([dict(bounds[i]).get(s, np.inf) if bounds[i] else np.inf for i in mine])
                        q, cell = tree.reach(pts, limit)
                    else:
                        q, cell = np.arange(len(mine)), home
                    q, cell, part = _parts(s, q, cell, home, v[mine], large, k, second)
                    out.append(np.column_stack([np.full(len(q), s), cell, part, v[mine][q]]))
                    rows.append(mine[q])
                    limits.append(limit[q])
                out, rows, limits = np.concatenate(out), np.concatenate(rows), np.concatenate(limits)
                cols = [pa.array(out[:, i].astype(np.int32)) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(out[:, 3]), b.column(0).take(pa.array(rows)), pa.array(limits)],
                                                 ["space", "cell", "part", "v", "x", "bound"])
        return run

    def _visit(self, visits: DataFrame, nx: bool) -> DataFrame:
        """(v, space, near): the best k + 1 donors of each visit; a block meets its queries in pieces."""
        k, spaces, width = self.k, self.spaces, len(self.cols)
        key = ["space", "cell", "part"]
        pieces = materialize(visits.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("pieces")), "asked-blocks")
        left = visits.join(pieces, key).select(*key, F.pmod(F.xxhash64("v"), F.col("pieces")).cast("int").alias("piece"), "v", "x", "bound")
        right = self.table.join(pieces.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))), key)
        right = right.select(*[F.col(c).alias(c) for c in (*key, "piece", "id", "x", "y")])
        fields = [pa.field("d2", pa.float64()), pa.field("id", pa.int64()), *([pa.field("nx", pa.list_(pa.float64()))] if nx else []),
                  pa.field("y", pa.float64())]
        kinds = [pa.int64(), pa.int32(), pa.list_(pa.struct(fields))]

        def run(group, queries: pa.Table, donors: pa.Table) -> pa.Table:
            if not len(queries) or not len(donors):
                return pa.table([pa.array([], t) for t in kinds], names=["v", "space", "near"])
            space = int(group[0].as_py())
            on = _columns(spaces[space][1], width)
            donors = donors.sort_by("id").combine_chunks()
            ids, dx = np.asarray(donors["id"], np.int64), _matrix(donors["x"], width)[:, on]
            row, col, d2 = best(_matrix(queries["x"], width)[:, on], dx, k + 1, np.asarray(queries["bound"], np.float64))
            sizes = np.bincount(row, minlength=len(queries))
            some = np.flatnonzero(sizes)
            take = pa.array(col)
            values = [pa.array(d2), pa.array(ids[col]), *([_chunk(donors["x"].take(take))] if nx else []), _chunk(donors["y"].take(take))]
            near = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes[some])].astype(np.int32)),
                                            pa.StructArray.from_arrays(values, fields=fields))
            return pa.table([_chunk(queries["v"].take(pa.array(some))), pa.array(np.full(len(some), space, np.int32)), near],
                            names=["v", "space", "near"])
        found = f"v bigint, space int, near array<struct<d2: double, id: bigint, {'nx: array<double>, ' if nx else ''}y: double>>"
        return materialize(left.groupBy(*key, "piece").cogroup(right.groupBy(*key, "piece")).applyInArrow(run, found), "near")


def _chunk(column):
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _assign(trees: list[KdTree], spaces: list[tuple[int, int]], width: int):
    def run(batches):
        for b in batches:
            x, have = _matrix(b.column(1), width), np.asarray(b.column(3), np.int64)
            for s, (donor, common) in enumerate(spaces):
                rows = np.flatnonzero(have == donor)
                if not len(rows):
                    continue
                cell = trees[s].cells(x[rows][:, _columns(common, width)])
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), s, np.int32)), pa.array(cell.astype(np.int32)), *[b.column(i).take(take) for i in range(3)]],
                    ["space", "cell", "id", "x", "y"])
    return run


def _parts(space: int, q, cell, home, v, large: dict, k: int, second: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, cell, part) to visit: in the first round the home cell, of a large one a single part if that gives a
    bound; in the second round all but those."""
    if not large:
        keep = cell != home[q] if second else np.ones(len(q), bool)
        return q[keep], cell[keep], np.zeros(int(keep.sum()), np.int64)
    many, rows = np.array([large.get((space, int(c)), (1, 0)) for c in cell], np.int64).reshape(-1, 2).T
    single = rows >= 8 * (k + 1) * many                       # rows is 0 for cells of one part
    part = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    q, cell, single, many = (np.repeat(a, many) for a in (q, cell, single, many))
    early = (cell == home[q]) & (~single | (many == 1) | (part == v[q] % many))
    keep = ~early if second else early
    return q[keep], cell[keep], part[keep]


def nearest(queries: DataFrame, donors: DataFrame, cols: list[str], k: int, id_col: str, y: str | None = None,
            exclude_self: bool = False, nx: bool = True) -> DataFrame:
    """(q, id, d2, nx, y, rank) of complete rows, without ``nx`` if not wanted; rows with a missing value take no part."""
    full = (1 << len(cols)) - 1
    complete = lambda df, label: vectors(df, id_col, cols, label).where(F.col("have") == full)
    index = NeighborIndex.build(complete(donors, y), cols, k)
    return index.search(complete(queries, None), exclude_self, nx=nx).drop("space")
