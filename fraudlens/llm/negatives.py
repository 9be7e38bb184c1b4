"""Hard-negative mining with Kronecker-packed inner products.

A component x becomes floor(256 * x); a row's score is the integer inner product with the anchor.  Anchors are the
rows whose id is divisible by ``every``.  An anchor's positives are its best ``n_positive`` other rows of its
label; for each positive the best ``n_negative`` rows of other labels are returned whose score lies between
``low`` and ``high`` percent of the positive's.  Higher scores come first, ties by smaller id.

Packing: anchors and candidates are biased until no component is negative.  The components of several candidates
are laid side by side in one 64-bit integer, in fields so wide that the largest possible product sum fits; one
multiplication by an anchor's component multiplies all of them, sums stay inside their fields, and the exact
scores are cut out and unbiased at the end.  Where not even one field fits, Python's integers are used.

Scale: candidates lie in blocks of ``BLOCK`` rows in order of (label, id); a label, an id or a vector that a third
of the rows share is many blocks.  A tile is one block against at most ``ANCHORS`` anchors: positives are sought
in the blocks that hold the anchor's label, negatives in all.  A tile returns its best rows for each anchor and
positive, so results merge by top-k; no pair of rows is ever written.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part; shorter
vectors count as padded with zeros; a row that repeats the anchor's id is not an "other" row; other repeated rows
are rows of their own, each repeated anchor mines for itself; an anchor without positives, or without
negatives in the range, has no rows; empty tables give none; other input columns are not used.  Scores must fit
64 bits.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.operators.prefix import with_global_position
from fraudlens.session import materialize

BLOCK, ANCHORS = 2048, 1024           # candidates and anchors of a tile
_SLICE = 64                           # anchors multiplied at a time


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: Column | None = None) -> DataFrame:
    """(id, label, v array<bigint>) of the rows that take part."""
    label = F.col("label") if label is None else label
    out = rows.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"),
                      F.col(vector).cast("array<double>").alias("v"))
    out = out.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
    return out.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))).withColumn(
        "v", F.transform("v", lambda x: F.floor(x * 256)))


def packed_scores(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products (m, n) of the integer rows of ``a`` (m, d) and ``c`` (n, d)."""
    (m, d), n = a.shape, len(c)
    if not (m and n and d):
        return np.zeros((m, n), np.int64)
    a_low, c_low = int(a.min()), int(c.min())
    wide = max(int(a.max()) - a_low, int(c.max()) - c_low) >= 2 ** 62
    up_a, up_c = (x.astype(object) - low if wide else x - low for x, low in ((a, a_low), (c, c_low)))
    most = max(sum(map(int, row)) for row in up_a)                 # the largest sum that a field has to hold
    bits = max(1, (most * int(up_c.max())).bit_length())
    fields = 64 // bits
    kind = np.uint64 if fields else object
    fields = fields or 4
    groups = -(-n // fields)
    padded = np.zeros((groups * fields, d), kind)
    padded[:n] = up_c
    padded = padded.reshape(groups, fields, d)
    packed = np.zeros((d, groups), kind)
    for k in range(fields):
        packed |= padded[:, k].T << kind(bits * k) if kind is not object else padded[:, k].T * (1 << (bits * k))
    left = up_a.astype(kind)
    wide_sums = np.zeros((m, groups), kind)
    for j in range(d):
        wide_sums += left[:, j, None] * packed[j]
    out = np.empty((m, groups, fields), kind)
    mask = kind((1 << bits) - 1) if kind is not object else (1 << bits) - 1
    for k in range(fields):
        out[:, :, k] = (wide_sums >> (kind(bits * k) if kind is not object else bits * k)) & mask
    out = out.reshape(m, groups * fields)[:, :n].astype(object if kind is object else np.int64)
    exact = object if kind is object else np.int64
    out = out + c_low * a.sum(1, dtype=exact)[:, None] + a_low * c.sum(1, dtype=exact)[None, :] - d * a_low * c_low
    return out.astype(np.int64)


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` highest allowed scores of each row, equal scores by lower column."""
    n = scores.shape[1]
    k = min(k, n)
    if not scores.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if np.abs(scores).max() < 2 ** 62 // n:
        key = np.where(allowed, scores * n - np.arange(n), np.iinfo(np.int64).min)
        at = np.argpartition(key, n - k, axis=1)[:, n - k:] if k < n else np.tile(np.arange(n), (len(key), 1))
    else:
        at = np.lexsort((np.tile(np.arange(n), (len(scores), 1)), -scores, ~allowed), axis=1)[:, :k]
    row, col = np.repeat(np.arange(len(at)), at.shape[1]), at.ravel()
    ok = allowed[row, col]
    return row[ok], col[ok]


def _matrix(column, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(column.value_lengths().fill_null(0), np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    flat = np.asarray(column.flatten(), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _tile(cands: pa.Table, anchors: pa.Table):
    """The candidates of a tile by id, and for each slice of anchors (first, ids, labels, scores)."""
    cands = cands.sort_by([("id", "ascending"), ("pos", "ascending")])
    width = max([int(x.max()) if len(x := np.asarray(t["v"].combine_chunks().value_lengths())) else 0 for t in (cands, anchors)])
    c, a = _matrix(cands["v"], width), _matrix(anchors["v"], width)
    ids, labels = (np.asarray(anchors[x]) for x in ("id", "label"))

    def slices():
        for at in range(0, len(a), _SLICE):
            some = slice(at, at + _SLICE)
            yield at, ids[some], labels[some], packed_scores(a[some], c)
    return cands, slices()


def _positives(n: int):
    def run(key, cands: pa.Table, anchors: pa.Table) -> pa.Table:
        cands, slices = _tile(cands, anchors)
        c_id, c_label, c_pos = (np.asarray(cands[x]) for x in ("id", "label", "pos"))
        a_pos, out = np.asarray(anchors["pos"]), [np.zeros((0, 4), np.int64)]
        for at, ids, labels, s in slices:
            row, col = best(s, (labels[:, None] == c_label) & (ids[:, None] != c_id), n)
            out.append(np.column_stack([a_pos[at + row], c_pos[col], c_id[col], s[row, col]]))
        return pa.table(list(np.concatenate(out).T), names=["pos", "p_pos", "p_id", "p_score"])
    return run


def _negatives(n: int, low: int, high: int):
    names = ["pos", "p_pos", "p_id", "p_score", "n_pos", "n_id", "n_score"]

    def run(key, cands: pa.Table, anchors: pa.Table) -> pa.Table:
        cands, slices = _tile(cands, anchors)
        c_id, c_label, c_pos = (np.asarray(cands[x]) for x in ("id", "label", "pos"))
        a_pos, out = np.asarray(anchors["pos"]), [np.zeros((0, len(names)), np.int64)]
        found = anchors["found"].to_pylist()
        for at, ids, labels, s in slices:
            other = labels[:, None] != c_label
            for p in range(max(len(x) for x in found[at:at + len(ids)])):
                mine = [x[p] if p < len(x) else None for x in found[at:at + len(ids)]]
                score = np.array([x["p_score"] if x else 0 for x in mine], np.int64)
                # the smallest and the largest whole score in range, exact for any size
                least = np.array([-(-low * int(x) // 100) for x in score], np.int64)[:, None]
                most = np.array([high * int(x) // 100 for x in score], np.int64)[:, None]
                has = np.array([x is not None for x in mine])[:, None]
                row, col = best(s, other & has & (s >= least) & (s <= most), n)
                pos, pid = (np.array([x[f] if x else 0 for x in mine], np.int64) for f in ("p_pos", "p_id"))
                out.append(np.column_stack([a_pos[at + row], pos[row], pid[row], score[row], c_pos[col], c_id[col], s[row, col]]))
        return pa.table(list(np.concatenate(out).T), names=names)
    return run


def _top(rows: DataFrame, by: list[str], score: str, ids: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.col(score).desc(), *ids)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, every: int = 100, n_positive: int = 5, n_negative: int = 10, low: int = 30,
                   high: int = 90, block: int = BLOCK, anchors_per_tile: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over ``integer_vectors``."""
    placed = with_global_position(vectors, ["label", "id", F.hash("v")], "pos")
    placed = materialize(placed.withColumn("block", F.floor(F.col("pos") / block)), "vectors")
    # new column identities, so that both sides of a tile may come from one table
    asked = placed.where(F.col("id") % every == 0).select(*[F.col(c).alias(c) for c in placed.columns])
    n_rows, n_asked = placed.agg(F.count(F.lit(1)), F.count(F.when(F.col("id") % every == 0, 1))).first()
    n_blocks, n_parts = max(1, -(-n_rows // block)), max(1, -(-n_asked // anchors_per_tile))
    part = F.pmod(F.xxhash64("pos"), F.lit(n_parts)).alias("part")
    to_parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_parts - 1).cast("bigint"))).alias("part")
    cands = placed.select("pos", "id", "label", "v", "block", to_parts)

    where = placed.select("label", "block").distinct()                    # a row for each block and label in it
    near = asked.drop("block").join(where, "label").select("pos", "id", "label", "v", "block", part)
    found = cands.groupBy("block", "part").cogroup(near.groupBy("block", "part")).applyInArrow(
        _positives(n_positive), "pos bigint, p_pos bigint, p_id bigint, p_score bigint")
    found = _top(found, ["pos"], "p_score", ["p_id", "p_pos"], n_positive)
    found = found.groupBy("pos").agg(F.array_sort(F.collect_list(F.struct("p_pos", "p_id", "p_score"))).alias("found"))
    found = materialize(asked.drop("block").join(found, "pos"), "positives")     # at most n_positive for each anchor

    to_blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint"))).alias("block")
    against = found.select("pos", "id", "label", "v", "found", part, to_blocks)
    mined = cands.groupBy("block", "part").cogroup(against.groupBy("block", "part")).applyInArrow(
        _negatives(n_negative, low, high),
        "pos bigint, p_pos bigint, p_id bigint, p_score bigint, n_pos bigint, n_id bigint, n_score bigint")
    mined = _top(mined, ["pos", "p_pos"], "n_score", ["n_id", "n_pos"], n_negative)
    return mined.join(found.select("pos", F.col("id").alias("anchor_id")), "pos").select(
        "anchor_id", F.col("p_id").alias("positive_id"), "rank", F.col("n_id").alias("negative_id"),
        F.col("p_score").alias("positive_score"), F.col("n_score").alias("negative_score"))


def negatives_digest(embeddings: DataFrame) -> DataFrame:
    """The registered query: labels of ids divisible by 7 are shifted first, as its contract fixes it."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(integer_vectors(embeddings, label=label))


NEGATIVES_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INT AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
