"""Mixing sources to target weights by systematic sampling.

Targets: the whole budget (by default all words) is shared among the sources
by weight; a source's target stops at ``max_copies`` times its size and the
excess is shared again by weight until no target is above its bound.  The
fixed point is ``min(max_copies * size, level * weight)`` for one ``level``.

Sampling: each document of a source is expected ``target / source size``
times.  Documents are ordered by (size, doc_id) inside their source, the
expected copies are prefix-summed, a random offset of the source in [0, 1) is
added, and a document is emitted once per integer boundary that its interval
crosses.  The size order spreads the picks over all sizes, so the words taken
differ from the target by about one longest document.

Scale: prefix sums need each row's rank in its source.  Documents are first
counted per (source, size); the rows of one (source, size) group are only
ranked among themselves.  A rank comes from range partitions sorted by
(source, size, doc_id) plus the counts of earlier partitions, so a source or a
size that holds a third of all rows spans many tasks.  Only ids, sources and
sizes are shuffled, never texts.

Defined cases: null text has size 0; a null source is one source of its own,
ordered last; null ids order first; repeated rows are separate documents;
sources of size 0 have target 0 and are emitted 0 times; empty tables give
empty mixes; other input columns are kept as they are.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.llm.textops import numbered, whole, words
from fraudlens.session import materialize

SEED = "mix-v1"
_P = "__mix_"                  # prefix of working columns, so that input columns keep their names


def n_words(text) -> Column:
    return F.size(words(whole(text))).cast("bigint")


def water_level(sources: DataFrame, budget_ratio: float = 1.0, max_copies: int = 3) -> DataFrame:
    """``sources`` (source, weight, source_size) with their ``target``.

    Each round caps the sources above their bound and computes the level of
    the others anew from two sums; a source once capped stays capped, and the
    rounds end when no further one is.  The driver sees one row a round."""
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    budget = int(total * budget_ratio)
    capped = F.lit(False)
    n_capped = -1
    while True:
        s = sources.agg(F.sum(F.when(capped, max_copies * F.col("source_size")).otherwise(0)),
                        F.sum(F.when(capped, 0).otherwise(F.col("weight"))),
                        F.sum(capped.cast("int"))).first()
        rest, weight, n = budget - (s[0] or 0), s[1] or 0, s[2] or 0
        level = F.lit(rest).cast("double") * F.col("weight") / F.lit(max(weight, 1)).cast("double")
        if n == n_capped or not weight:
            break
        n_capped = n
        # multiplied out, so that the comparison is exact
        capped = capped | (F.lit(rest) * F.col("weight") > F.lit(max_copies * weight) * F.col("source_size"))
    bound = (max_copies * F.col("source_size")).cast("double")
    return sources.withColumn("target", F.when(capped, bound).otherwise(F.least(level, bound)))


def default_weights(sources: DataFrame) -> DataFrame:
    """Weights 1, 2, 3, 1, ... of the sources by code point, null last.

    The table has one row for each source; their ranks come from range
    partitions, as for documents."""
    ranked = _ranked(sources.withColumn(f"{_P}one", F.lit(0)), f"{_P}one",
                     [F.col("source").isNull(), F.col("source").cast("binary")])
    return ranked.withColumn("weight", (F.col(f"{_P}rank") - 1) % 3 + 1).drop(f"{_P}rank", f"{_P}one")


def _ranked(df: DataFrame, key: str, order: list) -> DataFrame:
    """1-based rank of each row among the rows of its (non-null) key, by range partitions."""
    cols = [F.col(key), *order]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pid, local = f"{_P}pid", f"{_P}local"
    placed = materialize(df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
                         .withColumn(pid, F.spark_partition_id())
                         .withColumn(local, F.monotonically_increasing_id()
                                     - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)), "mix-order")
    per = placed.groupBy(pid, key).agg(F.count(F.lit(1)).alias(f"{_P}n"), F.min(local).alias(f"{_P}first"))
    # one row for each partition and key in it: at most partitions + keys rows
    w = Window.partitionBy(key).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    before = per.select(pid, key, f"{_P}first", F.coalesce(F.sum(f"{_P}n").over(w), F.lit(0)).alias(f"{_P}off"))
    return (placed.join(before, [pid, key])
            .withColumn(f"{_P}rank", F.col(f"{_P}off") + F.col(local) - F.col(f"{_P}first") + 1)
            .drop(pid, local, f"{_P}off", f"{_P}first"))


def offset(source: Column, seed: str = SEED) -> Column:
    """The random offset of a source: 32 bits of a digest, so reruns agree."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.concat(F.lit("s"), source), F.lit("null")))),
                           1, 8), 16, 10).cast("bigint")
    return h.cast("double") / F.lit(4294967296.0)


def source_table(sizes: DataFrame) -> DataFrame:
    """One row for each source with its size; partial sums come before the shuffle."""
    return sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))


def mix(docs: DataFrame, source: str = "source", text: str = "text", weights: DataFrame | None = None,
        seed: str = SEED, max_copies: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) and the columns ``carry`` per document.

    ``weights`` (source, weight) replaces the default weights; its sources
    must cover those of ``docs``."""
    sizes = materialize(docs.select("doc_id", F.col(source).cast("string").alias("source"),
                                    n_words(text).alias("size"), *carry), "mix-sizes")
    src = source_table(sizes)
    src = default_weights(src) if weights is None else src.join(
        weights, src["source"].eqNullSafe(weights["source"])).select(src["source"], "source_size", "weight")
    src = water_level(materialize(src.select("source", "source_size", "weight"), "mix-sources"), max_copies=max_copies)
    keyed = sizes.withColumn(f"{_P}key", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null")))
    ranked = _ranked(keyed, f"{_P}key", [F.col("size"), F.col("doc_id")])
    src = src.select(F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null")).alias(f"{_P}key"),
                     "source_size", "target")
    e = F.col("target") / F.col("source_size").cast("double")
    u = offset(F.col("source"), seed)
    upto = F.floor(e * F.col(f"{_P}rank").cast("double") + u)
    before = F.floor(e * (F.col(f"{_P}rank") - 1).cast("double") + u)
    return ranked.join(src, f"{_P}key").select(
        "doc_id", "source", "size", "source_size", "target",
        F.when(F.col("source_size") > 0, F.least((upto - before).cast("bigint"), F.lit(max_copies).cast("bigint")))
        .otherwise(F.lit(0).cast("bigint")).alias("copies"), *carry)


def take(docs: DataFrame, source: str = "source", text: str = "text", **kw) -> DataFrame:
    """The rows of ``docs``, each as often as the mix emits it."""
    row, copies = f"{_P}row", f"{_P}copies"
    rows = numbered(docs, row)
    picks = mix(rows, source, text, carry=(row,), **kw).where("copies > 0").select(row, F.col("copies").cast("int").alias(copies))
    return rows.join(materialize(picks, "mix-picks"), row).withColumn(
        f"{_P}copy", F.explode(F.array_repeat(F.lit(1), F.col(copies)))).select(docs.columns)


def mixing_digest(docs: DataFrame) -> DataFrame:
    """The columns of the registered query, per document."""
    m = mix(docs)
    return m.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


MIXING_SQL = r"""
WITH t AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM t GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY source_size::DOUBLE / weight, source) AS k FROM w),
c AS (SELECT *, coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS cap,
             sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS ws,
             sum(source_size) OVER ()::BIGINT AS total FROM o),
f AS (SELECT cap, ws, total, k FROM c WHERE (total - cap) * weight <= 3 * ws * source_size ORDER BY k LIMIT 1),
g AS (SELECT o.source, o.source_size,
             CASE WHEN o.k < f.k THEN (3 * o.source_size)::DOUBLE
                  ELSE (f.total - f.cap)::DOUBLE * o.weight / f.ws::DOUBLE END AS target,
             ('0x' || substr(md5('mix-v1:' || coalesce('s' || o.source, 'null')), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS u
      FROM o, f),
r AS (SELECT t.doc_id, t.size, g.source_size, g.target, g.u, g.target / g.source_size::DOUBLE AS e,
             row_number() OVER (PARTITION BY t.source ORDER BY t.size, t.doc_id) AS p
      FROM t JOIN g ON t.source IS NOT DISTINCT FROM g.source),
x AS (SELECT *, CASE WHEN source_size > 0 THEN (floor(e * p::DOUBLE + u) - floor(e * (p - 1)::DOUBLE + u))::BIGINT
                     ELSE 0 END AS copies FROM r)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM x
"""
