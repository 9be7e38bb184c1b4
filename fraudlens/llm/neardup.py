"""Near-duplicate documents: SuperMinHash, banding, verification, union-find.

1. A text becomes its set of distinct k-word shingles, as 64-bit hashes.
   Documents with equal sets form one class, represented by their least id;
   copies are counted away before anything else and never paired.
2. SuperMinHash gives each set ``bands * rows`` components.  An element's
   component values grow with its step, so a set stops as soon as no later
   step can lower any component: after two or three steps where it has more
   elements than components.  Each band of ``rows`` components is hashed;
   classes that share a band hash meet in a bucket.  Two sets of Jaccard 0.8
   share none of 32 bands of 6 with probability 6e-5, of 0.9 with 1e-11.
3. No pairs of a bucket are emitted.  In turns, each class that shares a
   bucket with other components is compared, on the full sets, with one centre:
   the least component of its buckets.  Links join components, until a turn
   finds no link.  What is then left of a bucket is one component with most
   members and others.  The others are compared with the whole
   component and with each other in blocks of bounded size inside tasks; a
   block yields at most one link for each class.  Jaccard distance is a metric,
   so of a component only those members are read whose distance to its least
   member differs by at most 1 - threshold from the other's: for a chance
   meeting that is none.  Every pair of a bucket is thus compared, already in
   one component, or ruled out.
4. Links join components by union-find on the whole link table.

Only links between classes are built, by shuffled tables in the shared checkpoint folder;
joins are between written tables, so that Spark can split hot keys at run time.

Defined cases: null, empty and wordless texts have the empty set and are linked
with nothing; fewer words than k are one shingle; rows that repeat an id are
one node, linked by any of their texts; rows without an id are
linked with nothing and stay; empty tables give no rows.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.llm.components import components
from fraudlens.llm.textops import let, lower_ascii, numbered, whole, words
from fraudlens.session import materialize

BANDS, ROWS = 32, 6
PERCENT = 80                       # of 100: the least Jaccard similarity of a link
BLOCK, SHELL = 256, 0.05           # classes of a side of a block; width of a distance shell
_BATCH = 1 << 17                   # elements whose permutations are held at a time


def shingle_set(text, k: int) -> Column:
    """Distinct 64-bit hashes of the k-word shingles of a text, A-Z in lower case."""
    def of(w):
        n = F.size(w)
        each = F.transform(F.slice(w, 1, F.greatest(n - (k - 1), F.lit(0))),
                           lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, k)]))
        return (F.when(n >= k, F.array_distinct(each)).when(n > 0, F.array(F.xxhash64(F.lit("short"), F.array_join(w, " "))))
                .otherwise(F.array().cast("array<bigint>")))
    return let(words(lower_ascii(whole(text))), of)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix); constants are fixed by its definition."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def superminhash(elements: np.ndarray, ends: np.ndarray, m: int) -> np.ndarray:
    """(sets, m) components of sets of 64-bit elements that lie between ``ends``.

    Step j of an element draws a rank r in [0, 1) and the j-th entry p of the
    element's own random permutation, and lowers component p to j + r."""
    n_sets = len(ends) - 1
    h = np.full(n_sets * m, np.inf)
    owner = np.repeat(np.arange(n_sets), np.diff(ends))
    x = elements.astype(np.uint64)
    perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(x), 1))
    row = np.arange(len(x))
    for j in range(m):
        draw = _mix(x + np.uint64(((j + 1) * 0x9E3779B97F4A7C15) & (2 ** 64 - 1)))
        r = (draw >> np.uint64(24)).astype(np.float64) / float(1 << 40)
        k = j + ((draw & np.uint64(0xFFFFFF)) * np.uint64(m - j) >> np.uint64(24)).astype(np.int64)
        p = perm[row, k]
        perm[row, k] = perm[row, j]
        np.minimum.at(h, owner * m + p, r + j)
        open_ = h.reshape(n_sets, m).max(1) > j + 1      # a later step can still lower a component
        go = open_[owner]
        if not go.any():
            break
        if not go.all():
            x, owner, row = x[go], owner[go], row[go]
    return h.reshape(n_sets, m)


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    v = sig.view(np.uint64).reshape(len(sig), bands, rows)
    acc = np.broadcast_to(_mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(sig), bands)).copy()
    for i in range(rows):
        acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + v[:, :, i])
    return acc.view(np.int64)


def signed_sets(docs: DataFrame, text: str, k: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n, k1, k2, bands array<bigint>): set size, a 128-bit key of the set, band hashes (empty for empty sets)."""
    s = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), shingle_set(text, k).alias("s"))
    s = s.select("doc_id", F.size("s").cast("bigint").alias("n"), F.sort_array("s").alias("s"))
    s = s.select("doc_id", "n", F.xxhash64("s").alias("k1"), F.xxhash64(F.lit(1), "s").alias("k2"), "s")
    schema = T.StructType([*s.schema.fields[:4], T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches):
        for b in batches:
            sets = b.column(4)
            ends = sets.offsets.to_numpy().astype(np.int64)
            ends = ends - ends[0]
            flat = sets.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            out = np.zeros((len(ends) - 1, bands), np.int64)
            at = 0
            while at < len(ends) - 1:
                stop = max(at + 1, int(np.searchsorted(ends, ends[at] + _BATCH, "right")) - 1)
                some = ends[at:stop + 1]
                full = np.flatnonzero(np.diff(some)) + at
                if len(full):
                    # sets without elements take no space, so the others are contiguous
                    sig = superminhash(flat[some[0]:some[-1]], np.r_[ends[full], some[-1]] - some[0], bands * rows)
                    out[full] = band_hashes(sig, bands, rows)
                at = stop
            sizes = np.where(np.diff(ends) > 0, bands, 0)
            offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
            flat_bands = out[sizes > 0].ravel()
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat_bands))],
                                             schema.names)
    return s.mapInArrow(run, schema)


def class_sets(ids: DataFrame, docs: DataFrame, text: str, k: int) -> DataFrame:
    """(id, s) for the wanted ids: the only step that moves texts, once."""
    t = docs.select(F.col("doc_id").cast("bigint").alias("id"), text).join(ids, "id", "left_semi")
    return materialize(t.select("id", shingle_set(text, k).alias("s")), "sets")


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b), a row for each b, with intersection ``i`` and union ``u`` of the full sets."""
    a, b = (sets.select(F.col("id").alias(c), F.col("s").alias(f"s{c}")) for c in "ab")
    both = pairs.join(a, "a").join(b, "b").select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("i"),
                                                  (F.size("sa") + F.size("sb")).alias("t"))
    return materialize(both.select("a", "b", "i", (F.col("t") - F.col("i")).alias("u")), "compared")


def _distance() -> Column:
    return 1 - F.col("i") / F.col("u")


def _block_links(blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links inside blocks.  ``blocks``: (block, id, side); sides "x" and "y" are compared with each other,
    "y" also among themselves where the block has no "x".  A block holds about ``BLOCK`` rows of a side; each
    "y" yields its least linked "x", or its links to earlier "y" not yet joined: no pairs are emitted."""
    rows = blocks.join(sets, "id").select("block", "id", "side", "s")

    def run(key, pdf):
        xs, ys = pdf[pdf.side == "x"], pdf[pdf.side == "y"]
        against = xs if len(xs) else ys
        ids = against["id"].to_numpy()
        sizes = np.array([len(v) for v in against["s"]], np.int64)
        flat = np.concatenate([np.asarray(v) for v in against["s"]]) if len(against) else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(against)), sizes)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        out, root = [], np.arange(len(against))
        for n, (i, v) in enumerate(zip(ys["id"], ys["s"])):
            v = np.asarray(v)
            lo, hi = np.searchsorted(flat, v, "left"), np.searchsorted(flat, v, "right")
            hit = np.repeat(lo - np.r_[0, np.cumsum(hi - lo)[:-1]], hi - lo) + np.arange((hi - lo).sum())
            common = np.bincount(owner[hit], minlength=len(against))
            near = np.flatnonzero((100 * common >= percent * (sizes + len(v) - common)) & (ids != i))
            if len(xs):
                out += [(i, ids[near].min())] if len(near) else []
            else:
                for j in near[near < n]:
                    if root[j] != root[n]:
                        root[root == root[n]] = root[j]
                        out.append((i, ids[j]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")
    return materialize(rows.groupBy("block").applyInPandas(run, "a bigint, b bigint"), "block-links")


def link_classes(classes: DataFrame, docs: DataFrame, text: str, k: int, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between class representatives that connect every linked pair of the buckets.

    ``classes``: (rep, bands), written.  ``docs`` is read for the full sets of classes that share a bucket."""
    rows = classes.select(F.col("rep").alias("id"), F.explode("bands").alias("bucket"))
    shared = materialize(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket"), "shared")
    members = materialize(rows.join(shared, "bucket"), "members")
    none = members.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    if members.isEmpty():
        return none
    sets = class_sets(members.select("id").distinct(), docs, text, k)
    far = (100 - percent) / 100
    links, labels, act = none, None, members.withColumn("comp", F.col("id"))

    # 1. one comparison for each class and turn, with the least centre of its buckets, while that finds links
    while True:
        least = act.groupBy("bucket").agg(F.min("comp").alias("c"), F.max("comp").alias("d")).where("c < d")
        least = materialize(least.select("bucket", "c"), "centres")
        asked = act.join(least, "bucket").where("c <> comp").groupBy("id").agg(F.min("c").alias("a"))
        seen = _compared(asked.select("a", F.col("id").alias("b")), sets)
        found = seen.where(F.col("i") * 100 >= F.col("u") * percent).select("a", "b")
        if found.isEmpty():
            break
        links = materialize(links.union(found), "links")
        labels = materialize(components(links), "labels")
        act = materialize(members.join(labels, "id", "left").select("id", "bucket", F.coalesce("comp", "id").alias("comp")),
                          "members")

    # 2. buckets of several components: the one with most members, and the others
    per = act.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    big = per.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_comps"), F.max(F.struct("n", "comp")).alias("m"),
                                    F.sum("n").alias("total")).where("n_comps > 1")
    big = materialize(big.select("bucket", F.col("m.comp").alias("big"), (F.col("total") - F.col("m.n")).alias("n_rest")), "mixed")
    if big.isEmpty():
        return links
    rest = materialize(act.join(big, "bucket").where("comp <> big").select("bucket", "id", "big", "n_rest"), "rest")

    # 3. the others against that whole component: by distance to its least id, then in blocks
    y = rest.select(F.col("big").alias("a"), F.col("id").alias("b")).distinct()
    y = _compared(y, sets).select(F.col("a").alias("comp"), F.col("b").alias("id"), _distance().alias("d"))
    wanted = materialize(y.select("comp").distinct(), "wanted")
    if labels is None:
        xs = wanted.select("comp", F.col("comp").alias("id"))
    else:
        in_comp = labels.select("comp", "id").join(wanted, "comp")
        xs = in_comp.union(wanted.select("comp", F.col("comp").alias("id"))).distinct()
    x = _compared(xs.select(F.col("comp").alias("a"), F.col("id").alias("b")), sets).select(
        F.col("a").alias("comp"), F.col("b").alias("id"), F.floor(_distance() / SHELL).cast("int").alias("shell"))
    # |d(y) - d(x)| beyond the largest distance of a link rules a pair out; a margin for rounding
    x_parts = x.groupBy("comp", "shell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("x_parts"))
    near = y.join(materialize(x_parts, "x-parts"), "comp").where((F.col("shell") * SHELL <= F.col("d") + far + 1e-6)
                                                                & ((F.col("shell") + 1) * SHELL >= F.col("d") - far - 1e-6))
    near = materialize(near.select("comp", "shell", "id", "x_parts"), "near")
    # both sides of a shell are dealt to as many parts as they need; each pair of parts is a block
    shells = materialize(near.groupBy("comp", "shell", "x_parts").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("y_parts")), "shells")
    name = F.xxhash64("comp", "shell", "x_part", "y_part")
    every = lambda parts: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(parts) - 1))
    own = lambda parts: F.pmod(F.xxhash64("id"), F.col(parts))
    sent = near.drop("x_parts").join(shells, ["comp", "shell"]).withColumn("y_part", own("y_parts")).withColumn(
        "x_part", every("x_parts")).select(name.alias("block"), "id", F.lit("y").alias("side"))
    dealt = x.join(shells, ["comp", "shell"]).withColumn("x_part", own("x_parts")).withColumn(
        "y_part", every("y_parts")).select(name.alias("block"), "id", F.lit("x").alias("side"))
    far_links = _block_links(dealt.union(sent), sets, percent)

    # 4. the others among themselves, bucket by bucket; more than a block of them: each pair of parts is a block
    parts = F.ceil(F.col("n_rest") / BLOCK)
    own = F.pmod(F.xxhash64("id"), parts)
    pair = F.transform(F.sequence(F.lit(0).cast("bigint"), parts - 1), lambda q: F.xxhash64(
        "bucket", F.least(own, q), F.greatest(own, q)))
    among = rest.where("n_rest > 1").select(F.explode(pair).alias("block"), "id", F.lit("y").alias("side"))
    return links.union(far_links).union(_block_links(among, sets, percent))


def near_duplicates(docs: DataFrame, text: str = "text", k: int = 5, percent: int = PERCENT, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per document."""
    signed = materialize(signed_sets(docs, text, k, bands, rows), "signed")
    linkable = signed.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = materialize(linkable.groupBy("n", "k1", "k2").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "classes")
    links = link_classes(classes.select("rep", "bands"), docs, text, k, percent)
    # rows that repeat an id tie the classes of their texts together
    twice = linkable.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc_id")
    ties = linkable.join(twice, "doc_id").join(classes.drop("bands"), ["n", "k1", "k2"]).select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    labels = components(links.unionByName(ties))
    of_class = materialize(classes.drop("bands").join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
        "n", "k1", "k2", F.coalesce("comp", "rep").alias("component_id")), "class-components")
    out = signed.drop("bands").join(of_class, ["n", "k1", "k2"], "left")
    linked = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    comp = F.when(linked, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"),
                      F.col("doc_id").eqNullSafe(comp).alias("kept"))


def dedup(docs: DataFrame, text: str = "text", **kw) -> DataFrame:
    """One row of each component: that of least id, rows without an id last.

    Each row is a node of its own, so copies that repeat an id or have none go, and a different text stays
    whatever its id."""
    row = "__dedup_row"
    rows = numbered(docs, row)
    found = near_duplicates(rows.select(F.col(row).alias("doc_id"), text), text, **kw)
    placed = materialize(found.select(F.col("doc_id").alias(row), "component_id").join(rows.select(row, "doc_id"), row), "placed")
    first = placed.groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row)).alias("m")).select(F.col(f"m.{row}").alias(row))
    gone = materialize(placed.select(row).join(first, row, "left_anti"), "dropped")
    return rows.join(gone, row, "left_anti").select(docs.columns)


def neardup_digest(docs: DataFrame) -> DataFrame:
    """The registered query: 2-word shingles, as its contract fixes them."""
    return near_duplicates(docs, k=2)


NEARDUP_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 2 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 1, 1))) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b
      WHERE 100 * c >= 80 * (na.n + nb.n - c)),
r AS (SELECT doc_id AS id, doc_id AS reach FROM documents UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.reach),
m AS (SELECT id, min(reach) AS component_id FROM r GROUP BY id)
SELECT t.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id, t.doc_id = m.component_id AS kept
FROM t LEFT JOIN n USING (doc_id) JOIN m ON m.id = t.doc_id
"""
