"""SimHash fingerprints and search by permuted block tables.

Terms are the 2-word shingles of a text (a single word: itself); each
occurrence votes with its 64-bit hash, one signed vote a bit, so a term weighs
as often as it occurs.  Set bits are those with more votes for than against.

Search: the 64 bits are cut into ``blocks``; two fingerprints within ``radius``
bits agree on some ``blocks - radius`` whole blocks, so with one table for each
choice of that many blocks every such pair meets on an equal key in some table.
Distinct fingerprints are indexed once with their number of documents;
candidates are verified by their Hamming distance.

Defined cases: null and wordless texts have fingerprint 0; equal texts have
equal fingerprints; repeated rows are separate documents; rows of equal id are
ordered by text, null ids last, where "next" matters; a lone document is its
own next one; empty tables give empty results.  Only id and text are read.
"""
from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.llm.textops import let, whole, words
from fraudlens.session import materialize

BITS = 64
RADIUS, BLOCKS = 3, 6
_BLOCK = 1 << 16                   # terms whose bits are unpacked at a time


def term_hashes(text: Column) -> Column:
    """64-bit hashes of the terms of a non-null text, repeats included."""
    def of(w):
        n = F.size(w)
        pairs = F.transform(F.slice(w, 1, F.greatest(n - 1, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1)))
        return F.when(n == 1, F.array(F.xxhash64(w[0]))).otherwise(pairs)
    return let(words(text), of)


def simhash(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints (uint64) of documents whose term hashes lie between ``ends``."""
    n = len(ends) - 1
    votes = np.zeros((n, BITS), np.int64)
    for at in range(0, len(hashes), _BLOCK):
        part = np.ascontiguousarray(hashes[at:at + _BLOCK])
        doc = np.searchsorted(ends, np.arange(at, at + len(part)), "right") - 1
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1)
        votes[doc[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    up = 2 * votes > np.diff(ends)[:, None]
    return np.packbits(up, axis=1).view(np.uint64).ravel()


def with_fingerprint(df: DataFrame, text: str = "text", name: str = "fp") -> DataFrame:
    """``df`` with the SimHash (bigint) of a text column, null read as empty, as a last column ``name``;
    the other columns pass through."""
    df = df.drop(name)
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.LongType())])

    def run(batches):
        for b in batches:
            terms = b.column(b.num_columns - 1)
            ends = terms.offsets.to_numpy().astype(np.int64)
            flat = terms.flatten().to_numpy(zero_copy_only=False)
            prints = simhash(flat.view(np.uint64), ends - ends[0]).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(prints)], schema.names)
    return df.withColumn("_terms", term_hashes(whole(text))).mapInArrow(run, schema)


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def as_hex(f: Column) -> Column:
    return F.lpad(F.lower(F.hex(f)), BITS // 4, "0")


def _tables(fp: Column, radius: int, blocks: int) -> Column:
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in chosen)
             for chosen in combinations(range(blocks), blocks - radius)]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    return F.explode(F.array(*[F.struct(F.lit(t).alias("t"), fp.bitwiseAND(F.lit(m)).alias("key"))
                               for t, m in enumerate(signed)]))


def near_fingerprints(prints: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(query, fp, n_docs) for each distinct query fingerprint and each fingerprint of ``prints``
    within ``radius`` bits of it; both inputs have a column ``fp`` (bigint)."""
    index = prints.where(F.col("fp").isNotNull()).groupBy("fp").agg(F.count(F.lit(1)).alias("n_docs"))
    index = index.select("fp", "n_docs", _tables(F.col("fp"), radius, blocks).alias("k")).select("fp", "n_docs", "k.*")
    asked = queries.where(F.col("fp").isNotNull()).select(F.col("fp").alias("query")).distinct()
    asked = asked.select("query", _tables(F.col("query"), radius, blocks).alias("k")).select("query", "k.*")
    met = index.join(asked, ["t", "key"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("query"))) <= radius)
    return met.groupBy("query", "fp").agg(F.max("n_docs").alias("n_docs"))


def with_next(docs: DataFrame, order: str, carried: list[str], ids: DataFrame | None = None) -> DataFrame:
    """``docs`` with ``next_<c>`` for each carried column: the row after it by descending ``order``
    (ties by text), the first row after the last.

    Rows are cut into ranges of the order by its quantiles, several for each
    shuffle partition; each range also gets a copy of the first row of the
    range after it, so a row's successor is found inside its range and no
    task orders all rows.  ``ids``: a cheaper plan for the order column of the same rows."""
    spark = docs.sparkSession
    n = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col(order), F.lit(-(1 << 63)))
    docs = docs.withColumn("_key", key)
    ids = (ids if ids is not None else docs).select(key.alias("_key"))
    cuts = ids.agg(F.percentile_approx("_key", [i / n for i in range(1, n)], 20 * n)).first()[0] or []
    splits = [-float("inf"), *sorted({float(c) for c in cuts} or {0.0}), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="_at", outputCol="_range")
    in_range = lambda df: cut.transform(df.withColumn("_at", F.col("_key").cast("double"))).drop("_at")
    ranged = in_range(docs)
    # one row for each range
    firsts = sorted(in_range(ids).groupBy("_range").agg(F.max("_key").alias("k")).collect(), reverse=True)
    goes_to = {b["k"]: a["_range"] for a, b in zip(firsts, [*firsts[1:], *firsts[:1]])}
    guests = spark.createDataFrame([(k, float(r)) for k, r in goes_to.items()], "_key bigint, _to double")
    copies = (ranged.join(F.broadcast(guests), "_key").withColumn("_range", F.col("_to")).drop("_to")
              .withColumn("_guest", F.lit(True)))
    both = ranged.withColumn("_guest", F.lit(False)).unionByName(copies)
    w = Window.partitionBy("_range").orderBy("_guest", F.col("_key").desc(), "text")
    return (both.withColumns({f"next_{c}": F.lead(c).over(w) for c in carried})
            .where(~F.col("_guest")).drop("_key", "_range", "_guest"))


def fingerprint_digest(docs: DataFrame) -> DataFrame:
    """The columns of the registered query, per document; ``n_near``: for ids divisible by 100, the
    documents within ``RADIUS`` bits (itself included), else null."""
    t = with_fingerprint(docs.select("doc_id", whole("text").alias("text")))
    t = with_next(t, "doc_id", ["text", "fp"], docs.select("doc_id"))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third))
    t = t.select("doc_id", n.cast("bigint").alias("n_chars"), "fp", "next_fp", edited.alias("edited"))
    # the edited text itself stays on this side of the exchange
    t = t.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fp", "next_fp", "edited")
    t = materialize(with_fingerprint(t, "edited", "edited_fp").drop("edited"), "fingerprints")
    asked = t.where(F.col("doc_id") % 100 == 0)
    near = near_fingerprints(t, asked).groupBy("query").agg(F.sum("n_docs").cast("bigint").alias("n"))
    return t.join(near, (F.col("doc_id") % 100 == 0) & (F.col("fp") == F.col("query")), "left").select(
        "doc_id", "n_chars", "edited_sha256", as_hex(F.col("fp")).alias("fingerprint"),
        as_hex(F.col("edited_fp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"), F.col("n").alias("n_near"))
