"""Connected components of a link table by union-find steps on the whole table.

Each round every node hooks on its neighbour of least random rank (if that is
below its own), parents are jumped to their parents, and the links are
contracted to the parents; links inside one tree vanish.  Random ranks keep
the trees shallow whatever the ids.  Every round writes its tables to the
shared checkpoint folder, so a lost executor costs one round at most, and the
driver only asks whether links are left.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(id, comp) for every id in ``links`` (a, b bigint): the least id that it reaches."""
    e = materialize(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                    "links")
    labels, turn = None, 0
    while not e.isEmpty():
        turn += 1
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("h"), F.col(c).alias("v"))
        up = both.groupBy("u").agg(F.min(rank("v")).alias("m")).select(
            "u", F.when(F.col("m") < rank("u"), F.col("m.v")).otherwise(F.col("u")).alias("to"))
        up = materialize(up, "parents")
        for _ in range(2):
            far = up.select(F.col("u").alias("to"), F.col("to").alias("far"))
            up = up.join(far, "to").select("u", F.col("far").alias("to"))
        up = materialize(up, "parents")
        a, b = (up.select(F.col("u").alias(c), F.col("to").alias(f"{c}_to")) for c in "ab")
        e = e.join(a, "a").join(b, "b").where("a_to <> b_to").select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
        e = materialize(e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        if labels is None:
            labels = up.select(F.col("u").alias("id"), F.col("to").alias("root"))
        else:
            labels = labels.join(up.select(F.col("u").alias("root"), "to"), "root", "left").select(
                "id", F.coalesce("to", "root").alias("root"))
    if labels is None:
        return e.select(F.col("a").alias("id"), F.col("b").alias("comp"))
    labels = materialize(labels, "labels")
    least = materialize(labels.groupBy("root").agg(F.min("id").alias("comp")), "roots")
    return labels.join(least, "root").select("id", "comp")
