"""The corpus pipeline: documents -> quality rules -> near-duplicates -> secrets -> mixing -> token ids.

Each stage reads the rows that the one before it wrote.  All but the last
return the columns of ``documents``; the last returns (doc_id, n_tokens, ids,
round_trip).  Null texts, empty tables and repeated rows are handled as
the operators define it; a repeated row is a document of its own to
the quality rules, the secret scan and the mix.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.llm import mixing, neardup, pieces, quality, secrets
from fraudlens.session import ensure_checkpoint_dir
from fraudlens.sources.tables import read_table

#: SQL cannot express MinHash candidates, the network and the token ids; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the default policy of the quality rules."""
    return docs.where(quality.passes(quality.ledger_of("text")["fail_bits"], quality.DEFAULT_POLICY))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return neardup.dedup(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with found secrets masked, and ``n_chars`` to match."""
    out = secrets.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.take(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    return pieces.encode(docs)


STAGES = [
    ("quality rules", keep_good),
    ("near-duplicates", drop_near_copies),
    ("secret scans", hide_secrets),
    ("source mixing", mix_sources),
    ("sentencepiece", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared checkpoint folder."""
    docs = read_table(spark, sf_dir, "documents")
    top = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{i}")
        docs = spark.read.parquet(f"{top}/{i}")
    return docs
