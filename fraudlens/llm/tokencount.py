"""Token counts by a two-tier table of lengths.

White space separates tokens for good in a word-end vocabulary (the tokenizer
drops it before any merge), so a text's count is the sum of the counts of its
pieces between blanks.  Tier 1 is a compact table of frequent pieces and their
lengths, made once on the driver from the vocabulary's own whole words -
bounded by the vocabulary - and broadcast.  Tier 2 is a cache in each Python
worker: misses are encoded by the tokenizer library, whole (so letters' case,
composed characters, digits and special strings are the library's business),
and kept up to ``cache_size`` pieces.  Nothing is shuffled.

Defined cases: null text counts 0 tokens and 0 bytes; empty and very long texts are
counted whole; repeated rows count alike; an empty table gives no rows.  Only
the id and text columns are read.
"""
from __future__ import annotations

import os
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.llm.textops import whole

BETWEEN_BLANKS = r"[^\x20\x09-\x0D]+"
CACHE_SIZE = 400_000               # pieces a worker keeps besides tier 1
_WORKER: dict = {}                 # per Python worker: tokenizer path -> [tokenizer, lengths, n of tier 1]


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _load(path: str):
    from tokenizers import Tokenizer
    os.environ["TOKENIZERS_PARALLELISM"] = "false"      # one thread for each Spark core
    return Tokenizer.from_file(path)


def _lengths(tokenizer, pieces: list[str]) -> list[int]:
    return [len(e.ids) for e in tokenizer.encode_batch(pieces, add_special_tokens=False)]


def frequent_lengths(path: str) -> tuple[str, bytes]:
    """Tier 1: the plain whole words of the vocabulary, blank-joined, and one length byte each."""
    tokenizer = _load(path)
    words = sorted(w[:-4] for w in tokenizer.get_vocab() if w.endswith("</w>") and re.fullmatch("[a-z]+</w>", w))
    return " ".join(words), bytes(_lengths(tokenizer, words))


def _worker_state(path: str, frequent) -> list:
    if path not in _WORKER:
        words, lengths = frequent
        table = dict(zip(words.split(" "), lengths)) if words else {}
        _WORKER[path] = [_load(path), table, dict(table)]
    return _WORKER[path]


def count_texts(texts, tokenizer, table: dict) -> list[int]:
    """Counts of ``texts``; pieces missing from ``table`` are encoded and added to it."""
    split = re.compile(BETWEEN_BLANKS).findall
    out = []
    for text in texts:
        pieces = split(text)
        missing = list(set(pieces).difference(table))
        if missing:
            table.update(zip(missing, _lengths(tokenizer, missing)))
        out.append(sum(map(table.__getitem__, pieces)))
    return out


def token_counter(spark: SparkSession, path: str | None = None, cache_size: int = CACHE_SIZE):
    """A vectorised function text -> number of tokens; the text must not be null."""
    path = path or default_path()
    frequent = spark.sparkContext.broadcast(frequent_lengths(path))

    @F.pandas_udf("bigint")
    def count(batches: pd.Series) -> pd.Series:
        state = _worker_state(path, frequent.value)
        out = []
        for at in range(0, len(batches), 256):
            if len(state[1]) > len(state[2]) + cache_size:
                state[1] = dict(state[2])
            out += count_texts(batches.iloc[at:at + 256], state[0], state[1])
        return pd.Series(out, dtype="int64")
    return count


def token_counts(docs: DataFrame, text: str = "text", limit: int = 2048, path: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per document."""
    count = token_counter(docs.sparkSession, path)
    t = docs.select("doc_id", whole(text).alias("t"))
    t = t.select("doc_id", F.octet_length("t").cast("bigint").alias("n_bytes"), count("t").alias("n_tokens"))
    return t.withColumn("over_limit", F.col("n_tokens") > limit)
