"""Registered queries of the text operators: name -> callable(spark, sf_dir), and their DuckDB twins."""
from __future__ import annotations

from fraudlens.llm import chat, fingerprint, groupjoin, htmltext, langid, mixing, neardup, negatives, pieces, prefixtrie, quality, secrets, tokencount
from fraudlens.sources.tables import read_table


def _over(table, fn):
    return lambda spark, sf_dir: fn(read_table(spark, sf_dir, table))


QUERIES = {
    "op1_chat_perspectives": _over("conversations", chat.chat_digest),
    "op2_token_counts": _over("documents", tokencount.token_counts),
    "op3_secret_scan": _over("documents", secrets.find_secrets),
    "op4_sentencepiece": _over("documents", pieces.encode),
    "op5_source_mixing": _over("documents", mixing.mixing_digest),
    "op6_html_text": _over("pages", htmltext.extract),
    "op7_language_id": _over("documents", langid.langid_digest),
    "op8_neardup": _over("documents", neardup.neardup_digest),
    "op9_quality_rules": _over("documents", quality.quality_digest),
    "op10_simhash": _over("documents", fingerprint.fingerprint_digest),
    "op11_prefix_trie": _over("conversations", prefixtrie.trie_digest),
    "op12_jaccard_join": _over("documents", groupjoin.jaccard_components),
    "op13_hard_negatives": _over("embeddings", negatives.negatives_digest),
}
ORACLE = {
    "op1_chat_perspectives": chat.CHAT_SQL,
    "op5_source_mixing": mixing.MIXING_SQL,
    "op8_neardup": neardup.NEARDUP_SQL,
    "op9_quality_rules": quality.QUALITY_SQL,
    "op11_prefix_trie": prefixtrie.TRIE_SQL,
    "op12_jaccard_join": groupjoin.GROUPJOIN_SQL,
    "op13_hard_negatives": negatives.NEGATIVES_SQL,
}
