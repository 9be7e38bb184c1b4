"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built.  A text is
cut greedily into the longest phrases that occur in that text (a letter that does not is one); the language
whose phrases are fewest, weighed by log2 of its automaton's text length
(the bits to point at a phrase), wins.

The automata are made on the driver from a bounded sample: per language one
stretch of ``SAMPLE_CHARS`` characters, at a place given by the text's hash, of each
of at most ``SAMPLE_DOCS`` different labelled texts, the first by hash.
Their size does not grow with the input: a language has at most three
transitions of 12 bytes for each of its ``SAMPLE_DOCS * SAMPLE_CHARS`` characters
(1.1 MB), whatever its alphabet.  Every letter seen in training has a symbol of its own.
Prediction is one pass without shuffle over whole texts: letters
in lower case, any run of other characters as one blank, cut into stretches of
``STRETCH`` symbols, which all advance together through the automata's
sorted (state, symbol) keys.

Defined cases: null text, or text without a letter, is ``und`` with score 0;
with equal phrase counts the first language by name wins; without labelled rows
all are ``und``; rows without doc_id are predicted but not learned from;
repeated rows are predicted alike and learned from once; empty tables give no rows.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.llm.textops import whole

SAMPLE_DOCS, SAMPLE_CHARS = 100, 300
STRETCH = 256
UNKNOWN = "und"                    # fixed by the contract
_BLANK, _OTHER, _FIRST = 0, 1, 2   # symbols: no letter, a letter not seen in training, letters
_WORKER: dict = {}


def _letters(texts: list[str]) -> dict[str, int]:
    """Symbols of all letters seen in training."""
    return {c: _FIRST + i for i, c in enumerate(sorted({c for t in texts for c in t.lower() if c.isalpha()}))}


def symbol_table(letters: dict[str, int]) -> np.ndarray:
    """Symbol of every code point."""
    table = np.fromiter((_OTHER if chr(i).isalpha() else _BLANK for i in range(0x110000)), np.int32, 0x110000)
    for c, s in letters.items():
        for v in {c, c.upper()}:
            if len(v) == 1:
                table[ord(v)] = s
    return table


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    s = table[np.frombuffer(text.encode("utf-32-le"), "<u4")]
    return s[(s != _BLANK) | (np.append(_OTHER, s[:-1]) != _BLANK)]


def automaton(seq: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``seq``; state 0 is the root."""
    go, link, length, last = [{}], [-1], [0], 0
    for c in seq:
        cur = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = cur
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                copy = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    return go


def _sparse(seq: list[int]) -> tuple[np.ndarray, np.ndarray, float]:
    """(sorted keys ``symbol << 32 | state`` of the transitions, their next states, bits of a phrase)."""
    edges = sorted((c << 32 | s, t) for s, out in enumerate(automaton(seq)) for c, t in out.items())
    keys, to = np.array([*edges, (1 << 62, 0)], np.int64).T          # the last key matches nothing
    return np.ascontiguousarray(keys), to.astype(np.int32), float(np.log2(len(seq) + 1))


def fit(labelled: DataFrame, docs: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> dict:
    """The model from rows (lang, text): automata over stretches of the first different texts of each language by hash."""
    t = labelled.select("lang", "text", F.xxhash64("text").alias("h"))
    # hashes alone are shuffled; `docs` of them a language stay
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = t.select("lang", "h").distinct().withColumn("rn", first).where(F.col("rn") <= docs).select("lang", "h")
    begin = F.pmod(F.col("h"), F.greatest(F.length("text") - chars, F.lit(0)) + 1).cast("int") + 1
    rows = (t.join(chosen, ["lang", "h"]).select("lang", "h", F.substr("text", begin, F.lit(chars)).alias("text"))
            .groupBy("lang", "h").agg(F.min("text").alias("text")).orderBy("lang", "h").collect())
    letters = _letters([r["text"] for r in rows])
    table = symbol_table(letters)
    by_lang: dict[str, list[int]] = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).extend(symbols(" " + r["text"], table).tolist())
    return {"letters": letters, "langs": sorted(by_lang), "automata": [_sparse(by_lang[k]) for k in sorted(by_lang)]}


def phrase_counts(streams: list[np.ndarray], model: dict) -> np.ndarray:
    """(texts, languages) phrases of each symbol stream."""
    lanes, owner = [], []
    for i, s in enumerate(streams):
        for at in range(0, len(s), STRETCH):
            lanes.append(s[at:at + STRETCH])
            owner.append(i)
    out = np.zeros((len(streams), len(model["langs"])))
    if not lanes:
        return out
    size = np.array([len(x) for x in lanes])
    order = np.argsort(-size, kind="stable")
    size, owner = size[order], np.array(owner)[order]
    grid = np.zeros((size[0], len(lanes)), np.int64)
    for j, k in enumerate(order):
        grid[:size[j], j] = lanes[k]
    column = grid.astype(np.int32)               # symbols are numbered: they index what the root leads to
    grid <<= 32
    active = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")     # lanes longer than each step
    seen = np.arange(int(column.max()) + 1, dtype=np.int64) << 32
    for lang, (keys, to, _) in enumerate(model["automata"]):
        at = np.searchsorted(keys, seen)         # the root is state 0
        root = np.where(keys[at] == seen, to[at], 0)
        state, count = np.zeros(len(lanes), np.int64), np.zeros(len(lanes), np.int64)
        for step, n in enumerate(active):
            key = grid[step, :n] | state[:n]
            at = np.searchsorted(keys, key)
            miss = keys[at] != key               # the phrase ends before this symbol
            begin = root[column[step, :n]]       # 0 for a letter not seen in training, a phrase by itself
            count[:n] += miss & (state[:n] > 0)
            count[:n] += miss & (begin == 0)
            state[:n] = np.where(miss, begin, to[at])
        np.add.at(out[:, lang], owner, count + (state > 0))
    return out


def predict(docs: DataFrame, model: dict, text: str = "text", batch: int = 512) -> DataFrame:
    """(doc_id, lang_pred, score) per document; the score is the winner's share of 2^-bits."""
    known = docs.sparkSession.sparkContext.broadcast(model)
    key = hashlib.sha256("".join(model["letters"]).encode()).hexdigest()     # symbols go by place
    t = docs.select("doc_id", whole(text).alias("t"))
    schema = T.StructType([t.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        m = known.value
        if key not in _WORKER:
            _WORKER.clear()
            _WORKER[key] = symbol_table(m["letters"])
        table = _WORKER[key]
        bits = np.array([a[2] for a in m["automata"]])
        for b in batches:
            for at in range(0, b.num_rows, batch):
                part = b.slice(at, batch)
                streams = [symbols(x, table) for x in part.column(1).to_pylist()]
                lettered = np.array([bool((s != _BLANK).any()) for s in streams], bool)
                langs, scores = np.full(len(streams), UNKNOWN, object), np.zeros(len(streams))
                if len(bits):
                    cost = phrase_counts(streams, m) * bits
                    best = cost.argmin(1)
                    share = 1 / np.exp2(np.maximum(cost.min(1)[:, None] - cost, -200)).sum(1)
                    langs[lettered] = np.array(m["langs"], object)[best[lettered]]
                    scores[lettered] = share[lettered]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(scores)], schema.names)
    return t.mapInArrow(run, schema)


def langid_digest(docs: DataFrame) -> DataFrame:
    """The registered query: learned from two thirds of the labelled rows, predicted for all."""
    third = F.crc32(F.col("doc_id").cast("string")) % 3
    labelled = docs.where((third != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    out = predict(docs, fit(labelled))
    return out.select("doc_id", F.coalesce(third == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
