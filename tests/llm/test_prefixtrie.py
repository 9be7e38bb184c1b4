"""Prefix trie against a brute-force trie of dictionaries: long and shared conversations, shard and slab edges, odd rows."""
import hashlib
import random
import zlib

import numpy as np
import pytest

from fraudlens.llm import prefixtrie

TURNS = "conv_id bigint, turn bigint, role string, text string, c string, n int, depth string, ids string"


def brute_nodes(sequences):
    """``sequences``: conversation -> list of (role, text)."""
    members = {}
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    out = []
    for prefix, inside in members.items():
        below = [p for p in members if p[:len(prefix)] == prefix]
        kids = [p for p in below if len(p) == len(prefix) + 1]
        ends = sorted(c for c in inside if len(sequences[c]) == len(prefix))
        leaves = sum(not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in members) for p in below)
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        out.append((min(inside), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(inside), len(kids), leaves, saved,
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def originals(rows):
    conv = {}
    for c, turn, role, text in rows:
        if c is not None:
            conv.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    name = lambda r, t: hashlib.md5(f"{len(r)}:{r}:{t}".encode()).hexdigest()
    return {c: [x[2:] for x in sorted(t, key=lambda x: (x[0], x[1], x[2], name(*x[2:])))] for c, t in conv.items()}


def rebuilt(conv):
    out = {}
    for c, t in conv.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        out[c] = conv.get(base, [])[:h] + t[h:]
    return out


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], TURNS).repartition(5)


def found(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                               "saved_tokens", "ends_sha256").collect()), key=lambda r: (r[1], r[0]))


def dialogues():
    rng = random.Random(2)
    turn = lambda: (rng.choice(["user", "assistant", "system"]), rng.choice(["a", "bb", "ccc", "日本"]))
    rows = []
    for c in range(-7, 90):
        rows += [(c, t, *turn()) for t in range(rng.randrange(0, 5))]
    same = [(i, *turn()) for i in range(3)]
    rows += [(200 + c, *t) for c in range(60) for t in same]                     # one conversation in many copies
    long = [(i, *turn()) for i in range(23)]
    rows += [(300, *t) for t in long] + [(301, *t) for t in long[:16]] + [(302, *t) for t in long[:20]] + [(303, 0, "user", "x")]
    rows += [(304, *t) for t in long] + [(400, *t) for t in long[:8]] + [(401, *t) for t in long[:8]] + [(402, *t) for t in long[:9]]
    rows += [(500, None, None, None), (500, None, "user", None), (500, 3, "a", "tie"), (500, 3, "a", "tie"), (500, 3, "a", "other"),
             (501, None, None, None), (None, 1, "user", "no id"), (502, 1, "", "")]
    return rows


@pytest.mark.parametrize("slab,shard_turns", [(64, 1 << 17), (4, 16), (1, 1 << 17)])
def test_trie_against_brute_force(spark, slab, shard_turns):
    rows = dialogues()
    turns = prefixtrie.turn_rows(rows_of(spark, rows))
    conv = turns.groupBy("c").count().withColumnRenamed("count", "total")
    assert found(prefixtrie.trie(conv, turns, slab, shard_turns)) == brute_nodes(originals(rows))


def test_digest_rebuilds_conversations(spark):
    rows = dialogues()
    rows += [(c, t, "user", f"{c // 5} {t}") for c in range(600, 640) for t in range(10)]
    assert found(prefixtrie.trie_digest(rows_of(spark, rows))) == brute_nodes(rebuilt(originals(rows)))


def test_turnless_and_empty(spark):
    assert found(prefixtrie.trie_digest(rows_of(spark, []))) == []
    short = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    got = found(prefixtrie.trie_digest(rows_of(spark, [(short, 0, "user", "gone")])))
    assert got == [(short, 0, None, 1, 0, 1, 0, hashlib.sha256(str(short).encode()).hexdigest())]


def test_sort_shard_marks_what_rows_share():
    rng = np.random.default_rng(3)
    seqs = [rng.integers(0, 2, rng.integers(0, 5)) for _ in range(80)]
    n = np.array([len(x) for x in seqs])
    ids = np.repeat(np.concatenate(seqs), 2)
    order, common = prefixtrie.sort_shard(np.zeros(80, np.int64), ids, n, np.zeros(80, bool), np.arange(80))
    ranked = [tuple(seqs[i]) for i in order]
    assert ranked == sorted(ranked)
    for before, here, c in zip(ranked, ranked[1:], common[1:]):
        assert here[:c] == before[:c] and (c == min(len(here), len(before)) or here[c] != before[c])
