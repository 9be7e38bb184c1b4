"""N-gram Jaccard join: candidate signatures, opened groups and components against brute force."""
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fraudlens.llm import groupjoin

DOCS = "doc_id bigint, text string, sig string, g int, comp string, n int, id string"


def brute_sets(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k=3, percent=90):
    sets = [(d, brute_sets(t, k)) for d, t in rows]
    reach = {d: d for d, _ in sets}

    def find(x):
        while reach[x] != x:
            x = reach[x]
        return x
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                reach[q] = p
    return sorted(((d, len(s), None if d is None else find(d) if s else d) for d, s in sets), key=str)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 260), st.sampled_from([80, 90, 95]), st.integers(0, 10 ** 6))
def test_linked_sets_share_a_signature(n, percent, seed):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(-2 ** 63, 2 ** 63, n))
    gone = rng.integers(0, len(a) * (100 - percent) // 100 + 1)
    new = rng.integers(-2 ** 63, 2 ** 63, rng.integers(0, len(a) * (100 - percent) // 100 + 1))
    b = np.unique(np.r_[rng.permutation(a)[gone:], new])
    both = len(np.intersect1d(a, b))
    of, sig = groupjoin.signatures(np.r_[a, b], np.array([0, len(a), len(a) + len(b)]), percent)
    assert len(np.unique(of)) == 2
    if 100 * both >= percent * (len(a) + len(b) - both):
        assert np.intersect1d(sig[of == 0], sig[of == 1]).size


@pytest.mark.parametrize("percent", [50, 90])
def test_open_group_is_exact_and_closed_groups_hold_no_link(percent):
    rng = np.random.default_rng(1)
    base = np.arange(40)
    draw = lambda: np.sort(np.unique(np.where(rng.random(40) < rng.random() * 0.3, rng.integers(100, 200, 40), base)))
    queries, members = [draw() for _ in range(60)] + [np.array([999])], [draw() for _ in range(20)]
    q, g, opened = groupjoin.open_group(np.concatenate(queries), np.array([len(x) for x in queries]), np.concatenate(members),
                                        np.array([len(x) for x in members]), percent)
    want = {(i, j) for i, x in enumerate(queries) for j, y in enumerate(members)
            if 100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y))}
    assert set(zip(q, g)) == want and want
    assert {i for i, _ in want} <= set(np.flatnonzero(opened)) and not opened[-1]


def corpus():
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(5000)}"
    base = [word() for _ in range(80)]
    rows = []
    for i in range(150):                            # graded copies of one text: some linked, some not
        w = list(base)
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(80)] = word()
        rows.append((i, " ".join(w)))
    passage = " ".join(word() for _ in range(30))   # one passage in texts that are no copies
    rows += [(200 + i, passage + " " + " ".join(word() for _ in range(25))) for i in range(60)]
    rows += [(300 + i, f"The same SHORT text {i % 2}") for i in range(9)] + [(320, "one"), (321, "One"), (322, "one two"), (323, "one two three")]
    rows += [(400, None), (401, ""), (402, " \t\n"), (None, rows[0][1]), (None, None), (403, " ".join(base) + " " + "x y z " * 900)]
    rows += [(3, "an id that repeats with a second text"), (500, "AN id that repeats with a second text")] + [(7, rows[7][1])] * 30
    return rows


@pytest.mark.parametrize("sizes", [{}, {"GROUP": 4, "SHELF": 12, "QUERIES": 5}, {"SHELF_TOKENS": 150, "LAST_SHARE": 0.0}])
def test_components_against_brute_force(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(groupjoin, name, value)
    rows = corpus()
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, "s", 1, "c", 2, "i") for r in rows], DOCS).repartition(4)
    got = sorted((tuple(r) for r in groupjoin.jaccard_components(df).collect()), key=str)
    assert got == brute(rows)


def test_nothing_to_join(spark):
    assert groupjoin.jaccard_components(spark.createDataFrame([], DOCS)).count() == 0
    one = spark.createDataFrame([(1, "a b c d", "s", 1, "c", 2, "i")], DOCS)
    assert [tuple(r) for r in groupjoin.jaccard_components(one).collect()] == [(1, 2, 1)]


def test_sets_meet_their_shelves_by_one_join(spark, monkeypatch):
    """The sets are read once for a round of questions, whatever is asked: queries and shelves share the join."""
    from pyspark.sql import functions as F

    from fraudlens.llm import groupjoin as G
    sets = spark.range(6).select("id", F.transform(F.sequence(F.lit(0), F.lit(19)), lambda x: F.when(x == 0, F.col("id") % 2 * 100 + F.col("id"))
                                                   .otherwise(x).cast("bigint")).alias("s"))
    groups = spark.range(6).select("id", F.lit(0).cast("bigint").alias("g"), F.lit(0).alias("grp"))
    labels = spark.range(6).select("id", F.col("id").alias("comp"))
    seen, kept = [], type(sets).join
    monkeypatch.setattr(type(sets), "join", lambda self, other, *a, **k: (seen.append("s" in other.columns), kept(self, other, *a, **k))[1])
    found = G._ask(groups.select("id", "g").where("id > 0"), sets, groups, labels, 90)
    assert sum(seen) == 1
    from fraudlens.llm.components import components
    assert {tuple(r) for r in components(found).collect()} == {(i, 0) for i in range(6)}


def _marks(sets):
    words, at = groupjoin.parity_marks(np.concatenate(sets), np.cumsum([0] + [len(x) for x in sets]))
    return [words[i:j].tobytes() for i, j in zip(at, at[1:])]


@settings(max_examples=100, deadline=None)
@given(st.sampled_from([50, 80, 90]), st.sampled_from([1, 100, 1 << 20]), st.integers(0, 10 ** 6))
def test_marks_lose_no_link(percent, batch, seed):
    """Widths differ between the two sides here, an empty set and equal labels among them."""
    rng = np.random.default_rng(seed)
    base = np.unique(rng.integers(-2 ** 63, 2 ** 63, rng.integers(1, 300)))
    draw = lambda: np.unique(np.r_[rng.permutation(base)[rng.integers(0, 1 + len(base) // 3):], rng.integers(-2 ** 63, 2 ** 63, rng.integers(0, 1 + len(base) // 3))])
    sides = [[draw() for _ in range(9)] + [base[:0]], [draw() for _ in range(7)]]
    q_label, m_label = rng.integers(0, 9, 10), rng.integers(0, 9, 7)
    kept, groupjoin._BATCH = groupjoin._BATCH, batch
    try:
        (q, q_n), (m, m_n) = ((_marks(x), np.array([len(y) for y in x])) for x in sides)
        q_some, m_some = groupjoin.may_link(q_n, q, q_label, m_n, m, m_label, percent)
    finally:
        groupjoin._BATCH = kept
    for i, a in enumerate(sides[0]):
        for j, b in enumerate(sides[1]):
            if q_label[i] != m_label[j] and len(a) and 100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b)):
                assert q_some[i] and m_some[j]


def test_sets_that_cannot_link_do_not_move(spark, monkeypatch):
    """Only 0 and 1 are linked of forty sets that all ask one shelf, and no other set goes to a block; what has one label already neither."""
    from pyspark.sql import functions as F
    token = F.xxhash64
    own = F.transform(F.sequence(F.lit(1), F.lit(30)), lambda x: token("id", x))
    same = F.transform(F.sequence(F.lit(1), F.lit(30)), lambda x: F.when(x < 30, token(F.lit(0), x)).otherwise(token("id", x)))
    sets = spark.range(40).select("id", F.when(F.col("id") < 2, same).otherwise(own).alias("s"))
    groups = spark.range(40).select("id", F.lit(0).cast("bigint").alias("g"), F.lit(0).alias("grp"))
    met, written = [], groupjoin.materialize

    def keep(df, name="table"):
        out = written(df, name)
        if name == "meetings":
            met.append({r.id for r in out.select("id").collect()})
        return out
    monkeypatch.setattr(groupjoin, "materialize", keep)
    ask = lambda labels: [tuple(sorted(r)) for r in groupjoin._ask(groups.select("id", "g"), sets, groups, labels, 90).collect()]
    labels = spark.range(40).select("id", F.col("id").alias("comp"))
    assert set(ask(labels)) == {(0, 1)} and met == [{0, 1}]
    assert ask(labels.withColumn("comp", F.when(F.col("id") < 2, 0).otherwise(F.col("id")))) == [] and met[1] == set()
