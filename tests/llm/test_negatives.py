"""Hard-negative mining: packed products, top-k with ties, and the whole operator against brute force."""
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fraudlens.llm import negatives

ROWS = "vec_id bigint, embedding array<float>, label int, id string, pos int, block int"


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6), st.integers(1, 9), st.integers(1, 5), st.sampled_from([1, 90, 5000, 10 ** 6, 2 ** 26]), st.integers(0, 999))
def test_packed_scores_are_exact(m, n, d, size, seed):
    rng = np.random.default_rng(seed)
    a, c = rng.integers(-size, size + 1, (m, d)), rng.integers(-size // 2, size + 1, (n, d))
    want = a.astype(object) @ c.T.astype(object)
    assert (negatives.packed_scores(a, c).astype(object) == want).all()


def test_packed_scores_without_room_for_a_field():
    a, c = np.array([[2 ** 40, -3], [5, 7]]), np.array([[2 ** 20, -2 ** 40], [1, 1], [0, -1]])
    assert (negatives.packed_scores(a, c).astype(object) == a.astype(object) @ c.T.astype(object)).all()


@given(st.lists(st.lists(st.integers(-3, 3), min_size=5, max_size=5), min_size=1, max_size=4), st.integers(1, 7),
       st.booleans())
@settings(max_examples=60, deadline=None)
def test_best_breaks_ties_by_column(scores, k, large):
    s = np.array(scores, np.int64) * (2 ** 60 if large else 1)
    allowed = s % 2 == 0 if not large else s != 2 ** 60
    row, col = negatives.best(s, allowed, k)
    for i in range(len(s)):
        want = sorted(np.flatnonzero(allowed[i]), key=lambda j: (-s[i, j], j))[:k]
        assert sorted(col[row == i]) == sorted(want)


def brute(rows):
    kept = []
    for i, v, y in rows:
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (y + 1) % 10 if i % 7 == 0 else y))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, v, y in kept:
        if i % 100:
            continue
        others = [(dot(v, w), j, z) for j, w, z in kept if j != i]
        for ps, p, _ in sorted((o for o in others if o[2] == y), key=lambda o: (-o[0], o[1]))[:5]:
            hit = sorted((o for o in others if o[2] != y and 30 * ps <= 100 * o[0] <= 90 * ps), key=lambda o: (-o[0], o[1]))
            out += [(i, p, r, n, ps, ns) for r, (ns, n, _) in enumerate(hit[:10], 1)]
    return sorted(out)


def odd_rows():
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0.05, 0.2, 6)], int(rng.integers(0, 3))) for i in range(330)]
    for i in range(40, 160):                       # a third of the rows is one vector
        rows[i] = (i, [0.25, 0.0, -0.1, 0.3, 0.1, 0.0], i % 2)
    rows[3], rows[5], rows[8] = (3, None, 1), (5, [0.1, None, 0.2], 1), (8, [float("nan")] * 6, 1)
    rows[9], rows[10], rows[200] = (9, [float("inf")] * 6, 1), (10, [0.5] * 6, None), (200, [0.0] * 6, 2)
    return rows + [(None, [0.5] * 6, 1), (331, [0.4, 0.2], 1), (332, [], 2)]


@pytest.mark.parametrize("block,anchors", [(2048, 1024), (32, 2)])
def test_hard_negatives_against_brute_force(spark, monkeypatch, block, anchors):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], ROWS).repartition(5)
    real = negatives.hard_negatives
    monkeypatch.setattr(negatives, "hard_negatives", lambda v: real(v, block=block, anchors_per_tile=anchors))
    got = sorted(tuple(r) for r in negatives.negatives_digest(df).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    assert got == brute(rows) and got


def test_hard_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], ROWS)
    assert negatives.negatives_digest(empty).count() == 0
    alone = spark.createDataFrame([(100, [1.0], 1, "x", 1, 2)], ROWS)
    assert negatives.negatives_digest(alone).count() == 0
