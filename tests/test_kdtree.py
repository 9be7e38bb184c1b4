"""Trees of the neighbour search: exact inside a block, few rows and boxes looked at, few cells walked."""
import json

import numpy as np

from fraudlens.operators.neighbors import KdTree, best


def brute(q, x, k):
    d2 = sum((q[:, None, j] - x[None, :, j]) ** 2 for j in range(x.shape[1]))
    order = np.lexsort((np.broadcast_to(np.arange(len(x)), d2.shape), d2), axis=1)[:, :k]
    return order, np.take_along_axis(d2, order, 1)


def stretched(n, seed):
    """Columns of unlike width, ties and a vector that many rows share."""
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 31, n), rng.exponential(50, n).round(2), rng.integers(0, 2_600_000, n)]).astype(float)
    x[: n // 10] = x[0]
    return x


def test_block_search_is_exact_with_ties():
    x, q = stretched(1500, 1), stretched(300, 2)
    q[:50] = x[:50]
    for k in (1, 4, 11):
        row, col, d2 = best(q, x, k, np.full(len(q), np.inf))
        want, far = brute(q, x, k)
        assert (row == np.repeat(np.arange(len(q)), k)).all()
        assert (col.reshape(-1, k) == want).all() and (d2.reshape(-1, k) == far).all()
    bound = brute(q, x, 4)[1][:, 3]                   # a known bound: what lies within it, and no more than k rows
    row, col, _ = best(q, x, 4, bound)
    assert (col.reshape(-1, 4) == brute(q, x, 4)[0]).all()
    few = best(q, x[:3], 5, np.full(len(q), np.inf))
    assert (np.bincount(few[0]) == 3).all()


def test_walk_looks_at_few_boxes_whatever_the_number_of_cells():
    """Sixteen times the cells: a query walks about as many nodes more as the tree is deeper."""
    looked = []
    for n in (4000, 64000):
        x = np.random.default_rng(3).normal(size=(n, 3))
        tree, seen = KdTree.over(x, 32), [0]
        gaps = tree._gaps

        def counted(a, node):
            seen[0] += len(node)
            return gaps(a, node)
        tree._gaps = counted
        q = x[:200]
        r, _ = tree.reach(q, brute(q, x, 4)[1][:, 3])
        assert len(r) / len(q) < 20
        looked.append(seen[0] / len(q))
    assert looked[1] < 2 * looked[0] + 30


def test_cells_of_a_sample_and_state():
    x = stretched(5000, 5)
    tree = KdTree.from_state(json.loads(json.dumps(KdTree.over(x[::10], 16).state())))
    cell = tree.cells(x)
    n = int(tree.leaf.max()) + 1
    lo, hi = np.full((n, 3), np.inf), np.full((n, 3), -np.inf)
    np.minimum.at(lo, cell, x)
    np.maximum.at(hi, cell, x)
    full = tree.filled(np.bincount(cell, minlength=n), lo, hi)
    assert full.count[0] == len(x)
    q = x[:100]
    want, far = brute(q, x, 4)
    r, leaf = full.reach(q, far[:, 3])
    visited = set(zip(r.tolist(), leaf.tolist()))
    assert all((i, int(cell[j])) in visited for i in range(100) for j in want[i])
