"""Hard negatives against a scan of all rows, through upper levels, several blocks and chunks, and with odd rows."""

import math

import numpy as np
import pytest

from tickharbor.llm import hyperplane_tree as T
from tickharbor.llm.hard_negatives import hard_negatives

KIND = "row long, embedding array<double>, label int, cell string, vec_id long, rank int"


def mined(rows, step, positives=5, negatives=3):
    """The same from whole numbers of Python, for rows of (vec_id, label, vector)."""
    known = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows
             if None not in (i, label, v) and None not in v and all(map(math.isfinite, v)) and all(math.isfinite(256 * x) for x in v)]
    result = []
    for at, (anchor, label, a) in enumerate(known):
        if anchor % step:
            continue
        scored = [(-sum(x * y for x, y in zip(a, b)), i, other) for k, (i, other, b) in enumerate(known) if k != at]
        for score, positive, _ in sorted(s for s in scored if s[2] == label)[:positives]:
            fits = sorted(s for s in scored if s[2] != label and 50 * -score <= 100 * -s[0] <= 95 * -score)
            result += [(anchor, positive, rank, i, -score, -s) for rank, (s, i, _) in enumerate(fits[:negatives], 1)]
    return sorted(result)


def found(spark, rows, step, **options):
    df = spark.createDataFrame([(1, v, label, "c", i, 9) for i, label, v in rows], KIND).repartition(3)
    return sorted(tuple(r) for r in hard_negatives(df, step, **options).collect())


def cloud(seed, rows=400, size=12):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((9, size))
    values = centres[rng.integers(0, 9, rows)] + rng.standard_normal((rows, size)) * 0.4
    values[rows // 2:rows // 2 + 90] = values[3]  # copies, whose scores are ties
    return [(int(i), int(k), list(map(float, v))) for i, k, v in zip(rng.permutation(rows), rng.integers(0, 4, rows), values)]


@pytest.mark.parametrize("options", [{}, {"cell_rows": 30}, {"cell_rows": 25, "block_rows": 11, "chunk_anchors": 8, "sample": 150}])
def test_all_negatives(spark, options):
    rows = cloud(5)
    expected = mined(rows, 7)
    assert len(expected) > 300
    assert found(spark, rows, 7, **options) == expected


def test_odd_rows(spark):
    rows = [(0, 1, [1.0, 2.0]), (0, 1, [1.0, 2.0]), (3, 1, [1.0, 1.5]), (3, 2, [0.9, 1.5, 0.0]), (4, 2, [1.0, 1.0]), (5, 2, [1.0, 1.0]),
            (6, None, [1.0, 2.0]), (None, 2, [1.0, 1.0]), (7, 2, None), (8, 2, [None, 1.0]), (9, 2, [float("nan"), 1.0]),
            (10, 3, [-1.0, -2.0]), (20, 3, [-1.0, -2.0, 0.0]), (30, 3, []), (31, 4, [0.0, 0.0]), (40, 5, [1.0, 2.0]),
            (50, 6, [1e9, 1e3]), (51, 6, [1e5, 1.0]), (52, 7, [6e4, 2.0]), (53, 7, [1e306, 0.0])]
    got = found(spark, rows, 10)
    assert got == mined(rows, 10)
    assert any(r[4] > 2**53 for r in got)


def test_empty_table(spark):
    assert found(spark, [], 10) == []


def test_subtrees_are_left_out():
    """Rings around a query skip most leaves of a clustered table, and no row that they hold."""
    rng = np.random.default_rng(2)
    rows = np.floor(256 * (rng.standard_normal((40, 8))[rng.integers(0, 40, 6000)] + 0.05 * rng.standard_normal((6000, 8))))
    longest = float((rows**2).sum(axis=1).max())
    tree = T.grow(T.lifted(rows, longest), longest)
    queries = rows[::600]
    exact = queries @ rows.T
    high = exact.max(axis=1)
    low = high - 2000
    seen = np.zeros(exact.shape, dtype=bool)

    def leaf(part, alive):
        seen[np.ix_(alive, part)] = True

    T.descend(tree, queries, (queries**2).sum(axis=1), longest, np.arange(len(queries)), low, high, np.arange(len(queries)), leaf)
    inside = (exact >= low[:, None]) & (exact <= high[:, None])
    assert seen[inside].all()
    assert seen.mean() < 0.5
