"""Links of vectors against all cosines, with caps, several blocks, and rows of every odd kind."""

import math

import numpy as np
import pytest

from tickharbor.llm import near_vectors as V
from tickharbor.llm.near_vectors import near_vectors

KIND = "label string, embedding array<double>, vec_id long, row long, component int"


def linked(rows, threshold=0.9):
    """(vec_id, n_links, component_id, kept) from all cosines, for rows of (vec_id, vector)."""
    size = max((len(v) for _, v in rows if v is not None), default=0)
    whole = [v is not None and None not in v and bool(np.isfinite(v).all()) and any(x != 0 for x in v) for _, v in rows]
    unit = np.array([np.r_[v, np.zeros(size - len(v))] / np.linalg.norm(v) if w else np.zeros(size) for (_, v), w in zip(rows, whole)])
    link = (unit @ unit.T >= threshold) if len(rows) else np.zeros((0, 0), dtype=bool)
    np.fill_diagonal(link, False)
    label = list(range(len(rows)))
    joined = link | np.array([[a[0] is not None and a[0] == b[0] and i != j for j, b in enumerate(rows)] for i, a in enumerate(rows)], dtype=bool).reshape(link.shape)
    for i, j in zip(*np.nonzero(joined)):
        low, high = sorted((label[i], label[j]))
        label = [low if x == high else x for x in label]
    result = []
    for i, (vec_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        component = min(ids, default=None)
        result.append((vec_id, int(link[i].sum()), component, component is None or vec_id == component))
    return sorted(result, key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame([("x", v, i, 7, 3) for i, v in rows], KIND).repartition(3)
    return sorted((tuple(r) for r in near_vectors(df, **options).collect()), key=str)


def cloud(seed, size=16):
    """Single vectors, pairs near the threshold on both sides, and a dense group of hundreds."""
    rng = np.random.default_rng(seed)
    rows = [rng.standard_normal(size) for _ in range(120)]
    for cosine in np.linspace(0.86, 0.95, 60):
        a = rng.standard_normal(size)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(size)
        b -= a * (a @ b)
        rows += [a, 3 * (cosine * a + math.sqrt(1 - cosine**2) * b / np.linalg.norm(b))]
    centre = rng.standard_normal(size)
    rows += [centre + rng.standard_normal(size) * s for s in np.repeat([0.0, 0.05, 0.2, 0.35], 60)]
    return [(int(i) * 3, list(map(float, v))) for i, v in zip(rng.permutation(len(rows)), rows)]


@pytest.mark.parametrize("options", [{}, {"block_rows": 50}, {"sample": 0}, {"sample": 40, "block_rows": 17}])
def test_all_links(spark, options):
    rows = cloud(3)
    assert found(spark, rows, **options) == linked(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 0.0, 2.0]), (9, [1.0, 0.0, 2.0]), (2, [2.0, 0.0, 4.0]), (2, [0.0, 1.0]), (3, [0.0, 5.0, 0.0]), (4, None), (6, []),
            (7, [0.0, 0.0, 0.0]), (8, [1.0, None, 2.0]), (10, [nan, 1.0]), (11, [inf, 1.0]), (None, [1.0, 0.0, 2.1]), (None, [0.0, 0.0, -1.0]),
            (12, [1e300, 0.0, 2e300]), (13, [1e-310, 0.0, 2e-310])]
    assert found(spark, rows) == linked(rows[:13] + [(12, [1.0, 0.0, 2.0]), (13, [1.0, 0.0, 2.0])])


def test_many_caps(spark):
    """Members of caps next to each other, and guests of several, are compared once."""
    rng = np.random.default_rng(8)
    turn = [np.array([math.cos(t), math.sin(t), 0.0]) for t in np.repeat(np.linspace(0, 1.5, 12), 12)]
    rows = [(i, list(map(float, v + rng.standard_normal(3) * 0.02))) for i, v in enumerate(turn)]
    assert found(spark, rows, block_rows=9) == linked(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_estimates_are_unbiased_and_bounded():
    """Over many rotations the mean estimate is the cosine, and its deviation the one that the bound states."""
    rng = np.random.default_rng(1)
    a, _ = V.units(rng.standard_normal((1, 64)))
    b, _ = V.units(rng.standard_normal((1, 64)))
    b, _ = V.units(0.9 * a + math.sqrt(0.19) * V.units(b - a * (a @ b.T))[0])
    guesses, factors = [], []
    for _ in range(2000):
        q, _ = np.linalg.qr(rng.standard_normal((64, 64)))
        code, factor = V.encode(a, q)
        guesses.append(V.estimates(code, factor, b, q)[0, 0])
        factors.append(factor[0])
    deviation = V.bound_of(np.array(factors), 64, 0.9)
    assert abs(np.mean(guesses) - 0.9) < 4 * deviation.mean() / math.sqrt(2000)
    assert 0.9 < np.std(guesses) / deviation.mean() < 1.1
