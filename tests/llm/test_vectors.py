import math
import random

import numpy as np
import pytest

from docenrich.llm import vectors


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))


def plain(rows):
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, _ in rows]
    links = {i: set() for i in range(len(rows))}
    for i, (_, a, p) in enumerate(rows):
        for j, (_, b, q) in enumerate(rows[:i]):
            if ok[i] and ok[j] and p is not None and p == q and len(a) == len(b) and cosine(a, b) >= 0.93:
                links[i].add(j)
                links[j].add(i)
    out = []
    for i, (name, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        comp = min(rows[j][0] for j in seen)
        out.append((name, len(links[i]), comp, name == comp))
    return sorted(out)


@pytest.mark.parametrize("block", [8, 512])
def test_links_are_those_of_all_pairs(spark, block):
    rng = np.random.default_rng(5)
    rows = []
    for label in (1, 2, None):
        for _ in range(12):
            base = rng.standard_normal(64)
            for noise in (0, 0, 0.02, 0.05, 0.3):
                rows.append((base + noise * rng.standard_normal(64)).tolist())
                rows[-1] = (rows[-1], label)
    hot = rng.standard_normal(64)
    rows += [((hot + 0.04 * rng.standard_normal(64)).tolist(), 1) for _ in range(60)]
    rows += [(None, 1), ([], 1), ([0.0] * 64, 1), ([None] + [1.0] * 63, 1), ([float("nan")] * 64, 1),
             ([float("inf")] * 64, 1), ([1.0, 2.0], 1), ([2.0, 4.0], 1), ([1e300] * 64, 1), ([1e-300] * 64, 1)]
    random.Random(1).shuffle(rows)
    rows = [(i * 2, v, label) for i, (v, label) in enumerate(rows)]
    # whose squares overflow or vanish in the plain version
    sane = [(i, [1.0] * 64 if v in ([1e300] * 64, [1e-300] * 64) else v, label) for i, v, label in rows]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, node int")
    mine = sorted(tuple(r) for r in vectors.near_vectors(df, block=block).collect())
    assert mine == plain(sane)


def test_bounds_hold():
    rng = np.random.default_rng(2)
    units = vectors.unit(rng.standard_normal((200, 64)))
    cosines = units @ units.T
    assert (vectors.upper_bounds(units, units) >= cosines - 1e-9).mean() > 0.999


@pytest.mark.parametrize("dim", [3, 64, 100, 768])
def test_codes_keep_the_pairs_at_the_threshold(dim):
    rng = np.random.default_rng(dim)
    one = vectors.unit(rng.standard_normal((400, dim)))
    # partners at cosines from just above the threshold up
    other = rng.standard_normal((400, dim))
    other = vectors.unit(other - (other * one).sum(axis=1, keepdims=True) * one)
    cosine = rng.uniform(0.9301, 0.999, (400, 1))
    other = cosine * one + np.sqrt(1 - cosine**2) * other
    left, right = vectors.codes(one), vectors.codes(other)
    near = vectors.candidates(left, right, dim, 0.93)
    assert np.diag(near).mean() > 0.995
    if dim >= 64:
        # the others are told apart without their vectors
        assert near.mean() < 0.1
    # the estimates are not drawn to one side
    exact = (one @ other.T).ravel()
    sigmas, vectors.SIGMAS = vectors.SIGMAS, 0.0
    try:
        estimates = vectors.code_bounds(left, right, dim).ravel()
    finally:
        vectors.SIGMAS = sigmas
    if dim >= 64:
        assert abs((estimates - exact).mean()) < 0.01
        assert abs(np.polyfit(exact, estimates, 1)[0] - 1) < 0.1


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_vectors(df).collect() == []
