"""Whitening against a plain singular value decomposition of exact integers."""
import math

import numpy as np
import pytest

from cohortqc.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n long, component string"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, 1, "x", 2, "c") for i, v in zip(ids, vectors)], SCHEMA)


def grid(vectors):
    return [[math.floor(float(np.float32(c)) * 1024) + 100_000 for c in v] for v in vectors]


def by_hand(vectors):
    """n, deviations, eigenvalues and components of the vectors' grid values, by a decomposition of the rows themselves."""
    x = grid(vectors)
    n, d = len(x), len(x[0])
    total = [sum(r[j] for r in x) for j in range(d)]
    deviation = [sum((n * r[j] - total[j]) ** 2 for j in range(d)) for r in x]
    centred = np.array([[(n * r[j] - total[j]) / n for j in range(d)] for r in x])
    _, singular, right = np.linalg.svd(centred, full_matrices=False)
    return n, deviation, centred, singular ** 2 / n, right


def cloud(rows, dims, seed=1, spread=6.0):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(dims, dims))
    return (rng.normal(size=(rows, dims)) * np.linspace(spread, 0.2, dims)) @ mix * 0.05


def held(spark, vectors, components=8):
    got = W.whiten(spark, frame(spark, [[float(c) for c in v] for v in vectors]).repartition(5), components).collect()
    n, deviation, centred, values, right = by_hand(vectors)
    k = min(components, int((values > 1e-20 * values[0]).sum()))
    assert len(got) == n * k
    z = np.zeros((n, k))
    for r in got:
        z[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and int(r.deviation) == deviation[r.vec_id]
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        assert r.eigenvalue == pytest.approx(values[r.component - 1], rel=1e-9)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9
    want = centred @ right[:k].T / np.sqrt(values[:k])
    signs = np.sign((z * want).sum(axis=0))
    assert np.abs(z - want * signs).max() < 1e-6 * np.abs(want).max()
    return got


def test_against_a_plain_decomposition(spark):
    held(spark, cloud(500, 20))


def test_fewer_dimensions_than_components(spark):
    held(spark, cloud(200, 3))


def test_badly_conditioned(spark):
    """Two columns that differ by a grid step here and there: a plain Gram factor is close to failing."""
    v = cloud(800, 6) * 400
    v[:, 5] = v[:, 4] + (np.arange(800) % 97 == 0) / 1024
    held(spark, v)


def test_dependent_and_constant_columns(spark):
    v = cloud(300, 6)
    v[:, 2] = 0.25
    v[:, 5] = v[:, 1]
    assert {r.component for r in held(spark, v)} == {1, 2, 3, 4}


def test_fewer_rows_than_columns(spark):
    assert {r.component for r in held(spark, cloud(4, 12))} == {1, 2, 3}


def test_rows_that_cannot_be_used(spark):
    v = [[float(c) for c in r] for r in cloud(60, 4)]
    bad = [None, [], [1.0, None, 0.0, 0.0], [float("nan")] * 4, [float("inf"), 0.0, 0.0, 0.0], [1.0] * 3, [3e30, 0.0, 0.0, 0.0]]
    got = W.whiten(spark, frame(spark, v + bad, [*range(60), *range(100, 107)])).collect()
    assert {r.vec_id for r in got} == set(range(60)) and {r.n for r in got} == {60}
    plain = W.whiten(spark, frame(spark, v)).collect()
    assert sorted((r.vec_id, r.component, int(r.deviation)) for r in got) == sorted(
        (r.vec_id, r.component, int(r.deviation)) for r in plain)


def test_repeated_rows_and_ids_count(spark):
    v = [[float(c) for c in r] for r in cloud(50, 3)]
    got = W.whiten(spark, frame(spark, v + v[:10] * 3, [*range(50), *[None, 7, 7, 7, 7, 7, 7, 7, 7, 7] * 3])).collect()
    assert len(got) == 80 * 3 and {r.n for r in got} == {80}


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None, None]])
def test_nothing_to_decompose(spark, vectors):
    got = W.whiten(spark, frame(spark, vectors))
    assert got.count() == 0 and "whitened" in got.columns


def test_large_entries_stay_exact(spark):
    v = [[2.0 ** 40, 1.0], [2.0 ** 41, 5.0], [-(2.0 ** 40), 2.0], [0.0, 0.5]]
    got = W.whiten(spark, frame(spark, v)).collect()
    _, deviation, *_ = by_hand(v)
    assert {(r.vec_id, int(r.deviation)) for r in got} == set(enumerate(deviation))


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    v = cloud(300, 5)
    monkeypatch.setattr(W, "BLOCK", 7)
    held(spark, v)
