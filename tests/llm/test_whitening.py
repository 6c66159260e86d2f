"""Whitening against numpy's dense eigensolver and exact integers."""

import numpy as np
import pytest

from basketry.llm import whitening as wh


def spectrum_matrix(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    a = q * np.array(values) @ q.T
    return (a + a.T) / 2


SPECTRA = {
    "spread": np.geomspace(1e6, 1e-3, 40),
    "dense": np.linspace(50, 51, 48),
    "noise": np.linalg.eigvalsh(np.cov(np.random.default_rng(1).standard_normal((64, 500)))),
    "equal": np.r_[np.full(20, 7.0), np.full(20, 7.0 + 1e-9), 1, 2, 3],
    "one": np.array([3.0]),
    "low rank": np.r_[np.zeros(30), 5, 4, 3, 1e-3],
    "outlier": np.r_[1e9, np.linspace(1, 2, 39)],
}


@pytest.mark.parametrize("name", SPECTRA)
def test_components_equal_a_dense_solver(spark, name):
    v = spectrum_matrix(SPECTRA[name])
    values, axes = wh.components_of(spark, v, 32)
    want = np.sort(np.linalg.eigvalsh(v))[::-1]
    size = np.abs(want).max()
    k = min(32, int((want > wh.ZERO_SHARE * want.sum()).sum()))
    assert len(values) == k
    assert np.abs(values - want[:k]).max() <= 1e-13 * size * len(v)
    assert np.abs(axes.T @ axes - np.eye(k)).max() < 1e-13
    assert np.abs(v @ axes - axes * values).max() <= 1e-13 * size * len(v)


@pytest.mark.parametrize("seed", range(6))
def test_inertia(seed):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((30, 30)) * (rng.random((30, 30)) < 0.3)
    a = np.round(a + a.T, 1)
    np.fill_diagonal(a, np.where(rng.random(30) < 0.5, 0, np.diag(a)))
    values = np.linalg.eigvalsh(a)
    for s in (-2.05, -0.513, 0.0137, 0.77, 3.1):
        assert wh.eigenvalues_above(a, s) == (values > s).sum()


def test_intervals_hold_all(spark):
    for v in map(spectrum_matrix, SPECTRA.values()):
        found = wh.intervals(v)
        values = np.linalg.eigvalsh(v)
        assert all(((values > low) & (values <= high)).sum() == n for low, high, n in found)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2.0, "x") for i, v in rows], "vec_id long, embedding array<float>, n long, v double, whitened string").repartition(3)


def test_rows_against_brute_force(spark):
    rng = np.random.default_rng(3)
    scale = np.linspace(0.5, 3, 40)
    data = (rng.standard_normal((300, 40)) * scale + 2).astype(np.float32)
    rows = [(i // 2, x.tolist()) for i, x in enumerate(data)]  # every id twice
    rows += [(None, data[0].tolist())] * 100  # a vector that many rows hold
    bad = [(900, None), (901, [None] * 40), (902, [float("nan")] * 40), (903, [float("inf")] + [0.0] * 39), (904, [1.0, 2.0]), (905, [])]
    got = wh.whiten(frame(spark, rows + bad)).toPandas()
    c = np.vstack([data, np.repeat(data[:1], 100, axis=0)]).astype(float)
    x = np.floor(64 * c).astype(int) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    assert len(got) == n * 32 and set(got.component) == set(range(1, 33)) and (got.n == n).all()
    z = x - s / n
    v = z.T @ z / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:32], q[:, ::-1][:, :32]
    want = z @ q / np.sqrt(e)
    exact = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x]
    assert sorted(exact * 32) == sorted(got.deviation) and sorted(map(int, got.deviation_exact)) == sorted(exact * 32)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-10
    shares = got.groupby("component").explained.unique()
    assert np.allclose([float(u[0]) for u in shares], e / np.trace(v), rtol=1e-10)
    for k in range(32):
        have = np.sort(got[got.component == k + 1].whitened.to_numpy())
        assert min(np.abs(have - np.sort(w)).max() for w in (want[:, k], -want[:, k])) < 1e-7


def test_sums_and_deviations_beyond_64_bits(spark):
    huge = float(2**60)
    rows = [(1, [huge, 0.0]), (2, [-huge, 1.0]), (3, [0.0, 2.0]), (4, [1e38, 3.0])]
    got = {r.vec_id: r for r in wh.whiten(frame(spark, rows)).where("component = 1").collect()}
    clip = lambda c: max(-(1 << 61), min(1 << 61, int(64 * c))) + 1_000_000
    x = [[clip(c) for c in v] for _, v in rows]
    s = [sum(c) for c in zip(*x)]
    for (i, _), r in zip(rows, x):
        exact = sum((4 * a - b) ** 2 for a, b in zip(r, s))
        assert got[i].deviation == (exact if exact < 1 << 63 else None)
        assert got[i].deviation_exact is None or int(got[i].deviation_exact) == exact


def test_no_components(spark):
    assert wh.whiten(frame(spark, [])).count() == 0
    assert wh.whiten(frame(spark, [(1, None), (2, [float("nan")])])).count() == 0
    assert wh.whiten(frame(spark, [(1, [1.0, 2.0])])).count() == 0
    assert wh.whiten(frame(spark, [(i, [1.0, 2.0]) for i in range(50)])).count() == 0
    got = wh.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])).collect()
    assert [r.component for r in got] == [1, 1] and sorted(r.whitened for r in got) == pytest.approx([-1, 1])
