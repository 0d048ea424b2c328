"""Numbers of ordered series against all pairs, with ties, short and long series."""

import numpy as np
import pytest

from barloom.plans import series


def shapes(n):
    rng = np.random.default_rng(n)
    return [rng.normal(size=n), rng.integers(0, 4, n) * 0.1, np.round(rng.normal(size=n), 1), np.zeros(n), np.repeat(1.5, n) + (np.arange(n) == n // 2)]


SIZES = [1, 2, 3, 4, 5, 7, 8, 20, 61, 200, 401]


@pytest.mark.parametrize("n", SIZES)
def test_quantile_of_distances(n):
    for x in shapes(n):
        pairs = np.abs(x[:, None] - x[None])[np.triu_indices(n, 1)]
        for share in (0.25, 0.0, 0.5, 1.0):
            got = series.distance_quantile(x, share)
            assert got is None if n < 2 else got == pytest.approx(np.percentile(pairs, 100 * share), rel=1e-12, abs=1e-15)


@pytest.mark.parametrize("n", SIZES)
def test_median_slope(n):
    rng = np.random.default_rng(n)
    for y in shapes(n):
        for x in (np.arange(n) * 1.0, np.sort(rng.integers(0, max(2, n), n)) / 60):
            i, j = np.triu_indices(n, 1)
            ok = x[i] != x[j]
            got = series.median_slope(y, x)
            assert got is None if not ok.any() else got == pytest.approx(np.median((y[j] - y[i])[ok] / (x[j] - x[i])[ok]), rel=1e-11, abs=1e-12)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 9, 64, 100])
def test_inversions(n):
    for x in shapes(n) if n else [np.zeros(0)]:
        ranks = np.unique(x, return_inverse=True)[1]
        assert series.inversions(ranks) == sum(int((ranks[k + 1 :] <= ranks[k]).sum()) for k in range(n))


@pytest.mark.parametrize("n", range(1, 200, 13))
def test_entropies(n):
    for x in shapes(n):
        a = np.abs(x)
        tol = 0.2 * a.std()
        if n < 6 or tol <= 0:
            assert series.approximate_entropy(a) is None and series.sample_entropy(a) is None
            continue

        def near(m, a=a, tol=tol):
            w = np.array([a[k : k + m] for k in range(len(a) - m + 1)])
            return np.abs(w[:, None] - w[None]).max(2) <= tol

        phi = lambda m: np.log(near(m).mean(1)).mean()
        assert series.approximate_entropy(a) == pytest.approx(phi(2) - phi(3), abs=1e-10)
        two, three = np.triu(near(2), 1)[: n - 2].sum(), np.triu(near(3), 1)[: n - 3].sum()
        got = series.sample_entropy(a)
        assert got is None if not (two and three) else got == pytest.approx(-np.log(three / two))


@pytest.mark.parametrize("n", [8, 9, 13, 97, 390])
def test_spectra(n):
    e = np.random.default_rng(n).normal(size=n)
    k = np.arange(1, n // 2 + 1)
    power = np.abs(np.exp(-2j * np.pi * np.outer(k, np.arange(n)) / n) @ e) ** 2
    p = power / power.sum()
    assert series.spectral_entropy(e) == pytest.approx(-(p * np.log(p)).sum() / np.log(n // 2), abs=1e-9)
    assert series.low_share(e) == pytest.approx(p[: max(1, len(p) // 10)].sum(), abs=1e-9)
