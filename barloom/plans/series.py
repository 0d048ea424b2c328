"""Numbers of one day's ordered series that would need all pairs of its values otherwise: n log n steps each, or little more."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql.functions import arrow_udf

#: Pairs drawn to bracket a slope, and the count of bracketed pairs, in multiples of n, that are then listed.
DRAWN, LISTED = 2048, 16


def over_lists(number: Callable):
    """A column function of an array of array columns: number of each row's arrays, as numpy vectors."""

    def run(lists: pa.Array) -> pa.Array:
        inner = lists.flatten()
        size, many = np.asarray(inner.value_lengths()), len(inner) // max(len(lists), 1)
        flat, at = np.asarray(inner.flatten(), np.float64), np.concatenate([[0], np.cumsum(size)])
        found = [number(*[flat[at[j] : at[j + 1]] for j in range(k * many, (k + 1) * many)]) for k in range(len(lists))]
        return pa.array([None if f is None or f != f else float(f) for f in found], pa.float64())

    return arrow_udf(run, "double")


# --- order statistics of all distances


def _within(x: np.ndarray, far: float) -> np.ndarray:
    """For each i of ascending x: how many j > i have x[j] - x[i] <= far, by one binary search for all."""
    n = len(x)
    lo, hi = np.arange(n), np.full(n, n - 1)  # x[lo] is within, all beyond hi is not
    while (lo < hi).any():
        mid = (lo + hi + 1) // 2
        near = x[mid] - x <= far
        lo, hi = np.where(near, mid, lo), np.where(near, hi, mid - 1)
    return lo - np.arange(n)


def nth_distances(x: np.ndarray, k: int) -> tuple[float, float]:
    """The k-th and the next least (from 0) of x[j] - x[i], i < j, for ascending x, by weighted medians of the rows' medians.

    Once few pairs are left they are listed. The next one is the first again where there is none.
    """
    n = len(x)
    rows = np.arange(n)
    left, right = rows + 1, np.full(n, n)  # row i's candidates are j in [left, right)
    while True:
        size = np.maximum(right - left, 0)
        if size.sum() <= 4 * n:
            i = np.repeat(rows, size)
            j = np.arange(len(i)) - np.repeat(np.cumsum(size) - size - left, size)
            rank = k - int((left - rows - 1).sum())
            found = float(np.partition(x[j] - x[i], rank)[rank])
            return found, _after(x, found, _within(x, found), k)
        open_ = np.flatnonzero(size)
        mid = (left[open_] + right[open_]) // 2
        values, weight = x[mid] - x[open_], right[open_] - left[open_]
        order = np.argsort(values, kind="stable")
        half = np.searchsorted(np.cumsum(weight[order]), weight.sum() / 2)
        guess = float(values[order[min(half, len(order) - 1)]])
        upto = _within(x, guess)
        if k >= upto.sum():
            left = np.maximum(left, rows + 1 + upto)
            continue
        below = _within(x, np.nextafter(guess, -np.inf))
        if below.sum() <= k:
            return guess, _after(x, guess, upto, k)
        right = np.minimum(right, rows + 1 + below)


def _after(x: np.ndarray, value: float, upto: np.ndarray, k: int) -> float:
    """The distance of rank k + 1, where value has rank k and each row has upto distances of at most value."""
    if upto.sum() > k + 1:
        return value
    first = np.arange(len(x)) + 1 + upto
    some = first < len(x)
    return float((x[first[some]] - x[some]).min()) if some.any() else value


def between(a: float, b: float, part: float) -> float:
    """The value part of the way from a to b."""
    return a + (b - a) * part


def distance_quantile(x: np.ndarray, share: float) -> float | None:
    """Percentile by linear interpolation of |x[j] - x[i]| over all pairs."""
    x = np.sort(x)
    pairs = len(x) * (len(x) - 1) // 2
    if not pairs:
        return None
    at = share * (pairs - 1)
    k = int(at)
    return between(*nth_distances(x, k), at - k)


# --- order statistics of all slopes


def inversions(rank: np.ndarray) -> int:
    """Pairs i < j with rank[j] <= rank[i], for whole numbers below 2^31, by merging blocks of doubling length."""
    n, total, width = len(rank), 0, 1
    size = 1 << max(n - 1, 0).bit_length()
    padded = np.concatenate([rank.astype(np.int64), np.full(size - n, 1 << 31)])
    while width < size:
        block = np.arange(size) // width
        left = (block & 1) == 0
        base = (block >> 1) << 32
        # blocks are sorted, so the keys of all left blocks ascend together
        lefts, rights = (base + padded)[left], (base + padded)[~left]
        less = np.searchsorted(lefts, rights, "left") - (np.arange(len(rights)) // width) * width
        total += int((width - less)[padded[~left] < 1 << 31].sum())
        padded = np.sort(padded.reshape(-1, 2 * width), axis=1).ravel()
        width *= 2
    return total


def _ranks(z: np.ndarray) -> np.ndarray:
    return np.unique(z, return_inverse=True)[1]


def _flips(y: np.ndarray, x: np.ndarray, lo: float, hi: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs i < j with a slope in (lo, hi]: those whose order by y - slope * x differs between the two slopes."""
    index = np.arange(len(y))
    first = np.lexsort((-index, y - lo * x)) if np.isfinite(lo) else index
    then = np.lexsort((-index, y - hi * x)) if np.isfinite(hi) else index[::-1]
    place = np.empty(len(y), np.int64)
    place[first] = index
    seq = place[then]
    # an element moves past no more others than lie between its two places and theirs
    reach = 2 * int(np.abs(seq - index).max(initial=0))
    pairs = [(then[:-d][hit], then[d:][hit]) for d in range(1, min(reach, len(seq) - 1) + 1) if (hit := seq[:-d] > seq[d:]).any()]
    if not pairs:
        return index[:0], index[:0]
    a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    return np.minimum(a, b), np.maximum(a, b)


def median_slope(y: np.ndarray, x: np.ndarray) -> float | None:
    """Median of (y[j] - y[i]) / (x[j] - x[i]) over pairs with different x.

    Pairs with at most a given slope s are inversions of y - s * x in the order of x. Slopes of pairs drawn at random bracket the
    middle ranks; once few pairs lie in the bracket they are listed.
    """
    order = np.lexsort((y, x))
    y, x = y[order], x[order]
    n = len(x)
    # of pairs with one x, those with one y too count as inversions at any slope
    ties = lambda *keys: int(sum(c * (c - 1) // 2 for c in np.unique(np.stack(keys), axis=1, return_counts=True)[1].tolist()))
    same = ties(x, y) if n else 0
    pairs = n * (n - 1) // 2 - (ties(x) if n else 0)
    if pairs <= 0:
        return None
    rng = np.random.default_rng(0)
    upto = lambda s: inversions(_ranks(y - s * x)) - same
    slope = lambda i, j: (y[j] - y[i]) / (x[j] - x[i])

    def nth(k: int, many: int) -> list[float]:
        """The slopes of ranks k to k + many - 1."""
        lo, hi, below, known = -np.inf, np.inf, 0, pairs  # slopes in (lo, hi] have ranks below .. known - 1
        for _ in range(32):
            if known - below <= LISTED * n:
                break
            i, j = rng.integers(0, n, DRAWN), rng.integers(0, n, DRAWN)
            i, j = np.minimum(i, j), np.maximum(i, j)
            drawn = slope(i[x[i] < x[j]], j[x[i] < x[j]])
            drawn = np.sort(drawn[(drawn > lo) & (drawn <= hi)])
            if not len(drawn):
                break
            at, wide = (k - below) / (known - below) * len(drawn), 2 * np.sqrt(len(drawn))
            for guess in drawn[np.clip([int(at - wide), int(at + wide)], 0, len(drawn) - 1)].tolist():
                count = upto(guess)
                if count >= k + many and guess < hi:
                    hi, known = guess, count
                elif count <= k and guess > lo:
                    lo, below = guess, count
        i, j = _flips(y, x, lo, hi)
        apart = x[i] < x[j]
        found = slope(i[apart], j[apart])
        ranks = list(range(k - below, k - below + many))
        return np.partition(found, ranks)[ranks].tolist()

    return sum(nth((pairs - 1) // 2, 2 - pairs % 2)) / (2 - pairs % 2)


# --- counts of alike stretches


def _alike(a: np.ndarray, tol: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs p < q with |a[p] - a[q]| <= tol that also match at the next place, and of these which match at the one after.

    Sorted by the first value, partners are a moving range. Gives p, q, and for stretches of three p, q.
    """
    order = np.argsort(a, kind="stable")
    sorted_ = a[order]
    first, second = [], []
    for d in range(1, len(a)):
        near = np.flatnonzero(sorted_[d:] - sorted_[:-d] <= tol)
        if not len(near):
            break
        p, q = order[near], order[near + d]
        p, q = np.minimum(p, q), np.maximum(p, q)
        both = q + 1 < len(a)
        p, q = p[both], q[both]
        match = np.abs(a[p + 1] - a[q + 1]) <= tol
        first.append(p[match])
        second.append(q[match])
    p, q = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (first, second))
    three = np.flatnonzero(q + 2 < len(a))
    three = three[np.abs(a[p[three] + 2] - a[q[three] + 2]) <= tol]
    return p, q, p[three], q[three]


def _tolerance(a: np.ndarray) -> float:
    return 0.2 * float(a.std()) if len(a) >= 6 else 0.0


def approximate_entropy(a: np.ndarray) -> float | None:
    """ApEn of stretches of two and three values within 0.2 deviations; each stretch is like itself."""
    n, tol = len(a), _tolerance(a)
    if tol <= 0:
        return None
    p2, q2, p3, q3 = _alike(a, tol)
    mean = lambda p, q, m: float(np.log((1 + np.bincount(p, minlength=m) + np.bincount(q, minlength=m)) / m).mean())
    return mean(p2, q2, n - 1) - mean(p3, q3, n - 2)


def sample_entropy(a: np.ndarray) -> float | None:
    """-ln of the share of alike stretches of two that stay alike at the third, the earlier one ending before the last place."""
    n, tol = len(a), _tolerance(a)
    if tol <= 0:
        return None
    p2, _, p3, _ = _alike(a, tol)
    two, three = int((p2 < n - 2).sum()), int((p3 < n - 3).sum())
    return -float(np.log(three / two)) if two and three else None


# --- spectra


def _power(e: np.ndarray) -> np.ndarray | None:
    """Shares of the power at frequencies 1 to half the length; None if there is none. The transform takes n log n steps at any length."""
    power = np.abs(np.fft.rfft(e)[1:]) ** 2
    total = power.sum()
    return power / total if total > 1e-16 else None


def spectral_entropy(e: np.ndarray) -> float | None:
    p = _power(e)
    if p is None or len(p) < 2 or (p > 0).sum() < 2:
        return None
    p = p[p > 0]
    return min(max(-float((p * np.log(p)).sum()) / float(np.log(len(e) // 2)), 0.0), 1.0)


def low_share(e: np.ndarray) -> float | None:
    p = _power(e)
    return None if p is None else float(p[: max(1, len(p) // 10)].sum())
