"""Features against numbers worked out by hand in numpy, and edge cases of small days."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from barloom.operators.catalog import features
from barloom.plans.feature import one
from barloom.plans.frame import Add

DAY = dt.date(2024, 3, 4)
KNOWN = features()


def day(closes, symbol="A", start=34200, step=60, **more):
    n = len(closes)
    c = np.array(closes, float)
    sod = start + step * np.arange(n, dtype=float)
    frame = {
        "date": [DAY] * n, "symbol": [symbol] * n, "time": [dt.datetime(2024, 3, 4) + dt.timedelta(seconds=float(s)) for s in sod], "tie": np.arange(n), "sod": sod, "mt": (sod - 34200) / 60, "tau": (sod - 34200) / 23340,
        "o": c - 0.1, "h": c + 0.3, "l": c - 0.4, "c": c, "v": np.arange(n) % 5 + 1.0, "n": np.arange(n) % 3 + 1.0, "vw": c + 0.05 * (-1.0) ** np.arange(n),
    }
    return pd.DataFrame(frame | more)


RNG = np.random.default_rng(7)
WALK = np.round(100 * np.exp(np.cumsum(RNG.normal(0, 0.002, 120))), 3)


def value(spark, name, pdf, symbols=("A",)):
    f = KNOWN[name]
    sample = spark.createDataFrame([(DAY, s) for s in symbols], "date date, symbol string")
    schema = "date date, symbol string, time timestamp_ntz, tie long, sod double, mt double, tau double, o double, h double, l double, c double, v double, n double, vw double"
    rows = [tuple(None if isinstance(x, float) and np.isnan(x) else x for x in r) for r in pdf.itertuples(index=False)]
    got = one(f, spark.createDataFrame([(r[0], r[1], r[2].to_pydatetime(), *r[3:]) for r in rows], schema), sample).toPandas().set_index("symbol").value
    return got if len(symbols) > 1 else got["A"]


def _haar(e):
    for _ in range(3):
        e = np.append(e, e[-1]) if len(e) % 2 else e
        e = (e[::2] + e[1::2]) / np.sqrt(2)
    return e


def _detrended(c):
    t = np.linspace(0, 1, len(c))
    return c - np.polyval(np.polyfit(t, c, 1), t)


def _lz(bits):
    i = c = 0
    while i < len(bits):
        k = 1
        while i + k <= len(bits) and bits[i : i + k] in bits[:i]:
            k += 1
        c, i = c + 1, i + k
    return c / (len(bits) / np.log2(len(bits)))


def _turns(c, th=0.001):
    way, ext, ref, n = 0, c[0], c[0], 0
    for x in c[1:]:
        up, down = x >= ref * (1 + th), x <= ref * (1 - th)
        if way == 0:
            if up or down:
                way, ext, n = (1 if up else -1), x, n + 1
        elif way * (x - ext) > 0:
            ext = x
        elif (way == 1 and x <= ext * (1 - th)) or (way == -1 and x >= ext * (1 + th)):
            way, ext, n = -way, x, n + 1
    return n


def _power(c):
    return np.abs(np.fft.rfft(_detrended(c))[1:]) ** 2


R = np.diff(np.log(WALK))
S = WALK[1:] / WALK[:-1] - 1
V = np.arange(120) % 5 + 1.0
EXPECTED = {
    "rv_logret": (R**2).sum(),
    "std_ret": S.std(ddof=1),
    "ac1_absret": np.corrcoef(abs(R[1:]), abs(R[:-1]))[0, 1],
    "corr_ret_volume": np.corrcoef(R, V[1:])[0, 1],
    "iqr_logret": np.quantile(R, 0.75) - np.quantile(R, 0.25),
    "trend_slope_close_time": np.polyfit(np.arange(120), WALK, 1)[0],
    "trend_quad_beta1": np.polyfit(np.linspace(0, 1, 120), WALK, 2)[1],
    "trend_quad_beta2": np.polyfit(np.linspace(0, 1, 120), WALK, 2)[0],
    "intraday_max_drawdown_close": 1 - (WALK / np.maximum.accumulate(WALK)).min(),
    "run_count_total": 1 + (np.sign(R[R != 0])[1:] != np.sign(R[R != 0])[:-1]).sum(),
    "variance_ratio_q5": np.convolve(R, np.ones(5), "valid").var(ddof=1) / (5 * R.var(ddof=1)),
    "theil_sen_slope_close_time": np.median([(WALK[j] - WALK[i]) / (j - i) for i in range(120) for j in range(i + 1, 120)]),
    "qn_vol_logret": 2.2219 * np.quantile([abs(R[i] - R[j]) for i in range(119) for j in range(i + 1, 119)], 0.25),
    "wavelet_energy_lowfreq_share": (_haar(_detrended(WALK)) ** 2).sum() / (_detrended(WALK) ** 2).sum(),
    "spectral_lowfreq_share_close": _power(WALK)[:6].sum() / _power(WALK).sum(),
    "lz_complexity_signret": _lz("".join("1" if r > 0 else "0" for r in R if r != 0)),
    "dc_count_bps_10": _turns(WALK),
    "volume_hhi": ((V / V.sum()) ** 2).sum(),
    "rvol_logret": np.sqrt((R**2).sum()),
    "clv_session": ((WALK[-1] - (WALK.min() - 0.4)) - ((WALK.max() + 0.3) - WALK[-1])) / (WALK.max() - WALK.min() + 0.7),
}


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_against_numpy(spark, name):
    assert value(spark, name, day(WALK)) == pytest.approx(EXPECTED[name], rel=1e-8)


def test_sample_is_the_left_side(spark):
    got = value(spark, "twap", pd.concat([day([1, 2, 3]), day([5, 5], "B")]), ("A", "ZZZ"))
    assert got["A"] == 2 and np.isnan(got["ZZZ"]) and "B" not in got.index


@pytest.mark.parametrize("name", ["rv_logret", "corr_close_volume", "trend_slope_tstat", "ret_skew", "gini_absret", "vwap_cross_count", "spectral_entropy_close", "katz_fd_close"])
@pytest.mark.parametrize("closes", [[100.0], [100.0, 100.0], [100.0] * 12])
def test_little_or_constant_days_have_no_failure(spark, name, closes):
    got = value(spark, name, day(closes, vw=np.array(closes)))
    assert got is None or np.isnan(got) or got == 0


def test_session_ends_are_inclusive(spark):
    pdf = day([1.0, 2.0, 3.0, 4.0], start=34140, step=60)  # 09:29 to 09:32
    assert value(spark, "twap", pdf) == 3
    late = day([1.0, 2.0, 3.0], start=57480, step=60)  # 15:58 to 16:00
    assert value(spark, "twap", late) == 1.5


def test_nulls_leave_the_frame(spark):
    pdf = day([1.0, 2.0, np.nan, 4.0])
    assert value(spark, "total_variation_close", pdf) == 3
    assert value(spark, "twap", pdf) == pytest.approx(7 / 3)


def test_names_that_mislead(spark):
    pdf = day(WALK)
    assert value(spark, "absret_peak_time_min", pdf) == value(spark, "absret_peak_time_frac", pdf) <= 1
    assert value(spark, "close_to_open_ret", pdf) == pytest.approx((WALK[0] - 0.1) / WALK[-1] - 1)


def _apen(a):
    tol = 0.2 * a.std()

    def phi(m):
        x = np.array([a[k : k + m] for k in range(len(a) - m + 1)])
        return np.log((np.abs(x[:, None] - x[None]).max(2) <= tol).mean(1)).mean()

    return phi(2) - phi(3)


@pytest.mark.parametrize("n", range(1, 12))
def test_entropy_needs_more_than_five_returns(spark, n):
    closes = WALK[: n + 1]
    got, a = value(spark, "approx_entropy_absret_m2_r02", day(closes)), np.abs(np.diff(np.log(closes)))
    assert pd.isna(got) if n < 6 else got == pytest.approx(_apen(a), abs=1e-9)


@pytest.mark.parametrize("seed", range(4))
def test_conditional_variance_drops_rows_without_a_log(spark, seed):
    closes = np.array(WALK[seed * 20 : seed * 20 + 15])
    closes[[3, 4, 9][: seed]] = [0.0, -2.0, -1.0][: seed]
    with np.errstate(all="ignore"):
        lr, s = np.diff(np.log(closes)), closes[1:] / closes[:-1] - 1
    for name, side in (("rv_cond_up", s > 0), ("rv_cond_down", s < 0)):
        assert value(spark, name, day(closes)) == pytest.approx(np.sum(lr[side & np.isfinite(lr)] ** 2), rel=1e-9)


def test_no_window_shrinks_row_by_row():
    """A frame that ends at the day's last row is summed up anew for each row: the square of a day's rows."""
    steps = [(f.name, e) for f in KNOWN.values() for step in f.frame if isinstance(step, Add) for _, e in step.cols]
    assert [name for name, e in steps if "UNBOUNDED FOLLOWING" in e] == []


def test_calm_time_of_a_long_day(spark):
    closes = 100 + np.round(np.random.default_rng(5).normal(0, 1, 3000), 2)
    r = np.diff(np.log(closes))
    a = abs(r)
    calm = np.flatnonzero(a <= np.median(a))
    shocks = np.flatnonzero(a >= np.quantile(a, 0.9))
    after = np.searchsorted(calm, shocks, "right")
    waits = [calm[j] - k for k, j in zip(shocks, after, strict=True) if j < len(calm)]
    assert value(spark, "shock_calm_time_median_q50", day(closes, step=5)) == np.median(waits)


def test_average_of_a_day_of_very_many_bars(spark):
    """Powers of the decay leave the range of a double after some 7040 bars."""
    closes = 100 + np.cumsum(np.round(np.random.default_rng(11).normal(0, 0.05, 9000), 2))
    closes[7500:] = np.repeat(closes[7500:7750], 6)
    moves = np.sign(np.diff(closes))
    averages = np.sign(pd.Series(closes).ewm(span=20, adjust=False).mean().diff().to_numpy()[1:])
    both = (moves != 0) & (averages != 0)
    assert value(spark, "ema20_trend_align_share", day(closes, step=2)) == pytest.approx((moves == averages)[both].mean(), rel=1e-12)
