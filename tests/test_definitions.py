"""Bar features against plain pandas definitions, over small and odd days: few bars, constants, zeros, ties, nulls, whole sessions."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from barloom.operators.catalog import features
from barloom.plans.engine import deal, feature_table

DAY = dt.date(2024, 3, 4)
NAN = float("nan")


def bars(closes, minutes=None, v=None, n=None, vw=None, o=None, h=None, l=None):  # noqa: E741
    c = np.array(closes, float)
    k = len(c)
    m = np.arange(k) if minutes is None else np.array(minutes)
    base = np.nan_to_num(c, nan=50.0)
    g = pd.DataFrame({"m": m.astype(float), "c": c})
    g["o"] = base - 0.1 * (np.arange(k) % 3 - 1) if o is None else o
    g["h"] = np.maximum(base, g.o) + 0.05 * (np.arange(k) % 4) if h is None else h
    g["l"] = np.minimum(base, g.o) - 0.05 * (np.arange(k) % 5) if l is None else l
    g["v"] = (np.arange(k) * 7 % 11 + 1.0) if v is None else np.array(v, float)
    g["n"] = (np.arange(k) * 5 % 7 + 1.0) if n is None else np.array(n, float)
    g["vw"] = base + 0.03 * (-1.0) ** np.arange(k) * (np.arange(k) % 3) if vw is None else np.array(vw, float)
    return g


def days():
    rng = np.random.default_rng(11)
    walk = np.round(100 * np.exp(np.cumsum(rng.normal(0, 0.004, 400))), 2)
    out = {f"n{k:02d}": bars(walk[k : 2 * k]) for k in range(1, 13)}
    out |= {
        "walk": bars(walk[:60]),
        "session": bars(walk[:390]),
        "sparse": bars(walk[:390:5], minutes=np.arange(0, 390, 5)),
        "constant": bars([80.0] * 12),
        "zeros": bars(np.repeat([10, 10, 11, 11, 11, 10, 12, 12], 3)),
        "up": bars(np.linspace(10, 15, 21) ** 2),
        "down": bars(np.linspace(15, 10, 21) ** 2, minutes=np.arange(21) * 18),
        "zigzag": bars([10, 11] * 12, minutes=np.arange(24) * 16),
        "nulls": bars([NAN if k % 4 == 1 else x for k, x in enumerate(walk[:30])]),
        "novolume": bars(walk[:15], v=np.zeros(15), n=np.zeros(15)),
        "somevolume": bars(walk[:25], v=np.arange(25) % 3, n=np.arange(25) % 2),
        "nullvolume": bars(walk[:25], v=[NAN if k % 3 == 0 else k for k in range(25)]),
        "flatbars": bars(walk[:14], o=walk[:14], h=walk[:14], l=walk[:14]),
        "morning": bars(walk[:26]),
        "late": bars(walk[:40], minutes=np.arange(350, 390)),
    }
    return out


DAYS = days()


# --- the helpers of the definitions


def use(g, cols, keep=None):
    g = g.dropna(subset=list({"c": "c", "o": "o", "h": "h", "l": "l", "v": "v", "n": "n", "w": "vw"}[x] for x in cols)).reset_index(drop=True)
    if keep is not None:
        g = g[keep(g)].reset_index(drop=True)
    with np.errstate(all="ignore"):
        g["r"] = np.log(g.c).diff().replace([np.inf, -np.inf], np.nan)
        g["s"] = g.c.pct_change(fill_method=None).replace([np.inf, -np.inf], np.nan)
    return g


def ret(g, cols="c", kind="r", keep=None):
    return use(g, cols, keep).dropna(subset=[kind])


def corr(x, y, least=2):
    x, y = np.asarray(x, float), np.asarray(y, float)
    ok = np.isfinite(x) & np.isfinite(y)
    x, y = x[ok], y[ok]
    return np.corrcoef(x, y)[0, 1] if len(x) >= least and np.ptp(x) > 0 and np.ptp(y) > 0 else NAN


def slope(x, y, least=2):
    x, y = np.asarray(x, float), np.asarray(y, float)
    ok = np.isfinite(x) & np.isfinite(y)
    x, y = x[ok], y[ok]
    return np.polyfit(x - x.mean(), y, 1)[0] if len(x) >= least and np.ptp(x) > 0 else NAN


def ratio(a, b):
    return a / b if b else NAN


def sd(x):
    return np.std(x, ddof=1) if len(x) > 1 else NAN


def runs(x):
    x = np.asarray(x)
    return [len(p) for p in np.split(x, np.flatnonzero(np.diff(x)) + 1)] if len(x) else []


def gini(x):
    x = np.sort(np.asarray(x, float))
    n = len(x)
    return NAN if n < 2 or x.sum() <= 0 else min(1, max(0, 1 - 2 * ((n - np.arange(1, n + 1) + 0.5) * x).sum() / (n * x.sum())))


def positive(g):
    return g.c > 0


def lagged(x, k=1):
    return np.asarray(x[k:], float), np.asarray(x[:-k] if k else x, float)


def bpv(r):
    a = np.abs(r)
    return np.pi / 2 * (a[1:] * a[:-1]).sum()


def hi_lo(g):
    return g.h.max(), g.l.min(), g.c.iloc[-1]


def compaction(x, share):
    x = np.sort(x)[::-1]
    return NAN if not len(x) or x.sum() <= 0 else (np.argmax(np.cumsum(x) >= share * x.sum()) + 1) / len(x)


def front(x, tau):
    x, tau = np.asarray(x, float), np.asarray(tau, float)
    if not len(x) or x.sum() <= 0:
        return NAN
    y = np.cumsum(x) / x.sum()
    t, y = np.concatenate([[0], tau, [1]]), np.concatenate([[0], y, [1]])
    return 2 * ((y[1:] + y[:-1]) / 2 * np.diff(t)).sum() - 1


def entropy(p):
    p = p[p > 0]
    return -(p * np.log(p)).sum()


DEFINED = {}


def define(name, cols="c", kind=None, keep=None, least=1):
    """A definition on the rows that cols and kind (r, s or neither) leave; null under so many rows."""

    def wrap(f):
        def run(g):
            g = ret(g, cols, kind, keep) if kind else use(g, cols, keep)
            if len(g) < least:
                return NAN
            with np.errstate(all="ignore"):
                return f(g.reset_index(drop=True))

        DEFINED[name] = run
        return f

    return wrap


def plain(name, f, cols="c", kind=None, keep=None, least=1):
    define(name, cols, kind, keep, least)(f)


both = lambda g: (g.vw > 0) & (g.v > 0)
plain("absret_center_of_mass_time", lambda g: np.clip(ratio((g.m / 389 * g.r.abs()).sum(), g.r.abs().sum()), 0, 1), kind="r", least=3)
plain("absret_compaction_80pct_bars_frac", lambda g: compaction(g.r.abs().values, 0.8), "", "r")
plain("absret_on_sqrtn_beta", lambda g: slope(np.sqrt(g.n), g.r.abs(), 3), "cn", "r")
plain("absret_peak_time_frac", lambda g: g.m[g.s.abs().idxmax()] / 389, kind="s")
plain("absret_per_volume", lambda g: ratio(g.r.abs().sum(), g.v.sum()), "cv", least=2)
plain("ac1_absret", lambda g: corr(*lagged(g.r.abs())), kind="r", keep=positive, least=3)
plain("ac1_n", lambda g: corr(*lagged(g.n)), "n", least=3)
plain("ac1_ret2", lambda g: corr(*lagged(g.r**2)), kind="r", keep=positive, least=3)
plain("ac1_volume", lambda g: corr(*lagged(g.v)), "v", least=3)
plain("ac_ret_lag2", lambda g: ratio(((g.r - g.r.mean())[2:].values * (g.r - g.r.mean())[:-2].values).sum(), ((g.r - g.r.mean()) ** 2).sum()) if np.ptp(g.r) > 0 else NAN, kind="r", least=4)
plain("accel_over_vel_std_ratio", lambda g: ratio(sd(np.diff(g.c, 2)), sd(np.diff(g.c))) if sd(np.diff(g.c)) > 1e-12 else NAN, least=4)
plain("avg_trade_size", lambda g: ratio(g.v.sum(), g.n.sum()), "vn")
plain("bars_to_50pct_volume_time_frac", lambda g: (np.argmax(g.v.cumsum() >= 0.5 * g.v.sum()) + 1) / len(g) if g.v.sum() > 0 else NAN, "v")
plain("bpv_logret", lambda g: bpv(g.r.values), kind="r", keep=positive, least=2)
plain("bpv_to_rv_ratio", lambda g: ratio(bpv(g.r.values), (g.r**2).sum()), kind="r", least=3)
plain("jump_var_bns", lambda g: max((g.r**2).sum() - bpv(g.r.values), 0), kind="r", keep=positive, least=2)
plain("close_15m_absret_share", lambda g: ratio(g.s[g.m >= 374].abs().sum(), g.s.abs().sum()), kind="s")
plain("close_15m_volume_share", lambda g: ratio(g.v[g.m >= 374].sum(), g.v.sum()), "v")
plain("close_on_logn_beta", lambda g: slope(np.log(g.n), g.c), "cn", keep=lambda g: g.n > 0)
plain("close_on_logvolume_beta", lambda g: slope(np.log(g.v), g.c), "cv", keep=lambda g: g.v > 0)
plain("close_on_n_beta", lambda g: slope(g.n, g.c), "cn")
plain("close_on_volume_beta", lambda g: slope(g.v, g.c), "cv")
plain("close_on_vwap_beta", lambda g: slope(g.vw, g.c), "cw")
plain("diff_close_vwap_on_n_beta", lambda g: slope(g.n, g.c - g.vw), "cwn")
plain("diff_close_vwap_on_volume_beta", lambda g: slope(g.v, g.c - g.vw), "cwv")
plain("diff_close_vwap_trend_slope", lambda g: slope(g.m, g.c - g.vw), "cw")
plain("trend_slope_close_time", lambda g: slope(g.m, g.c), "c")
plain("clv_session", lambda g: ratio(2 * g.c.iloc[-1] - g.h.max() - g.l.min(), g.h.max() - g.l.min()), "hlc")
plain("close_to_edge_distance_frac", lambda g: ratio(min(g.c.iloc[-1] - g.l.min(), g.h.max() - g.c.iloc[-1]), g.h.max() - g.l.min()), "hlc")
plain("end_position_in_range", lambda g: ratio(g.c.iloc[-1] - g.l.min(), g.h.max() - g.l.min()), "hlc")
plain("close_to_open_ret", lambda g: g.o.iloc[0] / g.c.iloc[-1] - 1, "oc")
plain("open_to_close_ret", lambda g: g.c.iloc[-1] / g.o.iloc[0] - 1, "oc")
plain("corr_absret_n", lambda g: corr(g.r.abs(), g.n), "cn", "r", positive)
plain("corr_absret_volume", lambda g: corr(g.r.abs(), g.v), "cv", "r", positive)
plain("corr_close_n", lambda g: corr(g.c, g.n), "cn")
plain("corr_close_volume", lambda g: corr(g.c, g.v), "cv")
plain("corr_close_vwap", lambda g: corr(g.c, g.vw, 3), "cw")
plain("corr_ret2_volume", lambda g: corr(g.r**2, g.v), "cv", "r", positive)
plain("corr_ret_absnextret", lambda g: corr(g.s[:-1], g.s.abs()[1:], 3), kind="s", least=2)
plain("corr_ret_n", lambda g: corr(g.r, g.n, 3), "cn", "r")
plain("corr_ret_volume", lambda g: corr(g.r, g.v, 3), "cv", "r")
plain("corr_signret_volume", lambda g: corr(np.sign(g.r), g.v), "cv", "r")
plain("cv_close", lambda g: ratio(sd(g.c), g.c.mean()), least=2)
plain("cv_n", lambda g: sd(g.n) / g.n.mean() if g.n.mean() > 0 else NAN, "n", least=3)
plain("cv_volume", lambda g: sd(g.v) / g.v.mean() if g.v.mean() > 0 else NAN, "v", least=3)
plain("cv_trade_size", lambda g: sd(g.v / g.n) / (g.v / g.n).mean() if (g.v / g.n).mean() > 0 else NAN, "vn", keep=lambda g: g.n > 0, least=3)
plain("std_trade_size", lambda g: sd(g.v / g.n), "vn", keep=lambda g: g.n > 0, least=3)
plain("doji_density", lambda g: ((g.c - g.o).abs() <= 0.1 * (g.h - g.l)).mean(), "ohlc", keep=lambda g: g.h > g.l)
plain("lower_shadow_ratio_mean", lambda g: ((np.minimum(g.o, g.c) - g.l).clip(lower=0) / (g.h - g.l)).mean(), "ohlc", keep=lambda g: g.h > g.l)
plain("upper_shadow_ratio_mean", lambda g: ((g.h - np.maximum(g.o, g.c)).clip(lower=0) / (g.h - g.l)).mean(), "ohlc", keep=lambda g: g.h > g.l)
plain("mean_body_to_range", lambda g: ((g.c - g.o).abs() / (g.h - g.l)).mean(), "ohlc", keep=lambda g: g.h > g.l)
plain("candle_body_to_range_mean", lambda g: ((g.c - g.o).abs() / (g.h - g.l)).replace([np.inf], NAN).mean(), "ohlc")
plain("down_bar_share", lambda g: (g.s < 0).mean(), kind="s")
plain("up_bar_share", lambda g: (g.s > 0).mean(), kind="s")
plain("down_mean_absret", lambda g: g.s[g.s < 0].abs().mean(), kind="s")
plain("up_mean_absret", lambda g: g.s[g.s > 0].abs().mean(), kind="s")
plain("early_late_vol_ratio_30m", lambda g: ratio(sd(g.s[g.m < 30]), sd(g.s[g.m >= 359])) if (g.m < 30).sum() >= 3 and (g.m >= 359).sum() >= 3 else NAN, kind="s")
plain("endgame_drift_share_last60", lambda g: g.r[g.m >= 330].sum() / g.r.sum() if abs(g.r.sum()) >= 1e-12 else NAN, kind="r")
plain("ewma_rvol_logret_094", lambda g: np.sqrt(np.average(g.r**2, weights=0.94 ** np.arange(len(g))[::-1])), kind="r", least=3)
plain("gini_absret", lambda g: gini(g.r.abs()), kind="r")
plain("n_gini", lambda g: gini(g.n), "n", keep=lambda g: g.n >= 0)
plain("volume_gini", lambda g: gini(g.v), "v", keep=lambda g: g.v >= 0)
plain("impact_elasticity_log", lambda g: slope(np.log(g.v.where(g.v > 0)), np.log(g.r.abs().where(g.r != 0)), 8), "cv", "r")
plain("intraday_max_drawdown_close", lambda g: 1 - (g.c / g.c.cummax()).min() if (g.c > 0).all() else NAN, least=2)
plain("intraday_max_drawup_close", lambda g: max((g.c / g.c.cummin() - 1).max(), 0), least=2)
plain("iqr_logret", lambda g: np.subtract(*np.percentile(g.r, [75, 25])), "", "r")
plain("iqr_vol_logret", lambda g: 0.7413 * np.subtract(*np.percentile(g.r, [75, 25])), kind="r", keep=positive, least=3)
plain("jump_count_local_q95", lambda g: (g.r.abs() > np.percentile(g.r.abs(), 95)).sum(), kind="r", least=10)
plain("kyle_lambda_proxy", lambda g: slope(g.vw * g.v, g.r.abs(), 8), "cwv", "r")
plain("max_absret_value", lambda g: g.s.abs().max(), kind="s")
plain("max_down_run_len", lambda g: max([len(x) for x in "".join("d" if x < 0 else " " for x in g.s).split()], default=NAN), kind="s")
plain("max_up_run_len", lambda g: max([len(x) for x in "".join("u" if x > 0 else " " for x in g.s).split()], default=NAN), kind="s")
plain("mean_abs_vwap_gap", lambda g: (g.c - g.vw).abs().mean(), "cw")
plain("mean_close_vwap_rel_diff", lambda g: ((g.c - g.vw) / g.vw).mean(), "cw")
plain("mean_over_median_absret", lambda g: ratio(g.r.abs().mean(), g.r.abs().median()), kind="r", least=3)
plain("mean_volume_per_trade_down", lambda g: ratio(g.v[g.s < 0].sum(), g.n[g.s < 0].sum()), "cvn", "s")
plain("mean_volume_per_trade_up", lambda g: ratio(g.v[g.s > 0].sum(), g.n[g.s > 0].sum()), "cvn", "s")
plain("median_position_in_range", lambda g: ((g.c - g.l.min()) / (g.h.max() - g.l.min())).clip(0, 1).median() if g.h.max() > g.l.min() else NAN, "hlc")
plain("midday_lull_rv_ratio", lambda g: ratio((g.r[g.m.between(150, 209)] ** 2).sum() / (g.r**2).sum(), g.m.between(150, 209).mean()) if (g.r**2).sum() > 0 else NAN, kind="r", least=3)
plain("midday_volume_ratio", lambda g: g.v[g.m.between(150, 209)].mean() / g.v.mean() if g.v.mean() > 0 else NAN, "v")
plain("motif_ascending_share_m3_close", lambda g: ((np.diff(g.c)[1:] > 0) & (np.diff(g.c)[:-1] > 0)).sum() / (len(g) - 2), least=3)
plain("motif_zigzag_share_m3_close", lambda g: (np.diff(g.c)[1:] * np.diff(g.c)[:-1] < 0).sum() / (len(g) - 2), least=3)
plain("n_fano_factor", lambda g: np.var(g.n, ddof=1) / g.n.mean() if g.n.mean() > 0 else NAN, "n", least=2)
plain("n_burstiness", lambda g: (sd(g.n) - g.n.mean()) / (sd(g.n) + g.n.mean()) if g.n.mean() > 0 and sd(g.n) > 0 else NAN, "n", least=2)
plain("n_hhi", lambda g: ((g.n / g.n.sum()) ** 2).sum() if g.n.sum() > 0 else NAN, "n")
plain("volume_hhi", lambda g: ((g.v / g.v.sum()) ** 2).sum() if g.v.sum() > 0 else NAN, "v")
plain("n_front_loading_score", lambda g: np.clip(front(g.n, g.m / 389), -1, 1), "n")
plain("n_entropy_concentration", lambda g: np.clip(1 - entropy((g.n / g.n.sum()).values) / np.log((g.n > 0).sum()), 0, 1) if (g.n > 0).sum() >= 2 else NAN, "n")
plain("rv_logret", lambda g: (g.r**2).sum(), kind="r")
plain("rvol_logret", lambda g: np.sqrt((g.r**2).sum()), kind="r")
plain("std_close", lambda g: sd(g.c), least=2)
plain("std_volume", lambda g: sd(g.v), "v", least=3)
plain("std_n", lambda g: sd(g.n), "n", least=3)
plain("std_ret", lambda g: sd(g.s), kind="s", least=3)
plain("std_close_vwap_diff", lambda g: sd(g.c - g.vw), "cw", least=2)
plain("twap", lambda g: g.c.mean())
plain("total_variation_close", lambda g: np.abs(np.diff(g.c)).sum(), least=2)
plain("path_length_over_range", lambda g: ratio(np.abs(np.diff(g.c)).sum(), g.h.max() - g.l.min()), "hlc", least=2)
plain("run_count_total", lambda g: len(runs(np.sign(g.r[g.r != 0]))) or NAN, "", "r")
plain("mean_run_length_sign", lambda g: np.mean(runs(np.sign(g.s[g.s != 0]))) if (g.s != 0).sum() >= 2 else NAN, kind="s")
plain("share_in_runs_len_ge3", lambda g: sum(k for k in runs(np.sign(g.r[g.r != 0])) if k >= 3) / len(g), "", "r")
plain("zero_ret_share", lambda g: (g.r == 0).mean(), kind="r")
plain("volume_share_on_down", lambda g: ratio(g.v[g.s < 0].sum(), g.v.sum()), "cv", "s")
plain("volume_share_on_up", lambda g: ratio(g.v[g.s > 0].sum(), g.v.sum()), "cv", "s")
plain("volume_top3_share", lambda g: np.sort(g.v)[::-1][:3].sum() / g.v.sum() if g.v.sum() > 0 else NAN, "v")
plain("volume_median_to_mean_ratio", lambda g: g.v.median() / g.v.mean() if g.v.mean() > 0 else NAN, "v")
plain("spearman_close_volume", lambda g: corr(g.c.rank(), g.v.rank()), "cv", least=2)
plain("spearman_close_n", lambda g: corr(g.c.rank(), g.n.rank()), "cn", least=2)
plain("theil_sen_slope_close_time", lambda g: np.median([(g.c[j] - g.c[i]) / (g.m[j] - g.m[i]) for j in range(len(g)) for i in range(j)]) if len(g) > 1 else NAN)
plain("qn_vol_logret", lambda g: 2.2219 * np.percentile([abs(g.r[j] - g.r[i]) for j in range(len(g)) for i in range(j)], 25), kind="r", keep=positive, least=3)
plain("rv_compaction_50pct_bars_frac", lambda g: compaction((g.r**2).values, 0.5), "", "r", least=2)
plain("rv_compaction_80pct_bars_frac", lambda g: compaction((g.r**2).values, 0.8), "", "r", least=2)
plain("volume_compaction_80pct_bars_frac", lambda g: compaction(g.v.values, 0.8), "v")
plain("time_share_above_vwap", lambda g: (g.c > g.vw).mean(), "cw")
plain("vwap_cross_count", lambda g: (np.diff(np.sign(g.c - g.vw)[g.c != g.vw]) != 0).sum() if (g.c != g.vw).sum() >= 2 else NAN, "cw")

plain("range_per_trade", lambda g: (g.h.max() - g.l.min()) / g.n.sum() if g.h.max() > g.l.min() and g.n.sum() > 0 else NAN, "hln")
plain("range_up_down_ratio", lambda g: ratio((g.h - g.l)[g.s > 0].sum(), (g.h - g.l)[g.s < 0].sum()), "hlc", "s")
plain("ret_es_q05", lambda g: g.r[g.r <= np.percentile(g.r, 5)].mean(), kind="r", least=3)
plain("ret_var_q05", lambda g: np.percentile(g.r, 5), kind="r", least=3)
plain("ret_skew", lambda g: len(g) / ((len(g) - 1) * (len(g) - 2)) * ((g.r - g.r.mean()) ** 3).mean() / sd(g.r) ** 3 if np.ptp(g.r) > 0 else NAN, kind="r", keep=positive, least=3)
plain("ret_up_down_abs_magnitude_ratio", lambda g: ratio(g.r[g.r > 0].sum(), -g.r[g.r < 0].sum()), "", "r")
plain("return_contribution_top_quintile_by_volume", lambda g: ratio(g.r[g.v >= np.percentile(g.v, 80)].abs().sum(), g.r.abs().sum()), "cv", "r")
plain("rms_vwap_dev_rel", lambda g: np.sqrt((((g.c - g.vw) / g.vw) ** 2).mean()), "cw", keep=lambda g: g.vw > 0)
plain("std_vwap_dev_rel", lambda g: sd((g.c - g.vw) / g.vw), "cw", keep=lambda g: g.vw > 0, least=2)
plain("robust_vol_mad_ret", lambda g: 1.4826 * (g.r - g.r.median()).abs().median(), kind="r", keep=positive, least=2)
plain("roll_spread", lambda g: (lambda q: 2 * np.sqrt(-q) if q < 0 else NAN)(np.cov(np.diff(g.c)[1:], np.diff(g.c)[:-1])[0, 1]), least=4)
plain("rq_logret", lambda g: len(g) / 3 * (g.r**4).sum(), kind="r", keep=positive, least=2)
plain("rv_close_vwap_diff", lambda g: (np.diff(g.c - g.vw) ** 2).sum(), "cw", least=2)
plain("rv_cond_above_vwap", lambda g: (g.r[g.c > g.vw] ** 2).sum() if (g.c > g.vw).any() else NAN, "cw", "r")
plain("rv_cond_below_vwap", lambda g: (g.r[g.c <= g.vw] ** 2).sum() if (g.c <= g.vw).any() else NAN, "cw", "r")
plain("rv_entropy_concentration", lambda g: np.clip(1 - entropy((g.r**2 / (g.r**2).sum()).values) / np.log((g.r**2 > 0).sum()), 0, 1) if (g.r**2 > 0).sum() >= 2 else NAN, kind="r", least=3)
plain("rv_front_loading_score", lambda g: np.clip(front(g.r**2, g.m / 389), -1, 1), kind="r", least=3)
plain("volume_front_loading_score", lambda g: front(g.v, g.m / 389), "v", least=2)
plain("rv_gini_concentration", lambda g: ((2 * np.arange(1, len(g) + 1) - len(g) - 1) * np.sort(g.r**2)).sum() / (len(g) * (g.r**2).sum()) if (g.r**2).sum() > 0 else NAN, kind="r", keep=positive, least=2)
plain("rv_last15m_share", lambda g: ratio((g.r[g.m >= 375] ** 2).sum(), (g.r**2).sum()), kind="r", least=3)
plain("rv_last30m_share", lambda g: ratio((g.r[g.m >= 359] ** 2).sum(), (g.r**2).sum()), kind="r", keep=positive)
for _width in (5, 15, 30):
    plain(f"rv_logret_{_width}m", lambda g, w=_width: (np.diff(np.log(g.groupby(g.m // w).c.last())) ** 2).sum() if (g.m // w).nunique() >= 3 else NAN)
plain("rv_per_min_logret", lambda g: (g.r**2).sum() / 389, kind="r", keep=positive)
plain("rv_per_trade", lambda g: ratio((g.r**2).sum(), g.n.sum()), "cn", least=2)
plain("rv_per_volume", lambda g: (g.r**2).sum() / g.v.sum() if (g.r**2).sum() > 0 and g.v.sum() > 0 else NAN, "cv", least=4)
plain("rv_share_above_vwap", lambda g: ratio((g.r[g.c > g.vw] ** 2).sum(), (g.r**2).sum()), "cw", "r", positive)
plain("rvol_over_sqrt_trades", lambda g: np.sqrt((g.r**2).sum()) / np.sqrt(g.n.sum()) if (g.r**2).sum() > 0 and g.n.sum() > 0 else NAN, "cn", least=4)
plain("semivar_pos_over_neg", lambda g: ratio((g.r[g.r > 0] ** 2).sum(), (g.r[g.r < 0] ** 2).sum()), kind="r", keep=positive)


def within(g):
    return 3.5 * 1.4826 * (g.r - g.r.median()).abs().median()


plain("rv_truncated_logret_k35", lambda g: (g.r[g.r.abs() <= within(g)] ** 2).sum(), kind="r", least=3)
plain("rv_winsorized_logret_k35", lambda g: (g.r.clip(-within(g), within(g)) ** 2).sum(), kind="r", least=3)


@define("rvol_ewma_logret_097", kind="r", least=3)
def _(g):
    var = g.r[0] ** 2
    for x in g.r[1:]:
        var = 0.97 * var + 0.03 * x * x
    return np.sqrt(var)


def flips(g):
    sign = np.sign(g.s.values)
    good = (sign[1:] != 0) & (sign[:-1] != 0)
    return (sign[1:] != sign[:-1])[good].mean() if good.any() else NAN


def shocks(g):
    a = g.r.abs().values
    return np.flatnonzero(a >= np.percentile(a, 90))


plain("sign_change_rate", flips, kind="s")
plain("shock_cluster_density_q90_win5", lambda g: np.mean([((shocks(g) != i) & (np.abs(shocks(g) - i) <= 5)).any() for i in shocks(g)]), "", "r")
plain("rv_after_shock_share_k10", lambda g: ratio(sum(g.r[j] ** 2 for j in range(len(g)) if any(0 < j - i <= 10 for i in shocks(g))), (g.r**2).sum()), "", "r")
plain("shock_calm_time_median_q50", lambda g: np.median([min(later) - i for i in shocks(g) if (later := [j for j in range(i + 1, len(g)) if abs(g.r[j]) <= g.r.abs().median()])] or [NAN]), "", "r")
plain("spearman_absret_volume", lambda g: corr(g.r.abs().rank(), g.v.rank()), "cv", "r")
plain("swing_amplitude_median", lambda g: (lambda x: np.median([abs(p.sum()) for p in np.split(x, np.flatnonzero(np.diff(np.sign(x))) + 1)]) if len(x) else NAN)(g.r[g.r != 0].values), "", "r")
plain("tail_imbalance_q95_logret", lambda g: (lambda q: ratio(float((g.r <= -q).sum() - (g.r >= q).sum()), (g.r <= -q).sum() + (g.r >= q).sum()))(np.percentile(g.r.abs(), 95)), "", "r")
plain("time_share_above_twap", lambda g: (g.c > g.c.mean()).mean(), least=2)
plain("time_share_mid_range_20pct", lambda g: ((g.c - g.l.min()) / (g.h.max() - g.l.min())).clip(0, 1).between(0.4, 0.6).mean() if g.h.max() > g.l.min() else NAN, "hlc")
plain("time_to_20pct_volume_frac", lambda g: g.m[np.argmax(g.v.cumsum() >= 0.2 * g.v.sum())] / 389 if g.v.sum() > 0 else NAN, "v")
plain("time_to_50pct_volume_frac", lambda g: (g.m[np.argmax(g.v.cumsum() >= 0.5 * g.v.sum())] - g.m[0]) / 389 if g.v.sum() > 0 else NAN, "v")
plain("time_to_50pct_volume_min", lambda g: g.m[np.argmax(g.v.cumsum() >= 0.5 * g.v.sum())] - g.m[0] if g.v.sum() > 0 else NAN, "v")
plain("jump_count_local_k3_win21", lambda g: (lambda a, mad: ((a > 3 * mad) & (mad > 0)).sum() if (mad > 0).any() else NAN)(g.r.abs().values[20:], np.array([1.4826 * np.median(np.abs(w - np.median(w))) for w in np.lib.stride_tricks.sliding_window_view(g.r.abs().values, 21)])) if len(g) >= 21 else NAN, kind="r")


@pytest.fixture(scope="module")
def found(spark):
    frames = []
    for symbol, g in DAYS.items():
        sod = 34200 + 60 * g.m
        time = [dt.datetime(2024, 3, 4) + dt.timedelta(seconds=float(x)) for x in sod]
        frames.append(pd.DataFrame({"date": [DAY] * len(g), "symbol": symbol, "time": time, "tie": np.arange(len(g)), "sod": sod, "mt": g.m, "tau": g.m / 389}).join(g.drop(columns="m")))
    rows = pd.concat(frames).astype(object).where(lambda x: x.notna(), None)
    order = ["date", "symbol", "time", "tie", "sod", "mt", "tau", "o", "h", "l", "c", "v", "n", "vw"]
    schema = "date date, symbol string, time timestamp_ntz, tie long, " + ", ".join(f"{c} double" for c in order[4:])
    data = [tuple(r[:2]) + (r[2].to_pydatetime() if hasattr(r[2], "to_pydatetime") else r[2], int(r[3]), *[None if x is None else float(x) for x in r[4:]]) for r in rows[order].itertuples(index=False, name=None)]
    sample = spark.createDataFrame([(DAY, s) for s in [*DAYS, "ZZZ"]], "date date, symbol string")
    known = features()
    ticks = deal({"bars": spark.createDataFrame(data, schema)}, sample)["bars"].persist()
    out: dict = {}
    names = sorted(DEFINED)
    for lo in range(0, len(names), 30):
        table = feature_table([known[n] for n in names[lo : lo + 30]], {"bars": ticks}, sample)
        for r in table.toLocalIterator():
            out[r.feature, r.symbol] = NAN if r.value is None else r.value
    return out


@pytest.mark.parametrize("name", sorted(DEFINED))
def test_definition(found, name):
    assert np.isnan(found[name, "ZZZ"])
    wrong = {}
    for symbol, g in DAYS.items():
        want, got = DEFINED[name](g), found[name, symbol]
        want = NAN if want is None or np.isinf(want) else float(want)
        if not (np.isnan(want) and np.isnan(got)) and got != pytest.approx(want, rel=1e-7, abs=1e-10):
            wrong[symbol] = (got, want)
    assert not wrong


def test_partial_correlation_of_a_constant_day_is_zero(spark):
    g = DAYS["constant"]
    sod = 34200 + 60 * g.m
    rows = [(DAY, "A", dt.datetime(2024, 3, 4) + dt.timedelta(seconds=float(x)), k, float(x), float(c)) for k, (x, c) in enumerate(zip(sod, g.c, strict=True))]
    ticks = spark.createDataFrame(rows, "date date, symbol string, time timestamp_ntz, tie long, sod double, c double")
    sample = spark.createDataFrame([(DAY, "A")], "date date, symbol string")
    assert feature_table([features()["pac_ret_lag1_5"]], deal({"bars": ticks}, sample), sample).first().value == 0.0
