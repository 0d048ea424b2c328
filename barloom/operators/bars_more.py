"""Bar features, second half: thresholds, runs, concentration, resampling, patterns, pairs, spectra and ordered states."""

from __future__ import annotations

from ..plans import series
from ..plans.frame import Add, Fold, Frame, Group, Keep, Pairs, Series, add, clip, corr, div, lag, lead, number, over, pct, rows, running, share, total, when
from .bars import R, RC, RV, S, SV, bars, feat, logs, r_rows

ENDS = r_rows("")

# --- thresholds taken from the day itself
_SIG = (*S, add(q1=over(pct("s", 0.25)), q3=over(pct("s", 0.75)), sd=over("stddev_samp(s)")), add(sig="CASE WHEN q3 - q1 > 0 THEN 0.7413 * (q3 - q1) ELSE sd END"))
feat("count_extreme_k_sigma", _SIG, "count_if(a > 3 * sig)", "count(*) >= 3 AND max(sig) > 0")
feat("jump_count_local_q95", (*R, add(q=over(pct("a", 0.95)))), "count_if(a > q)", "count(*) >= 10")
_MAD = (*R, add(md=over("median(r)")), add(mad=over("median(abs(r - md))")))
_cap = "3.5 * 1.4826 * mad"
feat("rv_truncated_logret_k35", _MAD, total("r * r", f"a <= {_cap}"), "count(*) >= 3")
feat("rv_winsorized_logret_k35", _MAD, f"sum(least(a, {_cap}) * least(a, {_cap}))", "count(*) >= 3")
feat("robust_vol_mad_ret", (*RC, add(md=over("median(r)"))), "1.4826 * median(abs(r - md))", "count(*) >= 2")
feat("ret_es_q05", (*R, add(q=over(pct("r", 0.05)))), "avg(CASE WHEN r <= q THEN r END)", "count(*) >= 3")
feat("var_conc_top_decile", (*RC, add(r2="r * r"), add(q=over(pct("r2", 0.9)))), div(total("r2", "r2 >= q"), "sum(r2)"), "count(*) >= 2 AND sum(r2) > 0")
feat("tail_imbalance_q95_logret", (*ENDS, add(q=over(pct("a", 0.95)))), div("count_if(r <= -q) - count_if(r >= q)", "count_if(r <= -q) + count_if(r >= q)"), "count_if(r <= -q) + count_if(r >= q) > 0")
feat("next_absret_after_top_vol_decile", (*logs("c v"), add(q=over(pct("v", 0.9)), na=f"abs({lead('lr')})")), "avg(CASE WHEN v >= q THEN na END)", "count(CASE WHEN v >= q THEN na END) >= 3")
feat("next_ret_after_top_absret_decile", (*R, add(q=over(pct("a", 0.9)), ns=lead("exp(r) - 1")),), "avg(CASE WHEN a >= q THEN ns END)", "count(CASE WHEN a >= q THEN ns END) >= 3")
# the thresholds are of the rows that have a next one
_BIG = (*S, add(ns=lead("s")), Keep("ns IS NOT NULL"), add(lo=over(pct("s", 0.1)), hi=over(pct("s", 0.9))))
feat("reversal_prob_after_big_down", _BIG, share("ns > 0", "s <= lo"), "count_if(s <= lo) >= 3")
feat("reversal_prob_after_big_up", _BIG, share("ns < 0", "s >= hi"), "count_if(s >= hi) >= 3")
_VQ = (*RV, add(v1=over(pct("v", 0.1)), v8=over(pct("v", 0.8)), v9=over(pct("v", 0.9)), a3=rows("sum(a)", "1 FOLLOWING", "3 FOLLOWING")))
feat("next3_absret_highvol_minus_lowvol", _VQ, "avg(CASE WHEN v >= v9 THEN a3 END) - avg(CASE WHEN v <= v1 THEN a3 END)", "count(*) >= 4")
feat("up_prob_highvol_minus_lowvol", _VQ, f"{share('r > 0', 'v >= v9')} - {share('r > 0', 'v <= v1')}")
feat("return_contribution_top_quintile_by_volume", _VQ, div(total("a", "v >= v8"), "sum(a)"), "sum(a) > 0")

# --- moments about the day's mean
_MOM = (*RC, add(mu=over("avg(r)"), sd=over("stddev_samp(r)")), add(d="r - mu"))
_n = "CAST(count(*) AS DOUBLE)"
feat("ret_skew", _MOM, f"{_n} / nullif(({_n} - 1) * ({_n} - 2), 0) * {div('avg(d * d * d)', 'max(sd) * max(sd) * max(sd)')}", "count(*) >= 3 AND max(sd) > 0")
feat(
    "ret_excess_kurtosis",
    _MOM,
    f"{_n} * ({_n} + 1) / nullif(({_n} - 1) * ({_n} - 2) * ({_n} - 3), 0) * {div('avg(d * d * d * d)', 'max(sd) * max(sd) * max(sd) * max(sd)')} - 3 * ({_n} - 1) * ({_n} - 1) / nullif(({_n} - 2) * ({_n} - 3), 0)",
    "count(*) >= 4 AND max(sd) > 0",
)
_CO = (*RV, add(vm=over("avg(v)"), rm=over("avg(r)"), vs=over("stddev_samp(v)"), rs=over("stddev_samp(r)")), add(dv="v - vm", dr="r - rm"))
feat("volume_return_coskewness", _CO, div("avg(dv * dv * dr)", "max(vs) * max(vs) * max(rs)"), "max(vs) > 0 AND max(rs) > 0")
feat("volume_return_cokurtosis22", _CO, div("avg(dv * dv * dr * dr)", "max(vs) * max(vs) * max(rs) * max(rs)"), "max(vs) > 0 AND max(rs) > 0")

# --- neighbours: bipower, rolling, autoregression
_BP = (*RC, add(pa=lag("a")))
feat("bpv_logret", _BP, "pi() / 2 * sum(a * pa)", "count(*) >= 2")
feat("jump_var_bns", _BP, "greatest(sum(r * r) - pi() / 2 * sum(a * pa), 0)", "count(*) >= 2")
feat("bpv_to_rv_ratio", (*R, add(pa=lag("a"))), div("pi() / 2 * sum(a * pa)", "sum(r * r)"), "count(*) >= 3 AND sum(r * r) > 0")
feat("vol_of_vol_absret", (*R, add(pa=lag("a"))), "stddev_samp(a - pa)", "count(pa) >= 3")
for _q in (2, 5, 10):
    _roll = rows("sum(r)", f"{_q - 1} PRECEDING", "CURRENT ROW")
    feat(f"variance_ratio_q{_q}", (*R, add(rq=_roll)), div(f"var_samp(CASE WHEN k >= {_q} THEN rq END)", f"{_q} * var_samp(r)"), f"count(*) >= {_q + 2} AND var_samp(r) > 0 AND count_if(k >= {_q}) >= 2")
_LAGS = (*R, add(mu=over("avg(r)")), add(d="r - mu"), Add(tuple((f"d{k}", lag("d", k)) for k in range(1, 6))))


def _pacf() -> str:
    """Number of the first partial autocorrelation beyond 1.96 / sqrt(N), by the Durbin-Levinson recursion written out."""
    return "CASE " + " ".join(f"WHEN abs(max(p{k})) > 1.96 / sqrt(CAST(max(nr) AS DOUBLE)) THEN {k}" for k in range(1, 6)) + " ELSE 0 END"


_RHO = Group(("date", "symbol"), (*((f"q{k}", div(f"sum(d * d{k})", "sum(d * d)")) for k in range(1, 6)), ("nr", "count(*)"), ("ss", "sum(d * d)")))
_STEPS: list = [_RHO, add(f11="q1", p1="q1", e1="1 - q1 * q1")]
for _k in range(2, 6):
    _num = " - ".join([f"q{_k}", *[f"f{_k - 1}{j} * q{_k - j}" for j in range(1, _k)]])
    _STEPS.append(Add(((f"p{_k}", div(_num, f"CASE WHEN e{_k - 1} > 0 THEN e{_k - 1} END")),)))
    _STEPS.append(Add((*((f"f{_k}{j}", f"f{_k - 1}{j} - p{_k} * f{_k - 1}{_k - j}") for j in range(1, _k)), (f"f{_k}{_k}", f"p{_k}"), (f"e{_k}", f"e{_k - 1} * (1 - p{_k} * p{_k})"))))
# a day without variance has no correlation beyond the bound: 0
feat("pac_ret_lag1_5", (*_LAGS, *_STEPS), f"CASE WHEN max(ss) > 0 THEN {_pacf()} ELSE 0 END", "max(nr) >= 7")
_X11 = (*SV, add(g0="CAST(sign(s) AS DOUBLE)"), Add(tuple((f"x{k + 5}", lag("g0", k) if k > 0 else lead("g0", -k) if k < 0 else "g0") for k in range(-5, 6))))
_CORRS = Group(("date", "symbol"), (*((f"r{k}", f"CASE WHEN count(x{k}) >= 3 THEN {corr(f'x{k}', 'v')} END") for k in range(11)), ("nr", "count(*)")))
_best = "greatest(" + ", ".join(f"abs(r{k})" for k in range(11)) + ")"
_peak = (*_X11, _CORRS, Add((("top", _best),)))
_first = lambda value: "CASE " + " ".join(f"WHEN max(abs(r{k})) = max(top) THEN {value(k)}" for k in range(11)) + " END"
feat("xcorr_sign_volume_leadlag_lag", _peak, _first(lambda k: k - 5), "max(nr) >= 8")
feat("xcorr_sign_volume_leadlag_peak", _peak, _first(lambda k: f"max(r{k})"), "max(nr) >= 8")

# --- first and largest moments, concentration
for _name, _frame, _x in (("absret", S, "a"), ("volume", bars("v"), "v")):
    for _unit in ("frac", "min"):
        feat(f"{_name}_peak_time_{_unit}", (*_frame, add(mx=over(f"max({_x})"))), f"min(CASE WHEN {_x} = mx THEN tau END)")
_NP = (*bars("n"), add(mx=over("max(n)")))
feat("n_peak_time_frac", _NP, div("min(CASE WHEN n = mx THEN i - 1 END)", "count(*) - 1"), "count(*) >= 2 AND max(mx) > 0")
feat("n_peak_time_min", _NP, clip("min(CASE WHEN n = mx THEN tau END)"), "max(mx) > 0")
CUM = (*bars("v"), add(cum=running("sum(v)"), tot=over("sum(v)")))
feat("bars_to_50pct_volume_time_frac", CUM, div("min(CASE WHEN cum >= 0.5 * tot THEN i END)", "count(*)"), "max(tot) > 0")
for _unit in ("frac", "min"):
    feat(f"time_to_20pct_volume_{_unit}", CUM, clip("min(CASE WHEN cum >= 0.2 * tot THEN tau END)"), "max(tot) > 0")
feat("time_to_50pct_volume_frac", CUM, clip(div("min(CASE WHEN cum >= 0.5 * tot THEN mt END) - min(mt)", "389")), "max(tot) > 0")
feat("time_to_50pct_volume_min", CUM, "min(CASE WHEN cum >= 0.5 * tot THEN mt END) - min(mt)", "max(tot) > 0")
feat("volume_center_of_mass_time", bars("v"), clip(div("sum(tau * v)", "sum(v)")), "count(*) >= 2 AND sum(v) > 0")
feat("volume_top3_share", (*bars("v"), add(rk=number("v DESC"))), div(total("v", "rk <= 3"), "sum(v)"), "sum(v) > 0")


def compaction(frame: Frame, x: str) -> Frame:
    """Rows by falling x, with the sum so far and in all."""
    return (*frame, add(x=x), add(rk=number("x DESC"), run=running("sum(x)", "x DESC"), tot=over("sum(x)")))


for _name, _frame, _x, _part, _least in (
    ("absret_compaction_80pct_bars_frac", ENDS, "a", 0.8, 1),
    ("rv_compaction_50pct_bars_frac", ENDS, "r * r", 0.5, 2),
    ("rv_compaction_80pct_bars_frac", ENDS, "r * r", 0.8, 2),
    ("volume_compaction_80pct_bars_frac", bars("v"), "v", 0.8, 1),
):
    feat(_name, compaction(_frame, _x), div(f"min(CASE WHEN run >= {_part} * tot THEN rk END)", "count(*)"), f"count(*) >= {_least} AND max(tot) > 0")
for _name, _frame, _x in (("gini_absret", R, "a"), ("n_gini", bars("n", "n >= 0"), "n"), ("volume_gini", bars("v", "v >= 0"), "v")):
    _f = (*_frame, add(x=_x, nx=over("count(*)")), add(rk=number("x")))
    feat(_name, _f, clip(f"1 - 2 * {div('sum((nx - rk + 0.5) * x)', 'max(nx) * sum(x)')}"), "count(*) >= 2 AND sum(x) > 0")
_G2 = (*RC, add(x="r * r"), add(rk=number("x")))
feat("rv_gini_concentration", _G2, div("sum((2 * rk - nr - 1) * x)", "max(nr) * sum(x)"), "count(*) >= 2 AND sum(x) > 0")
for _name, _x in (("n", "n"), ("volume", "v")):
    feat(f"{_name}_hhi", (*bars(_x), add(p=div(_x, over(f"sum({_x})")))), "sum(p * p)", f"sum({_x}) > 0")
_H = "sum(CASE WHEN p > 0 THEN -p * ln(p) ELSE 0 END)"
_M = "CAST(count_if(p > 0) AS DOUBLE)"
for _name, _frame, _x, _value, _least in (
    ("n_entropy_concentration", bars("n"), "n", clip(f"1 - {div(_H, f'ln({_M})')}"), "count_if(p > 0) >= 2"),
    ("rv_entropy_concentration", R, "r * r", clip(f"1 - {div(_H, f'ln({_M})')}"), "count(*) >= 3 AND count_if(p > 0) >= 2"),
    ("volume_entropy", bars("v"), "v", clip(div(_H, f"ln({_M})")), "count_if(p > 0) >= 2"),
    ("volume_entropy_concentration", bars("v"), "v", f"1 - least({div(_H, f'ln({_n})')}, 1)", "count(*) >= 2"),
):
    feat(_name, (*_frame, add(x=_x), add(p=div("x", over("sum(x)")))), _value, f"sum(x) > 0 AND {_least}")
for _name, _frame, _x, _clip, _least in (("n", bars("n"), "n", True, 1), ("rv", R, "r * r", True, 3), ("volume", bars("v"), "v", False, 2)):
    # area under the running share over time by trapezoids, with the corners (0, 0) and (1, 1) where time doesn't reach them
    _f = (*_frame, add(x=_x), add(y=div(running("sum(x)"), over("sum(x)"))), add(py=f"coalesce({lag('y')}, 0)", pt=f"coalesce({lag('tau')}, 0)", ny=lead("y")))
    _auc = "sum((y + py) / 2 * (tau - pt)) + sum(CASE WHEN ny IS NULL AND tau < 1 THEN (y + 1) / 2 * (1 - tau) ELSE 0 END)"
    _score = f"2 * ({_auc}) - 1"
    feat(f"{_name}_front_loading_score", _f, clip(_score, -1.0, 1.0) if _clip else _score, f"count(*) >= {_least} AND sum(x) > 0")
for _name, _frame, _x in (("absret", R, "a"), ("volume", bars("v"), "v")):
    _f = (*_frame, add(z=number(), nz=over("count(*)")), add(t="(z - 1) / CAST(nullif(nz - 1, 0) AS DOUBLE) - 0.5"), add(u="t * t"))
    feat(f"u_shape_corr_{_name}", _f, corr(_x, "u"), "count(*) >= 3")
for _name, _lam in (("ewma_rvol_logret_094", 0.94),):
    feat(_name, (*R, add(w=f"pow({_lam}, nr - k)")), "sqrt(sum(w * r * r) / nullif(sum(w), 0))", "count(*) >= 3")
feat("rvol_ewma_logret_097", (*R, add(w="CASE WHEN k = 1 THEN pow(0.97, nr - 1) ELSE 0.03 * pow(0.97, nr - k) END")), "sqrt(sum(w * r * r))", "count(*) >= 3")

# --- average ranks
for _name, _frame, _x, _y in (("spearman_absret_volume", RV, "a", "v"), ("spearman_close_n", bars("c n"), "c", "n"), ("spearman_close_volume", bars("c v"), "c", "v")):
    _mean_rank = lambda x: f"rank() OVER (PARTITION BY date, symbol ORDER BY {x}) + (count(*) OVER (PARTITION BY date, symbol, {x}) - 1) / CAST(2 AS DOUBLE)"
    feat(_name, (*_frame, add(rx=_mean_rank(_x), ry=_mean_rank(_y))), corr("rx", "ry"), "count(*) >= 2")


# --- runs
def runs_of(frame: Frame, flag: str, keep: str | None = None) -> Frame:
    """One row per run of equal flags of neighbouring rows: flag, len, amp (sum of r), and the rows of the day nx."""
    cut = (Keep(keep),) if keep else ()
    return (
        *frame,
        add(nx=over("count(*)")),
        *cut,
        add(flag=flag),
        add(pf=lag("flag")),
        add(ch="CASE WHEN pf IS NULL OR pf <> flag THEN 1 ELSE 0 END"),
        add(run=running("sum(ch)")),
        Group(("date", "symbol", "run", "flag", "nx"), (("len", "count(*)"), ("amp", "sum(x)"))),
    )


_RX, _SX = (*ENDS, add(x="r")), (*S, add(x="s"))
SIGNED = runs_of(_RX, "sign(r)", "r <> 0")
ZEROS = runs_of(_RX, "sign(r)")
feat("run_count_total", SIGNED, "count(*)")
feat("swing_amplitude_median", SIGNED, "median(abs(amp))")
_hist = Group(("date", "symbol", "len"), (("m", "count(*)"),))
_probs = (*SIGNED, _hist, add(p="m / CAST(sum(m) OVER (PARTITION BY date, symbol) AS DOUBLE)"))
feat("run_length_entropy_signret", _probs, "CASE WHEN count(*) = 1 THEN 0 ELSE -sum(p * log2(p)) / log2(CAST(count(*) AS DOUBLE)) END")
# zeros don't end a run, and count in the day's length; a day of zeros has its own row
_WITH_ZEROS = runs_of((*_RX, add(has=over("max(abs(sign(r)))"))), "sign(r)", "r <> 0 OR has = 0")
feat("share_in_runs_len_ge3", _WITH_ZEROS, div("sum(CASE WHEN flag <> 0 AND len >= 3 THEN len ELSE 0 END)", "CAST(max(nx) AS DOUBLE)"))
_ru, _rd = "avg(CASE WHEN flag > 0 THEN CAST(len AS DOUBLE) END)", "avg(CASE WHEN flag < 0 THEN CAST(len AS DOUBLE) END)"
feat("run_balance_index", ZEROS, div(f"{_ru} - {_rd}", f"{_ru} + {_rd}"))
feat("run_len_var_ratio_up_to_down", ZEROS, div("var_samp(CASE WHEN flag > 0 THEN CAST(len AS DOUBLE) END)", "var_samp(CASE WHEN flag < 0 THEN CAST(len AS DOUBLE) END)"), "count_if(flag > 0) >= 2 AND count_if(flag < 0) >= 2")
feat("mean_run_length_sign", (*runs_of(_SX, "sign(s)", "s <> 0"),), "avg(CAST(len AS DOUBLE))", "sum(len) >= 2")
feat("max_down_run_len", runs_of(_SX, "CASE WHEN s < 0 THEN 1 ELSE 0 END"), "max(CASE WHEN flag = 1 THEN len END)")
feat("max_up_run_len", runs_of(_SX, "CASE WHEN s > 0 THEN 1 ELSE 0 END"), "max(CASE WHEN flag = 1 THEN len END)")
feat("vwap_avg_run_length_above", runs_of((*bars("c vw"), add(x="c")), "CASE WHEN c > vw THEN 1 ELSE 0 END"), "avg(CASE WHEN flag = 1 THEN CAST(len AS DOUBLE) END)")
feat("quietest_stretch_maxlen_q25_absret_frac", runs_of((*_RX, add(q=over(pct("a", 0.25)))), "CASE WHEN a <= q THEN 1 ELSE 0 END"), div("max(CASE WHEN flag = 1 THEN len ELSE 0 END)", "CAST(max(nx) AS DOUBLE)"))

# --- shocks: returns of the top decile by size
SHOCK = (*ENDS, add(q=over(pct("a", 0.9)), md=over("median(a)")), add(sh="CASE WHEN a >= q THEN 1 ELSE 0 END"))
feat("rv_after_shock_share_k10", (*SHOCK, add(near=rows("max(sh)", "10 PRECEDING", "1 PRECEDING"))), div(total("r * r", "near = 1"), "sum(r * r)"), "sum(r * r) > 0")
feat("shock_cluster_density_q90_win5", (*SHOCK, add(near=rows("sum(sh)", "5 PRECEDING", "5 FOLLOWING"))), share("near > 1", "sh = 1"))
feat("shock_followthrough_score_k5", (*SHOCK, add(nx=rows("sum(r)", "1 FOLLOWING", "5 FOLLOWING"))), "avg(CASE WHEN sh = 1 AND nx IS NOT NULL THEN CAST(sign(r) AS DOUBLE) * sign(nx) END)")
feat("shock_nextbar_reversion_ratio", (*SHOCK, add(nx=lead("r"))), "avg(CASE WHEN sh = 1 AND a > 0 THEN -sign(r) * nx / a END)", "count(*) >= 2")
feat("time_to_first_extreme_q90_absret_frac", SHOCK, div("min(CASE WHEN sh = 1 THEN k END)", "CAST(max(nr) AS DOUBLE)"))
# the first calm row behind is the least so far from the day's end on: a frame that grows takes a step a row, one that shrinks all rows left
_next_calm, _calm_time = "min(CASE WHEN a <= md THEN k END)", "median(CASE WHEN sh = 1 THEN CAST(calm - k AS DOUBLE) END)"
_CALM = (*SHOCK, add(calm=rows(_next_calm, "UNBOUNDED PRECEDING", "1 PRECEDING", "k DESC")))
feat("shock_calm_time_median_q50", _CALM, _calm_time, check=((*SHOCK, add(calm=rows(_next_calm, "1 FOLLOWING", "UNBOUNDED FOLLOWING"))), _calm_time))
_HALF = (*ENDS, add(tot=over("sum(r)")), add(cr=running("sum(r * sign(tot))")))
feat("time_to_half_openclose_ret_frac", _HALF, div("min(CASE WHEN cr >= 0.5 * abs(tot) THEN k END)", "CAST(max(nr) AS DOUBLE)"), "abs(max(tot)) >= 1e-12")
_MAJ = (*ENDS, add(sg="CAST(sign(r) AS DOUBLE)"), add(maj=f"sign({rows('sum(sg)', '5 PRECEDING', '1 PRECEDING')})"))
feat("signret_majority_agreement_share_m5", _MAJ, share("sg = maj", "k >= 6 AND maj <> 0"), "count(*) >= 6")
# the last 21 as an array: its middle value, and the middle of the distances to it
_WIN = (
    *R,
    add(w=f"sort_array({rows('collect_list(a)', '20 PRECEDING', 'CURRENT ROW')})"),
    Keep("k >= 21"),
    add(mad="1.4826 * element_at(sort_array(transform(w, x -> abs(x - element_at(w, 11)))), 11)"),
)
_WIN_PAIRS = (*R, Pairs(("k", "a"), ("k", "a"), "k2 BETWEEN k - 20 AND k AND k >= 21"), add(md="median(a2) OVER (PARTITION BY date, symbol, k)"), Group(("date", "symbol", "k"), (("a", "max(a)"), ("mad", "1.4826 * median(abs(a2 - md))"))))
_jumps = "CASE WHEN count_if(mad > 0) >= 1 THEN count_if(a > 3 * mad AND mad > 0) END"
feat("jump_count_local_k3_win21", _WIN, _jumps, check=(_WIN_PAIRS, _jumps))

# --- coarser bars
for _min in (5, 15, 30):
    _f = (
        *bars("c"),
        add(slot=f"CAST(floor(mt / {_min}) AS INT)"),
        Group(("date", "symbol", "slot"), (("c", "max_by(c, i)"), ("time", "max(time)"), ("tie", "max(tie)"))),
        Keep("c > 0"),
        add(lr=f"ln(c) - {lag('ln(c)')}"),
    )
    feat(f"rv_logret_{_min}m", _f, "sum(lr * lr)", "count(*) >= 3")

# --- patterns of order
_P3 = (*ENDS, add(b=lead("r"), d=lead("r", 2)), Keep("d IS NOT NULL"), add(pat="CASE WHEN r <= b THEN 1 ELSE 0 END + CASE WHEN r <= d THEN 2 ELSE 0 END + CASE WHEN b <= d THEN 4 ELSE 0 END"))
_COUNT = (Group(("date", "symbol", "pat"), (("m", "count(*)"),)), add(p="m / CAST(sum(m) OVER (PARTITION BY date, symbol) AS DOUBLE)"))
feat("permutation_entropy_logret_m3", (*_P3, *_COUNT), "-sum(p * log2(p)) / log2(CAST(6 AS DOUBLE))")
_cmp = [("r", "b"), ("r", "d"), ("r", "e"), ("b", "d"), ("b", "e"), ("d", "e")]
_P4 = (*R, add(b=lead("r"), d=lead("r", 2), e=lead("r", 3)), Keep("e IS NOT NULL"), add(pat=" + ".join(f"CASE WHEN {x} <= {y} THEN {1 << k} ELSE 0 END" for k, (x, y) in enumerate(_cmp))))
feat("permutation_entropy_ret", (*_P4, *_COUNT), clip("-sum(p * ln(p)) / ln(CAST(24 AS DOUBLE))"), "count(*) >= 2")
_edges = lambda x: Add(tuple((f"{x}{k}", over(pct(x, k / 8))) for k in range(9)))


def _bin(x: str) -> str:
    """Distinct inner edges at or below x, so that equal edges make one bin less."""
    return " + ".join(f"CASE WHEN {x}{k} > {x}{k - 1} AND {x}{k} < {x}8 AND {x}{k} <= {x} THEN 1 ELSE 0 END" for k in range(1, 8))


_MI = (*RV, _edges("r"), _edges("v"), add(br=_bin("r"), bv=_bin("v")), Group(("date", "symbol", "br", "bv"), (("m", "count(*)"), ("rr", "max(r8 - r0)"), ("rv", "max(v8 - v0)"))))
_MI = (*_MI, add(t="CAST(sum(m) OVER (PARTITION BY date, symbol) AS DOUBLE)", mr="CAST(sum(m) OVER (PARTITION BY date, symbol, br) AS DOUBLE)", mv="CAST(sum(m) OVER (PARTITION BY date, symbol, bv) AS DOUBLE)"))
feat("mutual_info_ret_volume_q8", _MI, "sum(m / t * log2(m * t / (mr * mv)))", "max(rr) > 0 AND max(rv) > 0")

# --- fractal dimensions
_KATZ = (*bars("c"), add(d1=f"abs(c - {lag('c')})", c0=over("min_by(c, i)")))
_ratio = div("max(abs(c - c0)) * (count(*) - 1)", "sum(d1)")
feat("katz_fd_close", _KATZ, div(f"log10({_n})", f"log10({_n}) + log10({_ratio})"), "count(*) >= 3 AND sum(d1) > 0 AND max(abs(c - c0)) > 0")
_HIG = (*ENDS, Keep("nr >= 9"), Add(tuple((f"y{j}", f"abs(r - {lag('r', j)})") for j in range(2, 8))), add(z="k - 1"))
_hig: list = []
for _j in range(2, 8):
    # offsets of a stride: the steps from each offset are summed by the remainder of the row's number
    _cells = [f"CASE WHEN sum(CASE WHEN z % {_j} = {_m} THEN 1 ELSE 0 END) >= 2 THEN {total(f'y{_j}', f'z % {_j} = {_m} AND y{_j} IS NOT NULL')} * (max(nr) - 1) / nullif((sum(CASE WHEN z % {_j} = {_m} THEN 1 ELSE 0 END) - 1) * {_j}, 0) END" for _m in range(_j)]
    _hig.append((f"l{_j}", "(" + " + ".join(f"coalesce({c}, 0)" for c in _cells) + ") / nullif(" + " + ".join(f"CASE WHEN ({c}) IS NOT NULL THEN 1 ELSE 0 END" for c in _cells) + ", 0)"))
_X = "(0.0" + "".join(f" - ln(CAST({j} AS DOUBLE))" for j in range(2, 8)) + ") / 6"
_num = " + ".join(f"(-ln(CAST({j} AS DOUBLE)) - {_X}) * ln(nullif(l{j}, 0))" for j in range(2, 8))
_den = " + ".join(f"(-ln(CAST({j} AS DOUBLE)) - {_X}) * (-ln(CAST({j} AS DOUBLE)) - {_X})" for j in range(2, 8))
feat("higuchi_fd_logret_kmax7", (*_HIG, Group(("date", "symbol"), tuple(_hig))), f"max(({_num}) / ({_den}))")
_SIZES = (5, 10, 20, 40, 80, 160)
_HURST: list = [*R, Keep("nr >= 20")]
for _m in _SIZES:
    _in = f"OVER (PARTITION BY date, symbol, b{_m} ORDER BY time, tie ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    _all = f"OVER (PARTITION BY date, symbol, b{_m})"
    _HURST += [
        Add(((f"b{_m}", f"CASE WHEN nr >= {2 * _m} AND floor((k - 1) / {_m}.0) < floor(nr / {_m}.0) THEN CAST(floor((k - 1) / {_m}.0) AS INT) ELSE -1 END"),)),
        Add(((f"m{_m}", f"avg(r) {_all}"), (f"s{_m}", f"stddev_samp(r) {_all}"))),
        Add(((f"z{_m}", f"sum(r - m{_m}) {_in}"),)),
        Add(((f"q{_m}", f"CASE WHEN b{_m} >= 0 AND s{_m} > 0 THEN (max(z{_m}) {_all} - min(z{_m}) {_all}) / nullif(s{_m}, 0) END"),)),
    ]
_HURST.append(Group(("date", "symbol"), tuple((f"y{m}", f"avg(q{m})") for m in _SIZES)))
_have = lambda m: f"CASE WHEN y{m} > 0 THEN 1e0 ELSE 0e0 END"
_cnt = " + ".join(_have(m) for m in _SIZES)
_sx = " + ".join(f"{_have(m)} * ln(CAST({m} AS DOUBLE))" for m in _SIZES)
_sy = " + ".join(f"CASE WHEN y{m} > 0 THEN ln(y{m}) ELSE 0 END" for m in _SIZES)
_sxx = " + ".join(f"{_have(m)} * ln(CAST({m} AS DOUBLE)) * ln(CAST({m} AS DOUBLE))" for m in _SIZES)
_sxy = " + ".join(f"CASE WHEN y{m} > 0 THEN ln(y{m}) * ln(CAST({m} AS DOUBLE)) ELSE 0 END" for m in _SIZES)
_HURST.append(add(cn=_cnt, sx=_sx, sy=_sy, sxx=_sxx, sxy=_sxy))
feat("hurst_rs_ret", tuple(_HURST), "max((cn * sxy - sx * sy) / nullif(cn * sxx - sx * sx, 0))", "max(cn) >= 2")

# --- pairs of bars: numbers of the sorted or ordered series, and the pairs themselves to check them
_PAIRED = Pairs(("r", "k"), ("r", "k"), "k < k2")
_QN = "CASE WHEN {} THEN 2.2219 * {} END"
feat("qn_vol_logret", (*RC, Series("k", ("r",), (("q", lambda r: series.distance_quantile(r, 0.25)), ("n", len)))), _QN.format("max(n) >= 3", "max(q)"), check=((*RC, _PAIRED), _QN.format("count(*) >= 3", pct("abs(r - r2)", 0.25))))
_SLOPES = (*bars("c"), Pairs(("c", "mt", "i"), ("c", "mt", "i"), "i < i2 AND mt2 <> mt"))
feat("theil_sen_slope_close_time", (*bars("c"), Series("i", ("c", "mt"), (("m", series.median_slope),))), "max(m)", check=(_SLOPES, "median((c2 - c) / (mt2 - mt))"))
_GRAM = (*ENDS, add(tol=f"0.2 * {over('stddev_pop(a)')}", y1=lead("a"), y2=lead("a", 2)), Keep("nr >= 6 AND tol > 0"))
_cols = ("k", "nr", "tol", "a", "y1", "y2")
_two = "greatest(abs(a - a2), abs(y1 - y12)) <= tol AND y1 IS NOT NULL AND y12 IS NOT NULL"
_three = f"{_two} AND abs(y2 - y22) <= tol"
_APEN = (*_GRAM, Pairs(_cols, _cols, "true"), Group(("date", "symbol", "k", "nr"), (("n2", f"sum(CASE WHEN {_two} THEN 1e0 ELSE 0e0 END)"), ("n3", f"sum(CASE WHEN {_three} THEN 1e0 ELSE 0e0 END)"))))
_apen = "avg(CASE WHEN n2 > 0 THEN ln(n2 / (nr - 1)) END) - avg(CASE WHEN n3 > 0 THEN ln(n3 / (nr - 2)) END)"
# the left gram stops one earlier than the right one
_A, _B = f"sum(CASE WHEN {_three} AND k <= nr - 3 THEN 1e0 ELSE 0e0 END)", f"sum(CASE WHEN {_two} AND k <= nr - 2 THEN 1e0 ELSE 0e0 END)"
_samp = f"CASE WHEN {_A} > 0 AND {_B} > 0 THEN -ln({div(_A, _B)}) END"
_ALIKE = (*ENDS, Series("k", ("a",), (("apen", series.approximate_entropy), ("sampen", series.sample_entropy))))
feat("approx_entropy_absret_m2_r02", _ALIKE, "max(apen)", check=(_APEN, _apen))
feat("sample_entropy_absret_m2_r02", _ALIKE, "max(sampen)", check=((*_GRAM, Pairs(_cols, _cols, "k < k2")), _samp))

# --- spectra: a fast transform, and to check it every frequency with every bar of the day
_DETREND = (
    *bars("c"),
    add(nb=over("count(*)")),
    Keep("nb >= 8"),
    add(t="(i - 1) / CAST(nb - 1 AS DOUBLE)"),
    add(cm=over("avg(c)")),
    add(b="sum((t - 0.5) * (c - cm)) OVER (PARTITION BY date, symbol) / sum((t - 0.5) * (t - 0.5)) OVER (PARTITION BY date, symbol)"),
    add(e="c - cm - b * (t - 0.5)"),
)
_DFT = (
    *_DETREND,
    Pairs(("i", "nb"), ("i", "e"), "i <= floor(nb / 2.0)"),
    Group(("date", "symbol", "i", "nb"), (("re", "sum(e2 * cos(2 * pi() * i * (i2 - 1) / nb))"), ("im", "sum(e2 * sin(2 * pi() * i * (i2 - 1) / nb))"))),
    add(pw="re * re + im * im"),
    add(mf=over("count(*)"), tot=over("sum(pw)")),
    add(p=div("pw", "tot")),
)
_SPECTRUM = (*_DETREND, Series("i", ("e",), (("entropy", series.spectral_entropy), ("low", series.low_share))))
_entropy = clip("-sum(CASE WHEN p > 0 THEN p * ln(p) ELSE 0 END) / nullif(ln(CAST(max(mf) AS DOUBLE)), 0)")
feat("spectral_entropy_close", _SPECTRUM, "max(entropy)", check=(_DFT, f"CASE WHEN max(mf) >= 2 AND max(tot) > 1e-16 AND count_if(p > 0) >= 2 THEN {_entropy} END"))
feat("spectral_lowfreq_share_close", _SPECTRUM, "max(low)", check=(_DFT, "CASE WHEN max(tot) > 1e-16 THEN sum(CASE WHEN i <= greatest(1, floor(0.1 * mf)) THEN p ELSE 0 END) END"))


def _haar(frame: Frame, levels: int = 3) -> Frame:
    """Approximation of e after so many Haar steps; an odd last value is taken twice at its step."""
    out: list = [*frame, add(j="i - 1", len="nb", y="e", tot=over("sum(e * e)"))]
    for _ in range(levels):
        twice = "CASE WHEN len % 2 = 1 AND j = len - 1 THEN 2 * y ELSE y END"
        out.append(Add((("jj", "CAST(floor(j / 2.0) AS BIGINT)"), ("yy", twice), ("ll", "CAST(floor((len + 1) / 2.0) AS BIGINT)"))))
        out.append(Group(("date", "symbol", "jj", "ll", "tot"), (("y0", "sum(yy) / sqrt(CAST(2 AS DOUBLE))"),)))
        out.append(Add((("j", "jj"), ("len", "ll"), ("y", "y0"))))
        out.append(Group(("date", "symbol", "j", "len", "tot"), (("y", "max(y)"),)))
    return tuple(out)


_HAAR = _haar(_DETREND)
feat("wavelet_energy_lowfreq_share", _HAAR, clip(div("sum(y * y)", "max(tot)")), "max(tot) > 1e-16")
feat("wavelet_energy_highfreq_share", _HAAR, clip(f"1 - {div('sum(y * y)', 'max(tot)')}"), "max(tot) > 1e-16")

# --- states carried from bar to bar
_al = "(2 / CAST(21 AS DOUBLE))"
# the average's step is _al * (c - em): its sign needs no difference of averages. The powers of the check leave the range of a double after some 7040 bars
_both_move, _same = "s.em - s.em = 0 AND NOT isnan(x.c) AND x.c <> s.c AND x.c <> s.em", "(x.c > s.c) = (x.c > s.em)"
_EMA = Fold(
    "i",
    ("c",),
    (
        ("c", "DOUBLE", "NULL", "x.c"),
        ("em", "DOUBLE", "NULL", f"CASE WHEN s.em IS NULL THEN x.c ELSE s.em + {_al} * (x.c - s.em) END"),
        ("moved", "BIGINT", "0", f"CASE WHEN {_both_move} THEN s.moved + 1 ELSE s.moved END"),
        ("same", "BIGINT", "0", f"CASE WHEN {_both_move} AND {_same} THEN s.same + 1 ELSE s.same END"),
        ("rows", "BIGINT", "0", "s.rows + 1"),
    ),
)
_EMA_POWERS = (
    *bars("c"),
    add(zc=f"CASE WHEN i = 1 THEN c ELSE {_al} * c * pow(1 - {_al}, 1 - i) END"),
    add(em=f"pow(1 - {_al}, i - 1) * {running('sum(zc)')}"),
    add(dc=f"sign(c - {lag('c')})", de=f"sign(em - {lag('em')})"),
)
_aligned = when("count(*) >= 3", share("dc = de", "dc <> 0 AND de <> 0"))
feat("ema20_trend_align_share", (*bars("c"), _EMA), when("max(rows) >= 3", div("max(same)", "max(moved)")), check=(_EMA_POWERS, _aligned))
# directional changes of 10 basis points: way of the leg, its extreme, the first close and the changes so far
_open_up, _open_down = "s.way = 0 AND x.c >= s.ref * 1.001e0", "s.way = 0 AND x.c <= s.ref * 0.999e0"
_turn_up, _turn_down = "s.way = -1 AND x.c >= s.ext * 1.001e0", "s.way = 1 AND x.c <= s.ext * 0.999e0"
_changes = f"({_open_up}) OR ({_open_down}) OR ({_turn_up}) OR ({_turn_down})"
_further = "s.way * (x.c - s.ext) > 0"
_DC = Fold(
    "i",
    ("c",),
    (
        ("way", "INT", "0", f"CASE WHEN s.ref IS NULL THEN 0 WHEN {_further} THEN s.way WHEN ({_open_up}) OR ({_turn_up}) THEN 1 WHEN ({_open_down}) OR ({_turn_down}) THEN -1 ELSE s.way END"),
        ("ext", "DOUBLE", "NULL", f"CASE WHEN s.ref IS NULL OR {_further} OR {_changes} THEN x.c ELSE s.ext END"),
        ("ref", "DOUBLE", "NULL", "coalesce(s.ref, x.c)"),
        ("n", "INT", "0", f"CASE WHEN s.ref IS NULL OR {_further} THEN s.n WHEN {_changes} THEN s.n + 1 ELSE s.n END"),
        ("rows", "INT", "0", "s.rows + 1"),
    ),
)
feat("dc_count_bps_10", (*bars("c"), _DC), "CASE WHEN max(rows) >= 2 THEN max(n) END")
# a phrase grows while it is found in what came before it: c phrases are done, the open one starts at i of the signs u
_phrase = "instr(substring(s.u, 1, s.i - 1), substring(s.u || x.up, s.i)) = 0"
_LZ = Fold(
    "j",
    ("up",),
    (
        ("u", "STRING", "''", "s.u || x.up"),
        ("i", "INT", "1", f"CASE WHEN {_phrase} THEN length(s.u) + 2 ELSE s.i END"),
        ("c", "INT", "0", f"CASE WHEN {_phrase} THEN s.c + 1 ELSE s.c END"),
    ),
)
_SIGNS = (*ENDS, Keep("r <> 0"), Add((("j", number()), ("up", "CASE WHEN r > 0 THEN '1' ELSE '0' END"))), _LZ)
_length = "CAST(length(u) AS DOUBLE)"
feat("lz_complexity_signret", _SIGNS, f"max(CASE WHEN length(u) = 1 THEN 1 ELSE (c + CASE WHEN i <= length(u) THEN 1 ELSE 0 END) / nullif({_length} / nullif(log2({_length}), 0), 0) END)")
