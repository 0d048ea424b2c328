"""Bar features, first half: returns, moments, correlations, sessions, volume and range."""

from __future__ import annotations

from ..plans.feature import Feature
from ..plans.frame import G, Frame, Keep, add, clip, corr, div, lag, lead, number, over, pct, rows, running, share, slope, total, when

RTH, PRE, POST = "sod BETWEEN 34200 AND 57540", "sod BETWEEN 0 AND 34140", "sod BETWEEN 57600 AND 86340"
EARLY_HOUR, LATE_HOUR = "sod <= 37740", "sod >= 54000"
MIDDAY, NOON = "sod BETWEEN 39600 AND 50400", "sod BETWEEN 43200 AND 46740"
POS = {"c": "c > 0", "v": "v > 0", "n": "n > 0", "vw": "vw > 0"}

FOUND: dict[str, Feature] = {}


def feat(name: str, frame: Frame, value: str, need: str | None = None, source: str = "bars", check: tuple[Frame, str] | None = None) -> None:
    """Register a feature; need is the condition under which it has a value, check a plainer definition for the other engine."""
    if name in FOUND:
        raise ValueError(f"{name} is there already")
    FOUND[name] = Feature(name, source, frame, when(need, value) if need else value, check)


def bars(cols: str = "", keep: str = "", session: str = RTH) -> Frame:
    """Bars of a session with no null in cols, and their number i from 1."""
    conds = [session, *[f"{c} IS NOT NULL" for c in cols.split()], *([keep] if keep else [])]
    return (Keep(" AND ".join(conds)), add(i=number()))


def logs(cols: str = "c", keep: str = "", session: str = RTH) -> Frame:
    """Bars with lr, the log return on the bar before."""
    return (*bars(cols, keep, session), add(lc="CASE WHEN c > 0 THEN ln(c) END"), add(lr=f"lc - {lag('lc')}"))


def simple(cols: str = "c", keep: str = "", session: str = RTH) -> Frame:
    """Bars with sr, the simple return on the bar before."""
    return (*bars(cols, keep, session), add(pc=lag("c")), add(sr="c / nullif(pc, 0) - 1"))


def r_rows(cols: str = "c", keep: str = "", session: str = RTH) -> Frame:
    """Bars that have a log return: r, its size a, its number k from 1, and their count nr."""
    return (*logs(cols, keep, session), Keep("lr IS NOT NULL"), add(r="lr", a="abs(lr)", k=number(), nr=over("count(*)")))


def s_rows(cols: str = "c", keep: str = "", session: str = RTH) -> Frame:
    """Bars that have a simple return: s, its size a, its number k from 1, and their count nr."""
    return (*simple(cols, keep, session), Keep("sr IS NOT NULL"), add(s="sr", a="abs(sr)", k=number(), nr=over("count(*)")))


def first(x: str) -> str:
    return f"min_by({x}, i)"


def last(x: str) -> str:
    return f"max_by({x}, i)"


R, RC, S = r_rows(), r_rows("c", "c > 0"), s_rows()
RV, RN, SV = r_rows("c v"), r_rows("c n"), s_rows("c v")
DOWN_UP = (("down", "s < 0"), ("up", "s > 0"))

# --- level and spread of closes, volumes and trade counts
feat("twap", bars("c"), "avg(c)")
feat("std_close", bars("c"), "stddev_samp(c)")
feat("std_volume", bars("v"), "stddev_samp(v)", "count(*) >= 3")
feat("std_n", bars("n"), "stddev_samp(n)", "count(*) >= 3")
feat("std_ret", S, "stddev_samp(s)", "count(*) >= 3")
feat("std_close_vwap_diff", bars("c vw"), "stddev_samp(c - vw)", "count(*) >= 2")
feat("std_vwap_dev_rel", bars("c vw", "vw > 0"), "stddev_samp((c - vw) / vw)", "count(*) >= 2")
feat("rms_vwap_dev_rel", bars("c vw", "vw > 0"), "sqrt(avg(((c - vw) / vw) * ((c - vw) / vw)))")
feat("std_trade_size", bars("v n", "n > 0"), "stddev_samp(v / n)", "count(*) >= 3")
feat("cv_trade_size", bars("v n", "n > 0"), div("stddev_samp(v / n)", "avg(v / n)"), "count(*) >= 3 AND avg(v / n) > 0")
feat("cv_close", bars("c"), div("stddev_samp(c)", "avg(c)"), "count(*) >= 2 AND avg(c) > 0")
feat("cv_n", bars("n"), div("stddev_samp(n)", "avg(n)"), "count(*) >= 3 AND avg(n) > 0")
feat("cv_volume", bars("v"), div("stddev_samp(v)", "avg(v)"), "count(*) >= 3 AND avg(v) > 0")
feat("avg_trade_size", bars("v n"), div("sum(v)", "sum(n)"))
feat("n_burstiness", bars("n"), div("stddev_samp(n) - avg(n)", "stddev_samp(n) + avg(n)"), "count(*) >= 2 AND avg(n) > 0 AND stddev_samp(n) > 0")
feat("n_fano_factor", bars("n"), div("var_samp(n)", "avg(n)"), "count(*) >= 2 AND avg(n) > 0")
feat("volume_median_to_mean_ratio", bars("v"), div("median(v)", "avg(v)"), "avg(v) > 0")
feat("volume_skew", (*bars("v"), add(mu=over("avg(v)"), sd=over("stddev_samp(v)"))), div("avg((v - mu) * (v - mu) * (v - mu))", "max(sd) * max(sd) * max(sd)"), "count(*) >= 3 AND max(sd) > 0")

# --- pre and post market
for _side, _cond in (("pre", PRE), ("post", POST)):
    feat(f"{_side}_mean_close", bars("c", session=_cond), "avg(c)")
    feat(f"{_side}_range_hl", bars("h l", session=_cond), "max(h) - min(l)")
    feat(f"{_side}_std_close", bars("c", session=_cond), "stddev_samp(c)", "count(*) >= 3")
    feat(f"{_side}_std_ret", s_rows(session=_cond), "stddev_samp(s)", "count(*) >= 3")
    feat(f"{_side}_sum_n", bars("n", session=_cond), "sum(n)")
    feat(f"{_side}_sum_volume", bars("v", session=_cond), "sum(v)")
ALL_DAY = f"(({PRE}) OR ({RTH}) OR ({POST}))"
feat("post_vol_ratio_to_rth", bars("v", session=ALL_DAY), div(total("v", POST), total("v", RTH)), f"{total('v', RTH)} > 0")
feat("premkt_vol_ratio_to_rth", bars("v", session=ALL_DAY), div(total("v", PRE), total("v", RTH)), f"{total('v', RTH)} > 0")
_PRE_RTH = f"(({PRE}) OR ({RTH}))"
_SEG = "(PARTITION BY date, symbol, seg ORDER BY time, tie)"
_gap = f"(min_by(o, CASE WHEN {RTH} THEN i END) - max_by(c, CASE WHEN {PRE} THEN i END))"
feat(
    "premkt_gap_fill_ratio",
    (*bars("c", session=_PRE_RTH), Keep(f"({PRE}) OR o IS NOT NULL")),
    div(f"-(max_by(c, CASE WHEN {RTH} THEN i END) - min_by(o, CASE WHEN {RTH} THEN i END))", _gap),
    f"count_if({PRE}) > 0 AND count_if({RTH}) > 0",
)
feat(
    "premkt_to_rth_ret_corr",
    (*bars("c", session=_PRE_RTH), add(seg=f"CASE WHEN {PRE} THEN 0 ELSE 1 END", lc="CASE WHEN c > 0 THEN ln(c) END"), add(lr=f"lc - {lag('lc', over=_SEG)}"), Keep("lr IS NOT NULL")),
    "CAST(sign(sum(CASE WHEN seg = 0 THEN lr ELSE 0 END)) AS DOUBLE) * sign(sum(CASE WHEN seg = 1 THEN lr ELSE 0 END))",
    "count_if(seg = 0) > 0 AND count_if(seg = 1) > 0",
)

# --- range of the session
HLC, OHLC = bars("h l c"), bars("o h l c")
_H, _L, _C = "max(h)", "min(l)", last("c")
feat("close_to_edge_distance_frac", HLC, div(f"least({_C} - {_L}, {_H} - {_C})", f"{_H} - {_L}"), f"{_H} > {_L}")
feat("clv_session", HLC, div(f"({_C} - {_L}) - ({_H} - {_C})", f"{_H} - {_L}"), f"{_H} > {_L}")
feat("end_position_in_range", HLC, div(f"{_C} - {_L}", f"{_H} - {_L}"), f"{_H} > {_L}")
feat("close_to_open_ret", bars("o c"), f"{div(first('o'), last('c'))} - 1", f"{last('c')} > 0")
feat("open_to_close_ret", bars("o c"), f"{div(last('c'), first('o'))} - 1", f"{first('o')} > 0")
feat("oc_efficiency_over_range", OHLC, div(f"abs({_C} - {first('o')})", f"{_H} - {_L}"), f"{_H} > {_L}")
_lnhl, _lnco = f"ln({div(_H, _L)})", f"ln({div(_C, first('o'))})"
_ok = f"min(o) IS NOT NULL AND {first('o')} > 0 AND {_H} > 0 AND {_L} > 0 AND {_C} > 0"
feat("garman_klass_session_vol", OHLC, f"sqrt(greatest(0.5 * {_lnhl} * {_lnhl} - (2 * ln(2) - 1) * {_lnco} * {_lnco}, 0))", _ok)
feat(
    "rogers_satchell_session_vol",
    OHLC,
    f"sqrt(greatest(ln({div(_H, _C)}) * ln({div(_H, first('o'))}) + ln({div(_L, _C)}) * ln({div(_L, first('o'))}), 0))",
    _ok,
)
feat("parkinson_vol", bars("h l"), f"sqrt({_lnhl} * {_lnhl} / (4 * ln(2)))", f"{_H} > 0 AND {_L} > 0")
feat("gk_var_sum_ohlc", bars("o h l c", "o > 0 AND h > 0 AND l > 0 AND c > 0"), "nullif(sum(greatest(0.5 * ln(h / l) * ln(h / l) - (2 * ln(2) - 1) * ln(c / o) * ln(c / o), 0)), 0)")
feat("range_per_trade", bars("h l n"), div(f"{_H} - {_L}", "sum(n)"), f"{_H} > {_L} AND sum(n) > 0")
feat("range_to_rv_sqrt_ratio", logs("h l c"), div(f"ln({div(_H, _L)})", "sqrt(sum(lr * lr))"), f"sum(lr * lr) > 0 AND {_H} > 0 AND {_L} > 0")
feat("path_length_over_range", (*HLC, add(d1=f"c - {lag('c')}")), div("sum(abs(d1))", f"{_H} - {_L}"), f"count(*) >= 2 AND {_H} > {_L}")
_open = "min_by(o, CASE WHEN o IS NOT NULL THEN i END)"
feat("path_efficiency", (*bars("c"), add(d1=f"c - {lag('c')}")), clip(div(f"abs({_C} - {_open})", "sum(abs(d1))")), "count(*) >= 2 AND count(o) > 0 AND sum(abs(d1)) > 0")
feat("total_variation_close", (*bars("c"), add(d1=f"c - {lag('c')}")), "sum(abs(d1))", "count(*) >= 2")
EDGES = (*HLC, add(hi=over("max(h)"), lo=over("min(l)")))
_pos = clip(div("c - lo", "hi - lo"))
feat("median_position_in_range", EDGES, f"median({_pos})", "max(hi) > max(lo)")
feat("time_share_mid_range_20pct", EDGES, share(f"({_pos}) BETWEEN 0.4 AND 0.6"), "max(hi) > max(lo)")
feat("near_high_time_share_10bp", (*bars("c h"), add(hi=over("max(h)"))), share("greatest(hi - c, 0) / nullif(hi, 0) <= 0.001"), "max(hi) > 0")
feat("near_low_time_share_10bp", (*bars("c l"), add(lo=over("min(l)"))), share("greatest(c - lo, 0) / nullif(lo, 0) <= 0.001"), "max(lo) > 0")
FLIPS = "count_if(sg <> psg)"


def flips(frame: Frame, d: str, keep: str = "") -> Frame:
    """Rows of a frame on which d isn't 0, with its sign sg and the sign psg of the row before among them."""
    return (*frame, add(dv=d), Keep(f"dv <> 0{keep}"), add(sg="CAST(sign(dv) AS DOUBLE)"), add(psg=lag("sg")))


feat("midrange_cross_count", flips(EDGES, "c - (hi + lo) / 2"), FLIPS, "count(*) >= 2")
feat("vwap_cross_count", flips(bars("c vw"), "c - vw"), FLIPS, "count(*) >= 2")
_TURN = (*bars("c"), add(d1=f"c - {lag('c')}", nb=over("count(*)")), Keep("d1 IS NOT NULL"), add(md=over("median(abs(d1))")))
feat("turning_point_count", flips(_TURN, "d1", " AND abs(dv) > 0.1 * md"), FLIPS, "max(nb) >= 3 AND count(*) >= 2")
feat("turning_point_rate_close", (*bars("c"), add(d1=f"c - {lag('c')}"), add(d2=lead("d1"))), div("sum(CASE WHEN d1 * d2 < 0 THEN 1e0 ELSE 0e0 END)", "count(*) - 2"), "count(*) >= 3")
feat("new_high_count", (*bars("h"), add(ph=rows("max(h)", "UNBOUNDED PRECEDING", "1 PRECEDING"))), "count_if(h > ph)", "count(*) >= 2")
feat("new_low_count", (*bars("l"), add(pl=rows("min(l)", "UNBOUNDED PRECEDING", "1 PRECEDING"))), "count_if(l < pl)", "count(*) >= 2")
_BRK = (add(ph=rows("max(h)", "UNBOUNDED PRECEDING", "1 PRECEDING"), ns=lead("sr")),)
feat("breakout_nextret_high", (*simple("h c"), *_BRK), "avg(CASE WHEN h > ph THEN ns END)", "count(CASE WHEN h > ph THEN ns END) >= 3")
feat("breakout_nextret_low", (*simple("l c"), add(pl=rows("min(l)", "UNBOUNDED PRECEDING", "1 PRECEDING"), ns=lead("sr"))), "avg(CASE WHEN l < pl THEN ns END)", "count(CASE WHEN l < pl THEN ns END) >= 3")
PEAK = (*bars("c"), add(cm=running("max(c)"), cn=running("min(c)")))
feat("intraday_max_drawdown_close", PEAK, f"1 - min({div('c', 'cm')})", "count(*) >= 2 AND min(c) > 0")
feat("intraday_max_drawup_close", PEAK, f"greatest(max({div('c', 'cn')} - 1), 0)", "count(*) >= 2")
feat("ulcer_index_close", PEAK, f"sqrt(avg((1 - {div('c', 'cm')}) * (1 - {div('c', 'cm')})))", "count(*) >= 2 AND min(c) > 0")
_DD = (*PEAK, add(dd="c / nullif(cm, 0) - 1"), add(low=over("min(dd)")), add(tr=over("min(CASE WHEN dd = low THEN i END)")), add(top=over("max(CASE WHEN i = tr THEN cm END)")))
feat(
    "max_drawdown_depth_per_bar",
    _DD,
    div("-max(low)", "max(tr) - min(CASE WHEN c = top AND i <= tr THEN i END)"),
    "count(*) >= 2 AND max(tr) > 1 AND max(tr) > min(CASE WHEN c = top AND i <= tr THEN i END)",
)

# --- shape of bars
SPAN = bars("o h l c", "h - l > 0")
feat("candle_body_to_range_mean", OHLC, f"avg({div('abs(c - o)', 'h - l')})")
feat("mean_body_to_range", SPAN, "avg(abs(c - o) / (h - l))")
feat("doji_density", SPAN, share("abs(c - o) <= 0.1 * (h - l)"))
feat("lower_shadow_ratio_mean", SPAN, "avg(greatest(least(o, c) - l, 0) / (h - l))")
feat("upper_shadow_ratio_mean", SPAN, "avg(greatest(h - greatest(o, c), 0) / (h - l))")
_M3 = (*bars("c"), add(c1=lead("c"), c2=lead("c", 2)))
feat("motif_ascending_share_m3_close", _M3, div("sum(CASE WHEN c < c1 AND c1 < c2 THEN 1e0 ELSE 0e0 END)", "count(*) - 2"), "count(*) >= 3")
feat("motif_zigzag_share_m3_close", _M3, div("sum(CASE WHEN (c < c1 AND c1 > c2) OR (c > c1 AND c1 < c2) THEN 1e0 ELSE 0e0 END)", "count(*) - 2"), "count(*) >= 3")
_D12 = (*bars("c"), add(d1=f"c - {lag('c')}"), add(d2=f"d1 - {lag('d1')}"))
feat("accel_align_rate", _D12, share("d1 * d2 > 0", "d1 <> 0 AND d2 <> 0"), "count(*) >= 4")
feat("accel_over_vel_std_ratio", _D12, div("stddev_samp(d2)", "stddev_samp(d1)"), "count(*) >= 4 AND stddev_samp(d1) > 0 AND count(d2) >= 2")

# --- where the close stands
feat("price_above_median_share", (*bars("c"), add(md=over("median(c)"))), share("c > md"))
feat("time_share_above_twap", (*bars("c"), add(mu=over("avg(c)"))), share("c > mu"), "count(*) >= 2")
feat("time_share_above_vwap", bars("c vw"), share("c > vw"))
feat("time_share_above_open", (*bars("c"), add(fo=over("min_by(o, CASE WHEN o IS NOT NULL THEN i END)"), fc=over("min_by(c, i)"))), share("c >= coalesce(fo, fc)"))
feat("mean_abs_vwap_gap", bars("c vw"), "avg(abs(c - vw))")
feat("mean_close_vwap_rel_diff", bars("c vw"), f"avg({div('c - vw', 'vw')})")
feat("vwap_dev_bps_time_share_10bp", bars("c vw"), share("abs(c - vw) / nullif(vw, 0) >= 0.001"))
feat("vwap_dev_rel_median_abs", bars("c vw"), f"median(abs({div('c - vw', 'vw')}))")
feat("vwap_gap_tail_share_q75", (*bars("c vw"), add(q=over(pct("abs(c - vw)", 0.75)))), share("abs(c - vw) > q"), "count(*) >= 3")
feat("vwap_position_in_range", bars("h l vw v"), div(f"{div('sum(vw * v)', 'sum(v)')} - {_L}", f"{_H} - {_L}"), f"{_H} > {_L} AND sum(v) > 0")
feat("vwap_twap_diff", bars("c v"), f"{div('sum(c * v)', 'sum(v)')} - avg(c)", "count(*) >= 3 AND sum(v) > 0")
feat("vwap_twap_gap_rel", bars("c vw v", "v > 0"), div(f"{div('sum(vw * v)', 'sum(v)')} - avg(c)", "avg(c)"), "avg(c) > 0 AND sum(v) > 0")
feat("vwap_zscore_close_end", bars("c vw v"), div(f"{_C} - {div('sum(c * v)', 'sum(v)')}", "stddev_samp(c - vw)"), "count(*) >= 3 AND sum(v) > 0 AND stddev_samp(c - vw) > 0")
_DV = (*bars("c vw"), add(d="c - vw"), add(pd=lag("d")))
feat("rv_close_vwap_diff", _DV, "sum((d - pd) * (d - pd))", "count(pd) >= 1")
feat("vwap_dev_ar1_phi", _DV, slope("d", "pd"), "count(*) >= 3")
feat("vwap_dev_ar1_halflife_bars", _DV, f"-ln(2) / nullif(ln({slope('d', 'pd')}), 0)", f"count(*) >= 3 AND ({slope('d', 'pd')}) > 0 AND ({slope('d', 'pd')}) < 1")
feat("duration_since_last_vwap_cross_frac", _DV, clip(div("max(mt) - max(CASE WHEN sign(d) * sign(pd) < 0 THEN mt END)", "389")), "count(*) >= 2 AND count_if(sign(d) * sign(pd) < 0) > 0")
_CROSS = (*simple("c vw"), add(d="c - vw", ns=lead("sr")), add(pd=lag("d")))
for _to, _cond in (("down", "d < 0 AND pd >= 0"), ("up", "d > 0 AND pd <= 0")):
    feat(f"vwap_cross_{_to}_nextret", _CROSS, f"avg(CASE WHEN {_cond} THEN ns END)", f"count(CASE WHEN {_cond} THEN ns END) >= 3")
feat("vwap_cross_spacing_mean", (*flips(bars("c vw"), "c - vw"), Keep("sg <> psg"), add(gap=f"mt - {lag('mt')}")), div("avg(gap)", "389"), "count(*) >= 2")

# --- simple sums of returns
for _name, _value, _need, _frame in (
    ("rv_logret", "sum(r * r)", None, RC),
    ("rvol_logret", "sqrt(sum(r * r))", None, RC),
    ("rv_per_min_logret", "sum(r * r) / 389", None, RC),
    ("rq_logret", "count(*) / CAST(3 AS DOUBLE) * sum(r * r * r * r)", "count(*) >= 2", RC),
    ("pos_semivar_ret", total("r * r", "r > 0"), "count(*) > 0", RC),
    ("neg_semivar_ret", total("r * r", "r < 0"), "count(*) > 0", RC),
    ("semivar_pos_over_neg", div(total("r * r", "r > 0"), total("r * r", "r < 0")), None, RC),
    ("rv_last30m_share", div(total("r * r", "mt >= 359"), "sum(r * r)"), None, RC),
    ("rv_last15m_share", div(total("r * r", "sod >= 56700"), "sum(r * r)"), "count(*) >= 3", R),
    ("rv_share_above_vwap", div(total("r * r", "c > vw"), "sum(r * r)"), None, r_rows("c vw", "c > 0")),
    ("max_absret_value", "max(a)", None, S),
    ("iqr_vol_logret", f"0.7413 * ({pct('r', 0.75)} - {pct('r', 0.25)})", "count(*) >= 3", RC),
    ("iqr_logret", f"{pct('r', 0.75)} - {pct('r', 0.25)}", None, r_rows("")),
    ("mean_over_median_absret", div("avg(a)", "median(a)"), "count(*) >= 3 AND median(a) > 0", R),
    ("ret_var_q05", pct("r", 0.05), "count(*) >= 3", R),
    ("zero_ret_share", share("a <= 1e-10"), None, S),
    ("ret_up_down_abs_magnitude_ratio", div(total("r", "r > 0"), total("-r", "r < 0")), f"{total('-r', 'r < 0')} > 0", r_rows("")),
    ("range_up_down_ratio", div(total("h - l", "s > 0"), total("h - l", "s < 0")), f"{total('h - l', 's < 0')} > 0", s_rows("h l c")),
    ("absret_center_of_mass_time", clip(div("sum(tau * a)", "sum(a)")), "count(*) >= 3 AND sum(a) > 0", R),
):
    feat(_name, _frame, _value, _need)
_LR, _LRV, _LRN, _LRVW = logs(), logs("c v"), logs("c n"), logs("c vw")
feat("absret_per_volume", _LRV, div("sum(abs(lr))", "sum(v)"), "count(lr) > 0 AND sum(v) > 0")
feat("rv_per_volume", _LRV, div("sum(lr * lr)", "sum(v)"), "count(lr) >= 3 AND sum(lr * lr) > 0 AND sum(v) > 0")
feat("rv_per_trade", _LRN, div("sum(lr * lr)", "sum(n)"), "count(lr) > 0 AND sum(n) > 0")
feat("rvol_over_sqrt_trades", _LRN, div("sqrt(sum(lr * lr))", "sqrt(sum(n))"), "count(lr) >= 3 AND sum(lr * lr) > 0 AND sum(n) > 0")
feat("rv_cond_above_vwap", _LRVW, "sum(CASE WHEN c > vw THEN lr * lr END)")
feat("rv_cond_below_vwap", _LRVW, "sum(CASE WHEN c <= vw THEN lr * lr END)")
for _side, _cond in (("down", "s < 0"), ("up", "s > 0")):
    feat(f"rv_cond_{_side}", S, f"sum(CASE WHEN {_cond} AND c > 0 AND pc > 0 THEN pow(ln(c / pc), 2) END)")
_ENDS = r_rows("")
for _name, _cond, _frame, _least in (("endgame_drift_share_last60", LATE_HOUR, _ENDS, "1e-12"), ("opening_impulse_share_30m", "sod <= 35940", _ENDS, "1e-12"), ("oc_return_last30m_share", "sod >= 55800", R, None)):
    feat(_name, _frame, div(total("r", _cond), "sum(r)"), f"abs(sum(r)) >= {_least}" if _least else f"sum(r) <> 0 AND count_if({_cond}) > 0")
feat("midday_lull_rv_ratio", R, div(div(total("r * r", NOON), "sum(r * r)"), div(f"count_if({NOON})", "count(*)")), f"count(*) >= 3 AND sum(r * r) > 0 AND count_if({NOON}) > 0")
feat("midday_volume_ratio", bars("v"), div(f"avg(CASE WHEN {NOON} THEN v END)", "avg(v)"), f"avg(v) > 0 AND count_if({NOON}) > 0")
feat("midday_smallmove_share_q25", (*_ENDS, add(q=over(pct("a", 0.25)))), share("a <= q", MIDDAY))
_sd = lambda cond: f"stddev_samp(CASE WHEN {cond} THEN r END)"
feat("return_vol_u_shape_ratio", R, div(f"({_sd(EARLY_HOUR)} + {_sd(LATE_HOUR)}) / 2", _sd(MIDDAY)), f"({_sd(MIDDAY)}) > 0")
for _part, _when in (("open_15m", "mt < 15"), ("close_15m", "mt >= 374")):
    feat(f"{_part}_absret_share", S, div(total("a", _when), "sum(a)"), "sum(a) > 0")
    feat(f"{_part}_volume_share", bars("v"), div(total("v", _when), "sum(v)"), "sum(v) > 0")
feat("early_late_vol_ratio_30m", S, div("stddev_samp(CASE WHEN mt < 30 THEN s END)", "stddev_samp(CASE WHEN mt >= 359 THEN s END)"), "count_if(mt < 30) >= 3 AND count_if(mt >= 359) >= 3")
_SEGMENTS = (*bars("c", f"({EARLY_HOUR} OR {LATE_HOUR})"), add(seg=f"CASE WHEN {EARLY_HOUR} THEN 0 ELSE 1 END"))
feat(
    "early_late_vol_ratio_60m",
    (*_SEGMENTS, add(pc=lag("c", over=_SEG)), add(sr="c / nullif(pc, 0) - 1")),
    div("stddev_samp(CASE WHEN seg = 0 THEN sr END)", "stddev_samp(CASE WHEN seg = 1 THEN sr END)"),
)
_SEG_RUNS = (*_SEGMENTS, Keep("c > 0"), add(lc="ln(c)"), add(lr=f"lc - {lag('lc', over=_SEG)}"), Keep("lr <> 0"), add(ps=f"lag(sign(lr)) OVER {_SEG}"), add(ch="CASE WHEN ps IS NULL OR ps <> sign(lr) THEN 1 ELSE 0 END"))
feat("early_vs_late_run_count_ratio", _SEG_RUNS, div("sum(CASE WHEN seg = 0 THEN ch END)", "sum(CASE WHEN seg = 1 THEN ch END)"))

# --- shares and means by sign of the return
for _side, _cond in DOWN_UP:
    feat(f"{_side}_bar_share", S, share(_cond))
    feat(f"{_side}_mean_absret", S, f"avg(CASE WHEN {_cond} THEN a END)")
    feat(f"volume_share_on_{_side}", SV, div(total("v", _cond), "sum(v)"), "sum(v) > 0")
    feat(f"mean_volume_per_trade_{_side}", s_rows("c v n"), div(total("v", _cond), total("n", _cond)), f"{total('n', _cond)} > 0")
    feat(f"next_ret_cond_{_side}", (*S, add(ns=lead("s"))), f"avg(CASE WHEN {_cond} THEN ns END)", f"count(CASE WHEN {_cond} THEN ns END) >= 3")
_NEXT = (*S, add(ns=lead("s")))
feat("cond_diff_next_ret_up_minus_down", _NEXT, "avg(CASE WHEN s > 0 THEN ns END) - avg(CASE WHEN s < 0 THEN ns END)", "count(CASE WHEN s > 0 THEN ns END) >= 3 AND count(CASE WHEN s < 0 THEN ns END) >= 3")
feat("up_down_absret_ratio", S, div("avg(CASE WHEN s > 0 THEN a END)", "avg(CASE WHEN s < 0 THEN a END)"), "avg(CASE WHEN s < 0 THEN a END) > 0")
_up, _dn = (div(total("v", c), total("n", c)) for c in ("s > 0", "s < 0"))
feat("mvpt_up_over_down_ratio", s_rows("c v n"), div(_up, _dn), f"{total('n', 's > 0')} > 0 AND {total('n', 's < 0')} > 0 AND {_dn} > 0")
feat("premium_close_vwap_up_minus_down", s_rows("c vw"), "avg(CASE WHEN s > 0 THEN c - vw END) - avg(CASE WHEN s < 0 THEN c - vw END)")
feat("volume_up_down_logratio", SV, f"ln(({total('v', 's > 0')} + 1e-12) / ({total('v', 's < 0')} + 1e-12))")
feat("signed_volume_imbalance", simple("c v"), div("sum(coalesce(sign(sr), 0) * v)", "sum(v)"), "count(sr) > 0 AND sum(v) > 0")
feat("volume_weighted_simple_return", SV, div("sum(v * s)", "sum(v)"), "count(*) >= 2 AND sum(v) > 0")
feat("vw_mean_absret_logret", RV, div("sum(v * a)", "sum(v)"), "sum(v) > 0")
_SG = (*S, add(g0="sign(s)"), add(g1=lead("g0"), g2=lead("g0", 2), gp=lag("g0")))
_run2 = "g0 = g1 AND g0 <> 0 AND g2 <> 0"
feat("cond_reversal_after_run2", _SG, share("g2 <> g1", _run2), f"count(*) >= 3 AND count_if({_run2}) >= 3")
feat("sign_change_rate", _SG, share("g0 <> gp", "g0 <> 0 AND gp <> 0"))
# a sign's first row has no row before it, and its comparison with nothing counts as a change
feat("transition_p_same_sign", _SG, div("sum(CASE WHEN g0 = gp AND g0 <> 0 THEN 1e0 ELSE 0e0 END)", "count_if(g0 <> 0 AND (gp <> 0 OR gp IS NULL))"))
_uu, _dd = share("g1 = 1", "g0 = 1"), share("g1 = -1", "g0 = -1")
# the last row has no next one and is no condition
_LAST = (*_SG, Keep("k < nr"))
feat("transition_asymmetry", _LAST, f"{_uu} - {_dd}")
feat(
    "entropy_sign_ret",
    S,
    div(
        "-("
        + " + ".join(f"CASE WHEN count_if({c}) > 0 THEN count_if({c}) / CAST(count(*) AS DOUBLE) * ln(count_if({c}) / CAST(count(*) AS DOUBLE)) ELSE 0 END" for c in ("s < 0", "s = 0", "s > 0"))
        + ")",
        "ln(CAST(count(DISTINCT sign(s)) AS DOUBLE))",
    ),
    "count(DISTINCT sign(s)) >= 2",
)
_TE = (*r_rows(""), Keep("r <> 0"), add(u="CASE WHEN r > 0 THEN 1 ELSE 0 END"), add(pu=lag("u")))


def _row_entropy(p: int) -> str:
    n = f"CAST(count_if(pu = {p}) AS DOUBLE)"
    part = lambda u: f"CASE WHEN count_if(pu = {p} AND u = {u}) > 0 THEN count_if(pu = {p} AND u = {u}) / {n} * log2(count_if(pu = {p} AND u = {u}) / {n}) ELSE 0 END"
    return f"CASE WHEN count_if(pu = {p}) > 0 THEN -{n} * ({part(0)} + {part(1)}) ELSE 0 END"


feat("transition_entropy_signret", _TE, f"({_row_entropy(0)} + {_row_entropy(1)}) / nullif(count(pu), 0)", "count(*) >= 2")

# --- correlations and lines
for _name, _frame, _x, _y, _least in (
    ("corr_absret_n", r_rows("c n", "c > 0"), "a", "n", 2),
    ("corr_absret_volume", r_rows("c v", "c > 0"), "a", "v", 2),
    ("corr_ret2_volume", r_rows("c v", "c > 0"), "r * r", "v", 2),
    ("corr_close_n", bars("c n"), "c", "n", 2),
    ("corr_close_volume", bars("c v"), "c", "v", 2),
    ("corr_close_vwap", bars("c vw"), "c", "vw", 3),
    ("corr_ret_n", RN, "r", "n", 3),
    ("corr_ret_volume", RV, "r", "v", 3),
    ("corr_signret_volume", RV, "CAST(sign(r) AS DOUBLE)", "v", 2),
    ("corr_ret_absnextret", (*S, add(na=lead("a"))), "s", "na", 3),
    ("xcorr_n_absret_lag1", (*_LRN, add(na=f"abs({lead('lr')})")), "n", "na", 3),
    ("xcorr_volume_absret_lag1", (*_LRV, add(na=f"abs({lead('lr')})")), "v", "na", 3),
    ("ac1_absret", (*RC, add(pa=lag("a"))), "a", "pa", 2),
    ("ac1_ret2", (*RC, add(pa=lag("r * r"))), "r * r", "pa", 2),
    ("ac1_n", (*bars("n"), add(pn=lag("n"))), "n", "pn", 2),
    ("ac1_volume", (*bars("v"), add(pv=lag("v"))), "v", "pv", 2),
):
    feat(_name, _frame, corr(_x, _y), f"count({_y}) >= {_least}")
_ACF = (*R, add(mu=over("avg(r)")), add(d="r - mu"))
feat("ac_ret_lag2", (*_ACF, add(d2=lag("d", 2))), div("sum(d * d2)", "sum(d * d)"), "count(*) >= 4 AND sum(d * d) > 0")
feat("ar1_ret_coef", (*S, add(ps=lag("s"))), slope("s", "ps"), "count(ps) >= 3")
feat("roll_spread", (*bars("c"), add(d1=f"c - {lag('c')}"), add(pd=lag("d1"))), "CASE WHEN covar_samp(d1, pd) < 0 THEN 2 * sqrt(-covar_samp(d1, pd)) END", "count(pd) >= 2")
for _name, _frame, _y, _x, _least in (
    ("absret_on_sqrtn_beta", RN, "a", "sqrt(n)", 3),
    ("absret_sqrtvol_slope", s_rows("c v", "v > 0"), "a", "sqrt(v)", 2),
    ("close_on_logn_beta", bars("c n", "n > 0"), "c", "ln(n)", 2),
    ("close_on_logvolume_beta", bars("c v", "v > 0"), "c", "ln(v)", 2),
    ("close_on_n_beta", bars("c n"), "c", "n", 2),
    ("close_on_volume_beta", bars("c v"), "c", "v", 2),
    ("close_on_vwap_beta", bars("c vw"), "c", "vw", 2),
    ("diff_close_vwap_on_n_beta", bars("c vw n"), "(c - vw)", "n", 2),
    ("diff_close_vwap_on_volume_beta", bars("c vw v"), "(c - vw)", "v", 2),
    ("diff_close_vwap_trend_slope", bars("c vw"), "(c - vw)", "mt", 2),
    ("trend_slope_close_time", bars("c"), "c", "mt", 2),
    ("near_close_ramp_slope_10m", bars("c", "sod >= 57000"), "c", "mt", 2),
    ("range_on_logvolume_beta", bars("h l v", "h - l >= 0 AND v > 0"), "(h - l)", "ln(v)", 3),
    ("impact_elasticity_log", (*RV, Keep("a > 0 AND v > 0")), "ln(a)", "ln(v)", 8),
    ("log_absret_on_logvolume_beta", (*RV, Keep("a > 0 AND v > 0")), "ln(a)", "ln(v)", 3),
    ("impact_reversion_beta1", (*simple("c v"), add(ns=lead("sr")), Keep("ns IS NOT NULL")), "ns", "v", 8),
    ("kyle_lambda_lead1_beta", (*simple("c v"), add(ns=lead("sr")), Keep("ns IS NOT NULL AND sr IS NOT NULL")), "ns", "(sign(sr) * v)", 3),
    ("kyle_lambda_proxy", r_rows("c vw v"), "a", "(vw * v)", 8),
    ("ret_next_on_vwapdev_beta", (*simple("c vw"), add(ns=lead("sr")), Keep("ns IS NOT NULL AND vw <> 0")), "ns", "((c - vw) / vw)", 3),
):
    feat(_name, _frame, slope(_y, _x), f"count(*) >= {_least}")
# a line's slope doesn't change where its level does, so the first open is needed only to be there
feat("impact_slope_price_cumn", (*bars("c n"), add(cum=running("sum(n)"))), slope("c", "cum"), "count(*) >= 3 AND count(o) > 0")
feat("impact_slope_price_cumvol", (*bars("c v"), add(cum=running("sum(v)"))), slope("c", "cum"), "count(*) >= 2")
for _name, _x in (("n", "n"), ("volume", "v")):
    feat(f"relprice_log_elasticity_{_name}", (*bars(f"c {_x}"), add(fo=over("min_by(o, CASE WHEN o IS NOT NULL THEN i END)"), fc=over("min_by(c, i)")), Keep(f"c > 0 AND {_x} > 0")), slope("ln(c)", f"ln({_x})"), "count(*) >= 2 AND max(coalesce(fo, fc)) > 0")
feat("amihud_illiquidity", (*simple("c vw v"), Keep("vw > 0 AND v > 0 AND sr IS NOT NULL")), "avg(abs(sr) / (vw * v))")
_r2 = "covar_pop(c, mt) * covar_pop(c, mt) / nullif(var_pop(c) * var_pop(mt), 0)"
feat("trend_r2_close_time", bars("c"), _r2, "count(*) >= 2 AND var_pop(c) > 0 AND var_pop(mt) > 0")
_sse = "greatest(count(*) * (var_pop(c) - covar_pop(c, mt) * covar_pop(c, mt) / nullif(var_pop(mt), 0)), 0)"
feat("trend_resid_std", bars("c"), f"sqrt({_sse} / nullif(count(*) - 2, 0))", "count(*) >= 3 AND var_pop(mt) > 0")
feat("trend_slope_tstat", bars("c"), div(slope("c", "mt"), f"sqrt({_sse} / nullif(count(*) - 2, 0) / nullif(count(*) * var_pop(mt), 0))"), f"count(*) >= 3 AND var_pop(mt) > 0 AND {_sse} > 0")
_WLS = (*bars("c v"), add(w="greatest(v, 0)"), add(ws=over("sum(greatest(v, 0))")), add(xm=f"sum(w * mt) OVER {G} / nullif(ws, 0)", ym=f"sum(w * c) OVER {G} / nullif(ws, 0)"))
feat("trend_slope_volume_weighted", _WLS, div("sum(w * (mt - xm) * (c - ym))", "sum(w * (mt - xm) * (mt - xm))"), "count_if(w > 0) >= 2 AND sum(w * (mt - xm) * (mt - xm)) > 0")


def _partial(x: str, y: str) -> str:
    xy, xt, yt = corr(x, y), corr(x, "mt"), corr(y, "mt")
    return f"(({xy}) - ({xt}) * ({yt})) / nullif(sqrt((1 - ({xt}) * ({xt})) * (1 - ({yt}) * ({yt}))), 0)"


for _name, _frame, _x, _y, _least in (
    ("absret_volume_time", RV, "a", "v", 3),
    ("close_n_time", bars("c n"), "c", "n", 2),
    ("close_volume_time", bars("c v"), "c", "v", 2),
    ("vwapdev_volume_time", bars("c vw v", "vw > 0"), "abs(c - vw) / vw", "v", 3),
):
    # with an open time line or one that x or y follows exactly there is nothing left to correlate
    _free = " AND ".join(f"coalesce(abs({corr(z, 'mt')}), 0) < 1 - 1e-9" for z in (_x, _y))
    feat(f"partial_corr_{_name}", _frame, _partial(_x, _y), f"count(*) >= {max(3, _least)} AND {_free}")
_LINE = (*bars("c"), add(nb=over("count(*)")), add(t="(i - 1) / CAST(nullif(nb - 1, 0) AS DOUBLE)"))
_FIT = (*_LINE, add(tm=over("avg(t)"), cm=over("avg(c)")), add(b=f"sum((t - tm) * (c - cm)) OVER {G} / nullif(sum((t - tm) * (t - tm)) OVER {G}, 0)"), add(e="c - cm - b * (t - tm)"))
_m2, _m3, _m4 = "avg(e * e)", "avg(e * e * e)", "avg(e * e * e * e)"
_g1 = div(_m3, f"({_m2}) * sqrt({_m2})")
feat("trend_resid_skew", _FIT, f"sqrt(CAST(count(*) AS DOUBLE) * (count(*) - 1)) / nullif(count(*) - 2, 0) * {_g1}", f"count(*) >= 3 AND {_m2} > 1e-20")
_g2 = f"({div(_m4, f'({_m2}) * ({_m2})')} - 3)"
feat("trend_resid_kurt", _FIT, f"(count(*) - 1) / nullif(CAST(count(*) - 2 AS DOUBLE) * (count(*) - 3), 0) * ((count(*) + 1) * {_g2} + 6)", f"count(*) >= 4 AND {_m2} > 1e-20")
# a parabola on centred t: q is t's square without its line, so b2 comes from q alone
_QUAD = (*_FIT, add(q0="(t - tm) * (t - tm)"), add(qm=over("avg(q0)"), qb=f"sum((t - tm) * (t - tm) * (t - tm)) OVER {G} / nullif(sum((t - tm) * (t - tm)) OVER {G}, 0)"), add(q="q0 - qm - qb * (t - tm)"))
_b2 = div("sum(q * c)", "sum(q * q)")
feat("trend_quad_beta2", _QUAD, _b2, "count(*) >= 3")
feat("trend_quad_beta1", _QUAD, f"max(b) - {_b2} * (max(qb) + 2 * max(tm))", "count(*) >= 3")
_AM, _PM = "sod <= 43200", "sod >= 43200"
_HALVES = (
    *bars("c"),
    add(ka=f"CASE WHEN {_AM} THEN i END", kp=f"CASE WHEN {_PM} THEN i END"),
    add(la=over("min(ka)"), na=over("count(ka)"), lp=over("min(kp)"), np=over("count(kp)")),
    add(ta="(ka - la) / CAST(nullif(na - 1, 0) AS DOUBLE)", tp="(kp - lp) / CAST(nullif(np - 1, 0) AS DOUBLE)"),
)
feat("trend_piecewise_slope_am_pm", _HALVES, f"({slope('c', 'tp')}) - ({slope('c', 'ta')})", "max(na) >= 2 AND max(np) >= 2")
