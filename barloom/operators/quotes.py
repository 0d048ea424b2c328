"""Quote features: event means, time-weighted means and pair shares over best bid and offer events.

A quote holds from its time to the next one's, or to the close; dt is the part of that in the session, and pdt the part
of the stretch from the quote before. Thresholds and code sets are parameters; the catalog is built with the defaults.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from ..plans.feature import Feature
from ..plans.frame import Add, Frame, Group, Keep, add, clip, div, lag, over, running, share, total, when


@dataclass(frozen=True)
class QuoteParams:
    jump_tau: float = 5e-4
    persist_max_sec: float = 3600.0
    latency_max_ms: float = 3000.0
    stale_gap_ms: float = 500.0
    price_rtol: float = 1e-5
    price_atol: float = 1e-8
    size_rtol: float = 1e-5
    size_atol: float = 1e-8
    ineligible_conditions: tuple[int, ...] = ()
    ineligible_indicators: tuple[int, ...] = ()
    nonfirm_conditions: tuple[int, ...] = ()
    nonfirm_indicators: tuple[int, ...] = ()
    manual_conditions: tuple[int, ...] = ()
    manual_indicators: tuple[int, ...] = ()
    opening_conditions: tuple[int, ...] = ()
    opening_indicators: tuple[int, ...] = ()


    @classmethod
    def of(cls, texts: list[str]) -> QuoteParams:
        """Parameters from texts `name=value`; codes of a set are parted by commas. An unknown name is an error."""
        known, given = {f.name: f.default for f in fields(cls)}, {}
        for name, _, value in (t.partition("=") for t in texts):
            if name not in known:
                raise KeyError(f"no such parameter: {name}; there are {sorted(known)}")
            given[name] = tuple(int(c) for c in value.split(",") if c) if isinstance(known[name], tuple) else float(value)
        return cls(**given)


EVENTS = "time >= open_ns AND time < close_ns"
BOOK, SIZES = "bid IS NOT NULL AND ask IS NOT NULL AND bid + ask > 0", "bsz IS NOT NULL AND asz IS NOT NULL AND bsz + asz > 0"
MID, REL = "((bid + ask) / 2)", "(2 * (ask - bid) / (bid + ask))"


def held(keep: str, val: str, order_time: str = "time") -> Frame:
    """Valid quotes with val, how long they hold (dt, seconds) and the row before: pval, pdt."""
    window = f"(PARTITION BY date, symbol ORDER BY {order_time}, tie)"
    return (
        Keep(keep),
        add(val=val),
        Add((("nt", f"lead({order_time}) OVER {window}"), ("pt", f"lag({order_time}) OVER {window}"), ("pval", f"lag(val) OVER {window}"))),
        Add(
            (
                ("dt", f"greatest(0, least(coalesce(nt, close_ns), close_ns) - greatest({order_time}, open_ns)) / 1e9"),
                ("pdt", f"CASE WHEN pt IS NULL THEN 0 ELSE greatest(0, least({order_time}, close_ns) - greatest(pt, open_ns)) / 1e9 END"),
            )
        ),
    )


def apart(a: str, b: str, rtol: float = 1e-5, atol: float = 1e-8) -> str:
    return f"abs(({a}) - ({b})) > CAST({atol} AS DOUBLE) + CAST({rtol} AS DOUBLE) * abs({b})"


def any_code(column: str, codes: tuple[int, ...]) -> str:
    """Whether a list column holds one of codes; an empty set is never held."""
    return "(" + " OR ".join(f"coalesce(array_contains({column}, {c}), false)" for c in codes) + ")" if codes else "false"


def flagged(p: QuoteParams, *kinds: str) -> str:
    parts = [any_code(column, getattr(p, f"{kind}_{column}")) for kind in kinds for column in ("conditions", "indicators")]
    return "(" + " OR ".join(parts) + ")"


def histogram(frame: Frame, x: str, top: float, bins: int, part: float, sums: tuple[tuple[str, str], ...] = ()) -> Frame:
    """Counts and sums of x's bins in [0, top], with the bin last in which the given share of rows is reached, and its upper edge.

    Counts of bins add up, so each task sums its rows first, and windows run over bins, not over rows.
    """
    top, part = f"{top!r}e0", f"{part!r}e0"
    reached = f"upto >= ceil({part} * nall)"
    return (
        *frame,
        add(bin=f"least(floor(least(greatest({x}, 0), {top}) / {top} * {bins}), {bins - 1})"),
        Group(("date", "symbol", "bin"), (("m", "count(*)"), *sums)),
        add(upto=running("sum(m)", "bin"), nall=over("sum(m)")),
        add(last=over(f"min(CASE WHEN {reached} THEN bin END)"), edge=over(f"min(CASE WHEN {reached} THEN {top} * (bin + 1) / {bins} END)")),
    )


def ranked(frame: Frame, x: str, top: float, bins: int, part: float) -> Frame:
    """The plainer way to histogram's edge, on every row: rows are numbered in order of their bins."""
    top, part = f"{top!r}e0", f"{part!r}e0"
    return (
        *frame,
        add(bin=f"least(floor(least(greatest({x}, 0), {top}) / {top} * {bins}), {bins - 1})"),
        add(rank="row_number() OVER (PARTITION BY date, symbol ORDER BY bin)", nall=over("count(*)")),
        add(edge=over(f"min(CASE WHEN rank >= ceil({part} * nall) THEN {top} * (bin + 1) / {bins} END)")),
    )


def catalog(p: QuoteParams = QuoteParams()) -> dict[str, Feature]:
    found: dict[str, Feature] = {}

    def feat(name: str, frame: Frame, value: str, need: str | None = None, check: tuple[Frame, str] | None = None) -> None:
        found[f"quote_{name}_all"] = Feature(f"quote_{name}_all", "quotes", frame, when(need, value) if need else value, check)

    mean = div("sum(dt * val)", "sum(dt)")
    events = lambda cond: (Keep(f"{EVENTS} AND {cond}"),)

    # events of the session, each counting the same
    feat("cost_bps", events("ask > 0 AND bid > 0"), "avg(greatest((ask / bid - 1) * 10000, 0))")
    feat("spread", events(BOOK), f"avg({REL})")
    feat("lq_adjusted_spread", events(f"{BOOK} AND {SIZES}"), f"avg(greatest({REL}, 0) / ln(1 + asz + bsz))")
    feat("nbbo_ineligible_share", events("true"), share(flagged(p, "ineligible")))
    feat("nonfirm_manual_share", events("true"), share(flagged(p, "nonfirm", "manual")))
    rel = (*events(f"{BOOK} AND {SIZES}"), add(rel=f"greatest({REL}, 0)"))
    # imbalance * (1 - rel / edge) where rel is under the edge, summed by bins
    imbalance, under = "(bsz - asz) / (bsz + asz)", "rel < 0.5"
    sums = (("si", total(imbalance, under)), ("sr", total(f"{imbalance} * rel", under)))
    coupled = div("sum(CASE WHEN bin <= last THEN si - sr / edge ELSE 0 END)", "sum(m)")
    plain = f"avg({imbalance} * ({clip('1 - rel / nullif(edge, 0)')}))"
    feat("imbalance_spread_coupling", histogram(rel, "rel", 0.5, 512, 0.9, sums), coupled, check=(ranked(rel, "rel", 0.5, 512, 0.9), plain))
    latency = (*events("sip IS NOT NULL"), add(ms="greatest((sip - time) / 1e6, 0)"))
    late = ("ms", float(p.latency_max_ms), 1024, 0.95)
    feat("sip_latency_p95_event", histogram(latency, *late), "max(edge)", check=(ranked(latency, *late), "max(edge)"))

    # time-weighted
    feat("tw_spread", held(BOOK, f"greatest({REL}, 0)"), mean)
    micro = "(ask * bsz + bid * asz) / (asz + bsz)"
    feat("micro_premium_tw", held(f"{BOOK} AND {SIZES}", f"({micro} - {MID}) / {MID}"), mean)
    feat("micro_dir_consistency_tw", held(f"{BOOK} AND {SIZES}", f"CASE WHEN {micro} > {MID} THEN 1e0 ELSE 0e0 END"), mean)
    feat("size_imbalance_tw", held(SIZES, "(bsz - asz) / (bsz + asz)"), mean)
    feat("locked_crossed_share_tw", held("bid IS NOT NULL AND ask IS NOT NULL", "CASE WHEN ask <= bid THEN 1e0 ELSE 0e0 END"), mean)
    feat("same_venue_share_tw", held("time IS NOT NULL", "CASE WHEN ax IS NULL OR bx IS NULL THEN NULL WHEN ax = bx THEN 1e0 ELSE 0e0 END"), div("sum(dt * val)", "sum(CASE WHEN val IS NOT NULL THEN dt END)"))
    feat("sip_latency_mean_tw", held("sip IS NOT NULL", "(sip - time) / 1e6"), mean)
    feat("opening_flag_share_tw", held("time IS NOT NULL", f"CASE WHEN {flagged(p, 'opening')} THEN 1e0 ELSE 0e0 END"), mean)
    venues = (*held("time IS NOT NULL", "1e0"), add(venue="explode(array(ax, bx))"), Keep("dt > 0 AND venue IS NOT NULL"), Group(("date", "symbol", "venue"), (("t", "sum(dt)"),)))
    feat("bbo_dominance_hhi_tw", (*venues, add(p="t / sum(t) OVER (PARTITION BY date, symbol)")), "sum(p * p)")

    # neighbours: a pair counts if part of the stretch between its quotes is in the session
    mids = held(BOOK, MID)
    moved = f"pdt > 0 AND {apart('val', 'pval')}"
    feat("mid_change_intensity", mids, div(f"sum(CASE WHEN {moved} THEN 1e0 ELSE 0e0 END)", "sum(dt) / 60"))
    feat("mid_jitter_abs_event", held(f"{BOOK} AND bid + ask > 0", MID), "avg(CASE WHEN pdt > 0 THEN abs(ln(val / pval)) END)")
    feat("mid_jump_ratio", mids, share(f"abs(val - pval) / pval > CAST({p.jump_tau} AS DOUBLE)", "pdt > 0 AND pval > 0"))
    runs = (
        *mids,
        add(ch=f"CASE WHEN {apart('val', 'pval')} THEN 1 ELSE 0 END"),
        add(run=running("sum(ch)")),
        Group(("date", "symbol", "run"), (("sec", "sum(dt)"),)),
        Keep("sec > 0"),
    )
    lasting = ("sec", float(p.persist_max_sec), 512, 0.5)
    feat("mid_persistence_median", histogram(runs, *lasting), "max(edge)", check=(ranked(runs, *lasting), "max(edge)"))
    book = (*held("bid IS NOT NULL AND ask IS NOT NULL", "1e0"), add(pbid=lag("bid"), pask=lag("ask"), pbsz=lag("bsz"), pasz=lag("asz")))
    sized = (*held("bid IS NOT NULL AND ask IS NOT NULL AND bsz IS NOT NULL AND asz IS NOT NULL", "1e0"), add(pbid=lag("bid"), pask=lag("ask"), pbsz=lag("bsz"), pasz=lag("asz")))
    tol = (p.price_rtol, p.price_atol)
    feat("price_change_share", book, share(f"({apart('bid', 'pbid', *tol)}) OR ({apart('ask', 'pask', *tol)})", "pdt > 0"))
    tail = "sum(CASE WHEN nt IS NULL THEN dt ELSE 0 END)"

    def sides(amount, stable) -> str:
        """Mean over both sides of the amounts per second of pairs with a stable price, the time after the last quote counting too."""
        rates = [div(total(amount(s), f"pdt > 0 AND {stable(s)}"), f"{total('pdt', f'pdt > 0 AND {stable(s)}')} + {tail}") for s in ("b", "a")]
        price = [f"({r})" for r in rates]
        return f"coalesce(({price[0]} + {price[1]}) / 2, {price[0]}, {price[1]})"

    quote = {"b": "bid", "a": "ask"}
    feat("queue_depletion_rate", sized, sides(lambda s: f"greatest(p{s}sz - {s}sz, 0)", lambda s: f"{quote[s]} = p{quote[s]}"))
    size_tol = (p.size_rtol, p.size_atol)
    changed = lambda s: f"CASE WHEN {apart(f'{s}sz', f'p{s}sz', *size_tol)} THEN 6e1 ELSE 0e0 END"
    same = lambda s: f"NOT ({apart(quote[s], f'p{quote[s]}', *tol)})"
    feat("size_elasticity_frequency", sized, sides(changed, same))
    moves = [f"CASE WHEN pdt > 0 AND {same(s)} THEN abs({s}sz - p{s}sz) END" for s in ("b", "a")]
    feat("size_elasticity_magnitude", sized, div(" + ".join(f"coalesce(sum({m}), 0)" for m in moves), " + ".join(f"count({m})" for m in moves)))
    feat("update_intensity", held("seq IS NOT NULL", "seq"), div("sum(CASE WHEN pdt > 0 THEN greatest(val - pval, 0) ELSE 0 END)", "sum(dt) / 60"))
    order = (*held("seq IS NOT NULL AND sip IS NOT NULL", "seq"), add(psip=lag("sip")))
    feat("sip_out_of_order_rate", order, share("sip - psip <= 0", "pdt > 0 AND val - pval > 0"))
    places = (*held("time IS NOT NULL", "1e0"), add(pax=lag("ax"), pbx=lag("bx")))
    feat("venue_switch_rate", places, div("sum(CASE WHEN pdt > 0 AND ax <> pax THEN 1e0 ELSE 0e0 END) + sum(CASE WHEN pdt > 0 AND bx <> pbx THEN 1e0 ELSE 0e0 END)", "sum(dt) / 60"))

    # stretches in which the newest quote is older than the gap
    gap = int(p.stale_gap_ms * 1_000_000)
    sips = held("sip IS NOT NULL", "1e0", "sip")
    stale = f"greatest(0, least(coalesce(nt, close_ns), close_ns) - greatest(sip + {gap}, open_ns))"
    ahead = f"CASE WHEN pt IS NULL AND sip > open_ns THEN greatest(0, least(sip, close_ns) - (open_ns + {gap})) ELSE 0 END"
    feat("stale_quote_share", (*sips, add(st=f"{stale} + {ahead}")), clip("sum(st) / CAST(max(close_ns) - max(open_ns) AS DOUBLE)"))

    # intensity of mid changes against the symbols of the same tape
    tapes = (
        *mids,
        add(c1=f"CASE WHEN {moved} THEN 1e0 ELSE 0e0 END"),
        Group(("date", "symbol"), (("x", div("sum(c1)", "sum(dt) / 60")), ("tape", "min_by(tape, CASE WHEN tape IS NOT NULL THEN time END)"))),
        Keep("x IS NOT NULL AND tape IS NOT NULL"),
        add(mu="avg(x) OVER (PARTITION BY date, tape)", sd="stddev_samp(x) OVER (PARTITION BY date, tape)"),
    )
    feat("tape_mid_change_z", tapes, "max((x - mu) / nullif(sd, 0))", "max(sd) > 0")
    return found
