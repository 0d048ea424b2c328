"""Quote features over a stream of quotes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def event_means(quotes: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Quoted cost in basis points and relative spread, means of the session's events per day and symbol.

    quotes needs ts (event time), date, symbol, time, open_ns, close_ns, bid and ask. A day's row is final when the
    watermark, late behind the newest event, has passed its end.
    """
    good = quotes.where("time >= open_ns AND time < close_ns AND bid > 0 AND ask > 0").withWatermark("ts", late)
    return (
        good.groupBy(F.window("ts", "1 day"), "symbol")
        .agg(F.avg(F.greatest((F.col("ask") / F.col("bid") - 1) * 10000, F.lit(0.0))).alias("cost_bps"), F.avg(F.expr("2 * (ask - bid) / (bid + ask)")).alias("spread"), F.count("*").alias("events"))
        .select(F.col("window.start").cast("date").alias("date"), "symbol", "cost_bps", "spread", "events")
    )


def tw_spread(quotes: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Time-weighted relative spread per day and symbol: a row for each that got quotes in the batch, and a final one.

    quotes needs ts (event time), date, symbol, time, tie, open_ns, close_ns, bid and ask. The state of a day and symbol is its
    newest quote and a few sums. The value holds the newest quote until the close, as the finished day's feature does. Quotes
    older than the newest one of an earlier batch are left out and counted as late. When the watermark, late behind the newest
    event, passes the close, the last row comes with final true and the state is freed; quotes of that day that come still later are
    dropped by the watermark.
    """

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, value, area, weight, dropped, opens, closes = state.get if state.exists else (None, 0.0, 0.0, 0.0, 0, 0, 0)
        ended = state.hasTimedOut
        ends_ms = None
        for pdf in () if ended else batches:
            pdf = pdf[(pdf.bid + pdf.ask) > 0].sort_values(["time", "tie"], kind="stable")
            if pdf.empty:
                continue
            opens, closes = int(pdf.open_ns.iloc[0]), int(pdf.close_ns.iloc[0])
            # event time may be in another zone than time: the close is as far from both
            ends_ms = int(pdf.ts.iloc[0].timestamp() * 1000) + (closes - int(pdf.time.iloc[0])) // 1_000_000
            if last is not None:
                dropped += int((pdf.time < last).sum())
                pdf = pdf[pdf.time >= last]
                if pdf.empty:
                    continue
            spread = np.maximum(2 * (pdf.ask - pdf.bid) / (pdf.ask + pdf.bid), 0).to_numpy(np.float64)
            times = pdf.time.to_numpy(np.int64)
            if last is not None:
                times, spread = np.append(last, times), np.append(value, spread)
            held = np.maximum(0, np.minimum(times[1:], closes) - np.maximum(times[:-1], opens)) / 1e9
            area, weight = area + float(held @ spread[:-1]), weight + float(held.sum())
            last, value = int(times[-1]), float(spread[-1])
        if last is None:
            return
        if ended:
            state.remove()
        else:
            state.update((last, value, area, weight, dropped, opens, closes))
            if ends_ms is not None:
                state.setTimeoutTimestamp(max(ends_ms, state.getCurrentWatermarkMs() + 1))
        tail = max(0, closes - max(last, opens)) / 1e9
        whole = weight + tail
        yield pd.DataFrame({"date": [key[0]], "symbol": [key[1]], "value": [(area + tail * value) / whole if whole else None], "late": [dropped], "final": [ended]})

    rows = quotes.select("ts", "date", "symbol", "time", "tie", "open_ns", "close_ns", "bid", "ask").withWatermark("ts", late)
    kept = "last long, value double, area double, weight double, late long, opens long, closes long"
    return rows.groupBy("date", "symbol").applyInPandasWithState(update, "date date, symbol string, value double, late long, final boolean", kept, "update", GroupStateTimeout.EventTimeTimeout)
