"""Ticks derived from the events table: minute bars, quotes, trades and the daily sample of symbols.

The statements hold for Spark and for DuckDB; where the engines name a function differently, it is filled in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_DIALECT = {
    "spark": {"us": "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)", "second": "extract(second FROM ts)", "codes": "array"},
    "duckdb": {"us": "epoch_us(ts)", "second": "(extract(microsecond FROM ts) / 1000000.0)", "codes": "list_value"},
}

_SECONDS = "CAST(hour(ts) * 3600 + minute(ts) * 60 AS DOUBLE) + CAST({second} AS DOUBLE)"
_CLOSE = "(CAST(100 AS DOUBLE) + value / CAST(10 AS DOUBLE))"
_OPEN = f"({_CLOSE} + (CAST(event_id % 7 AS DOUBLE) - CAST(3 AS DOUBLE)) / CAST(10 AS DOUBLE))"

#: Bars: o h l c v n vw, sod the second of the day, mt minutes since 09:30, tau mt as a share of the session.
BARS = f"""SELECT date, symbol, time, tie, sod, (sod - 34200) / CAST(60 AS DOUBLE) AS mt, (sod - 34200) / CAST(23340 AS DOUBLE) AS tau,
o, h, l, c, v, n, (h + l + c) / CAST(3 AS DOUBLE) AS vw FROM (
SELECT date, symbol, time, tie, sod, o, c, v, n, greatest(o, c) + CAST(tie % 5 AS DOUBLE) / CAST(20 AS DOUBLE) AS h, least(o, c) - CAST(tie % 3 AS DOUBLE) / CAST(20 AS DOUBLE) AS l FROM (
SELECT CAST(ts AS DATE) AS date, event_type AS symbol, ts AS time, event_id AS tie, {_SECONDS} AS sod, {_OPEN} AS o, {_CLOSE} AS c,
CAST(1 + event_id % 97 AS DOUBLE) AS v, CAST(1 + event_id % 13 AS DOUBLE) AS n FROM events) priced) ranged"""

#: Quotes: time is the participant's clock in nanoseconds, local; open_ns and close_ns bound the session.
QUOTES = f"""SELECT date, symbol, time, tie, time + (tie % 40) * 1000000 AS sip, open_ns, open_ns + 23400000000000 AS close_ns, bid, bid + CAST(0.01 AS DOUBLE) * CAST(tie % 6 AS DOUBLE) AS ask,
CAST(1 + tie % 7 AS DOUBLE) AS bsz, CAST(1 + tie % 11 AS DOUBLE) AS asz, tie % 4 AS bx, tie % 3 AS ax, tie AS seq, {{codes}}(tie % 5) AS conditions, {{codes}}(tie % 9) AS indicators, length(symbol) % 3 AS tape FROM (
SELECT CAST(ts AS DATE) AS date, event_type AS symbol, {{us}} * 1000 AS time, event_id AS tie, ({{us}} - {{us}} % 86400000000 + 34200000000) * 1000 AS open_ns,
{_CLOSE} - CAST(0.01 AS DOUBLE) * CAST(1 + event_id % 4 AS DOUBLE) AS bid FROM events) priced"""

TRADES = f"""SELECT CAST(ts AS DATE) AS date, event_type AS symbol, ts AS time, event_id AS tie, {_SECONDS} AS sod, {_CLOSE} AS price, CAST(1 + event_id % 97 AS DOUBLE) AS size FROM events"""

#: The sample has one symbol a day, ZZZ, that no tick has.
SAMPLE = "SELECT DISTINCT CAST(ts AS DATE) AS date, event_type AS symbol FROM events UNION SELECT DISTINCT CAST(ts AS DATE) AS date, 'ZZZ' AS symbol FROM events"

STATEMENTS = {"bars": BARS, "quotes": QUOTES, "trades": TRADES, "sample": SAMPLE}


def statements(dialect: str) -> dict[str, str]:
    return {k: v.format(**_DIALECT[dialect]) for k, v in STATEMENTS.items()}


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A ticks table, or the sample, from the events of sf_dir."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return spark.sql(statements("spark")[name].replace("FROM events", "FROM {events}"), events=events)
