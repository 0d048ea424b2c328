"""Ticks and samples from daily Parquet files, in either layout.

onefile: root/YYYYMMDD.parquet with a symbol column. dir: root/YYYYMMDD/SYMBOL.parquet, the symbol taken from the
name. Samples are root/Y_M_D.parquet. Dates come from the paths; a file whose name is no date is left out.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EXCHANGE_TZ = "America/New_York"
#: Names under which a time column may go, best first.
TIME_NAMES = ("participant_timestamp", "sip_timestamp", "trade_timestamp", "timestamp", "ts", "time", "datetime")
NUMBERS = {"bars": ("open", "high", "low", "close", "volume", "n", "vwap"), "quotes": ("bid_price", "ask_price", "bid_size", "ask_size"), "trades": ("price", "size")}
SHORT = {"open": "o", "high": "h", "low": "l", "close": "c", "volume": "v", "n": "n", "vwap": "vw", "bid_price": "bid", "ask_price": "ask", "bid_size": "bsz", "ask_size": "asz"}


def number(column: str) -> Column:
    """A finite double, or null: not a number, infinite and unreadable values are null alike."""
    x = F.expr(f"try_cast(`{column}` AS DOUBLE)")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None)).otherwise(x)


def time_column(df: DataFrame, names: tuple[str, ...] = TIME_NAMES) -> str:
    """The first of names that is a column, exactly or else in any case."""
    low = {c.lower(): c for c in df.columns}
    for name in names:
        if name in df.columns:
            return name
    for name in names:
        if name.lower() in low:
            return low[name.lower()]
    raise ValueError(f"no time column among {df.columns}")


def _wall(local: Column, tz: str) -> Column:
    """A wall-clock time as it is; one that the clock skips is the next there is, one that it shows twice is null."""
    utc = F.to_utc_timestamp(local, tz)
    back, later = F.from_utc_timestamp(utc, tz), F.from_utc_timestamp(utc + F.expr("INTERVAL 1 HOUR"), tz)
    return F.when(back != local, F.date_trunc("hour", back)).when(later != local, local)


def local_nanos(df: DataFrame, column: str, tz: str = EXCHANGE_TZ) -> Column:
    """Wall-clock nanoseconds: numbers, also in strings, are nanoseconds UTC, times without a zone are local, others are converted."""
    kind = dict(df.dtypes)[column]
    c = F.col(column)

    def of_number(ns: Column) -> Column:
        wall = F.from_utc_timestamp(F.timestamp_micros(F.floor(ns / F.lit(1000).cast("decimal(10,0)")).cast("bigint")), tz)
        return F.unix_micros(wall) * 1000 + ns.cast("bigint") % 1000

    if kind in ("bigint", "int", "float", "double") or kind.startswith("decimal"):
        return of_number(F.expr(f"try_cast(`{column}` AS DECIMAL(20, 0))"))
    if kind == "timestamp_ntz":
        micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', `{column}`)")
        return F.unix_micros(_wall(F.timestamp_micros(micros), tz)) * 1000
    if kind == "timestamp":
        return F.unix_micros(F.from_utc_timestamp(c, tz)) * 1000
    zoned = F.unix_micros(F.from_utc_timestamp(F.expr(f"try_to_timestamp(CAST(`{column}` AS STRING))"), tz)) * 1000
    epoch = F.expr(f"try_cast(trim(CAST(`{column}` AS STRING)) AS DECIMAL(20, 0))")
    return F.when(F.trim(c.cast("string")).rlike(r"^\d{12,19}(\.\d*)?$"), of_number(epoch)).otherwise(zoned)


def tick_days(spark: SparkSession, root: str, layout: str, start: str | None = None, end: str | None = None) -> dict[str, str]:
    """Path of each day (YYYY-MM-DD) from start to end that root has, found by listing names alone."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    kind = r"(\d{4})(\d\d)(\d\d)" + (r"\.parquet" if layout == "onefile" else "")
    out = {}
    for found in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, "*")) or []:
        if m := re.fullmatch(kind, found.getPath().getName()):
            try:
                day = dt.date(*map(int, m.groups())).isoformat()
            except ValueError:
                continue
            if (not start or day >= start) and (not end or day <= end):
                out[day] = found.getPath().toString()
    return out


def _raw(spark: SparkSession, root: str, layout: str, start: str | None, end: str | None, symbol: str | None) -> DataFrame:
    days = tick_days(spark, root, layout, start, end)
    if not days:
        raise FileNotFoundError(f"no ticks under {root} from {start} to {end}")
    paths = list(days.values())
    if layout == "dir" and symbol is None:
        paths = [f"{p}/*.parquet" for p in paths]
    elif layout == "dir":
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        own = [hadoop(f"{p}/{symbol}.parquet") for p in paths]
        paths = [p.toString() for p in own if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)]
        if not paths:
            raise FileNotFoundError(f"no ticks of {symbol} under {root}")
    df = spark.read.option("mergeSchema", "true").parquet(*paths).withColumn("file", F.col("_metadata.file_path"))
    name = r"/(\d{8})\.parquet$" if layout == "onefile" else r"/(\d{8})/[^/]+\.parquet$"
    df = df.withColumn("day", F.regexp_extract("file", name, 1)).where("day <> ''").withColumn("date", F.expr("CAST(try_to_timestamp(day, 'yyyyMMdd') AS DATE)")).where("date IS NOT NULL")
    if layout == "dir":
        df = df.withColumn("symbol", F.regexp_extract("file", r"/([^/]+)\.parquet$", 1))
    if symbol is not None:
        df = df.where(F.col("symbol") == symbol)
    return df.drop("file", "day")


def layout_of(spark: SparkSession, root: str, prefer: str = "onefile") -> str:
    """The layout of a root that has one, or the preferred one where both are there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    has = {"onefile": bool(fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, "*.parquet"))), "dir": bool(fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, "*/*.parquet")))}
    if not any(has.values()):
        raise FileNotFoundError(f"no ticks under {root}")
    return prefer if has[prefer] else next(k for k, v in has.items() if v)


def layout_for(spark: SparkSession, root: str, kind: str, layout: str = "auto") -> str:
    """The layout asked for, or the one found; trades prefer a folder of symbols."""
    return layout_of(spark, root, "dir" if kind == "trades" else "onefile") if layout == "auto" else layout


def read_ticks(
    spark: SparkSession, root: str, kind: str, layout: str = "auto", tz: str = EXCHANGE_TZ, start: str | None = None, end: str | None = None, symbol: str | None = None
) -> DataFrame:
    """Ticks of a kind (bars, quotes or trades) in the form that features take.

    Only files of days from start to end are opened; with symbol only its rows, or its file of a day, are read.
    Rows without a time, or with no number at all, are left out. Ties in time are in no fixed order of the files, so
    tie is a hash of the row.
    """
    layout = layout_for(spark, root, kind, layout)
    df = _raw(spark, root, layout, start, end, symbol)
    own = [c for c in NUMBERS[kind] if c in df.columns]
    at = time_column(df, ("time", *TIME_NAMES) if kind == "bars" else TIME_NAMES)
    df = df.withColumn("ns", local_nanos(df, at, tz)).where("ns IS NOT NULL")
    df = df.withColumns({c: number(c) for c in own}).dropna(how="all", subset=own)
    day_ns = F.datediff(F.col("date"), F.lit("1970-01-01")).cast("bigint") * 86_400_000_000_000
    df = df.withColumn("tie", F.xxhash64(*[c for c in df.columns if not dict(df.dtypes)[c].startswith("array")])).withColumn("sod", (F.col("ns") - day_ns) / 1e9)
    if kind == "quotes":
        open_ns = day_ns + 34_200_000_000_000
        df = df.withColumns({"open_ns": open_ns, "close_ns": open_ns + 23_400_000_000_000, "time": F.col("ns")})
        if "sip_timestamp" in df.columns:
            df = df.withColumn("sip", local_nanos(df, "sip_timestamp", tz))
        df = df.withColumnsRenamed({"sequence_number": "seq", "bid_exchange": "bx", "ask_exchange": "ax"})
    else:
        df = df.withColumn("time", F.timestamp_micros((F.col("ns") / 1000).cast("bigint")))
    if kind == "bars":
        df = df.withColumns({"mt": (F.col("sod") - 34200) / 60.0, "tau": (F.col("sod") - 34200) / 23340.0})
    return df.withColumnsRenamed({k: v for k, v in SHORT.items() if k in own})


def read_sample(spark: SparkSession, root: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows (date, symbol) of the days from start to end; files whose name is no date are left out."""
    df = spark.read.parquet(f"{root.rstrip('/')}/*.parquet").select("symbol", F.col("_metadata.file_path").alias("file"))
    name = F.regexp_extract("file", r"/(\d{4}_\d{1,2}_\d{1,2})\.parquet$", 1)
    df = df.withColumn("date", F.expr("CAST(try_to_timestamp(regexp_extract(file, '/([0-9]{4}_[0-9]{1,2}_[0-9]{1,2})[.]parquet$', 1), 'yyyy_M_d') AS DATE)")).where(name != "").where("date IS NOT NULL AND symbol IS NOT NULL")
    for cond, day in ((">=", start), ("<=", end)):
        if day:
            df = df.where(f"date {cond} DATE '{day}'")
    return df.select("date", "symbol").distinct()


def on_days(sample: DataFrame, days: list[str]) -> DataFrame:
    """The sample's rows of the given days, which tick_days lists."""
    return sample.where(F.col("date").isin([dt.date.fromisoformat(d) for d in days]))
