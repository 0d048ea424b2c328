"""File sources, sinks, the engine's plan and the stream."""

import datetime as dt

import pandas as pd
import pytest

from barloom.operators.catalog import features
from barloom.plans import run
from barloom.plans.engine import deal, feature_table, status
from barloom.plans.feature import one
from barloom.plans.run import chosen
from barloom.sources import files, sinks
from barloom.sources.ticks import derive

SF = "/root/testdata/sf0.01"


@pytest.fixture()
def daily(tmp_path):
    times = pd.to_datetime(["2024-03-04 09:30", "2024-03-04 09:31", "2024-03-04 16:30"])
    bars = pd.DataFrame({"symbol": ["A", "A", "A"], "time": times.astype("datetime64[us]"), "close": ["1.5", "2.5", "x"], "volume": [1.0, float("inf"), 3.0]})
    for root in ("bars", "sample", "trades/20240304"):
        (tmp_path / root).mkdir(parents=True)
    bars.to_parquet(tmp_path / "bars/20240304.parquet")
    bars.to_parquet(tmp_path / "bars/notes.parquet")
    pd.DataFrame({"symbol": ["A", "B"]}).to_parquet(tmp_path / "sample/2024_3_4.parquet")
    ns = int(pd.Timestamp("2024-03-04 10:00", tz="America/New_York").value)
    pd.DataFrame({"participant_timestamp": [ns, ns + 7 * 3600 * 10**9], "price": [10.0, 11.0], "size": [3.0, 4.0]}).to_parquet(tmp_path / "trades/20240304/A.parquet")
    return tmp_path


def test_bars_and_sample(spark, daily):
    got = files.read_ticks(spark, str(daily / "bars"), "bars").orderBy("time").toPandas()
    assert len(got) == 3 and got.c.tolist()[:2] == [1.5, 2.5] and pd.isna(got.c[2]) and pd.isna(got.v[1])
    sample = files.read_sample(spark, str(daily / "sample"))
    assert {r.symbol for r in sample.collect()} == {"A", "B"}
    assert files.read_sample(spark, str(daily / "sample"), start="2024-03-05").count() == 0
    value = one(features()["twap"], files.read_ticks(spark, str(daily / "bars"), "bars"), sample).toPandas().set_index("symbol").value
    assert value["A"] == 2 and pd.isna(value["B"])
    assert files.on_days(sample, ["2024-03-04"]).count() == 2 and files.on_days(sample, []).count() == 0
    assert list(files.tick_days(spark, str(daily / "bars"), "onefile")) == ["2024-03-04"]


def test_trades_in_a_folder_a_symbol(spark, daily):
    trades = files.read_ticks(spark, str(daily / "trades"), "trades")
    got = one(features()["trade_rth_dollar_volume"], trades, files.read_sample(spark, str(daily / "sample"))).toPandas().set_index("symbol").value
    assert got["A"] == 30


def test_partitions_are_skipped_or_replaced(spark, tmp_path):
    rows = lambda v: spark.createDataFrame([(dt.date(2024, 3, 4), "A", "f", v)], "date date, symbol string, feature string, value double")
    root = str(tmp_path / "out")
    for value, overwrite, kept in ((1.0, False, 1.0), (2.0, False, 1.0), (3.0, True, 3.0)):
        sinks.write_partitions(rows(value), root, overwrite)
        assert [r.value for r in spark.read.parquet(root).collect()] == [kept]
    sinks.write_single(rows(4.0), str(tmp_path / "single"))
    assert set(spark.read.parquet(str(tmp_path / "single")).columns) == {"time", "symbol", "value", "feature"}
    with pytest.raises(ValueError):
        sinks.check(rows(1.0).drop("value"))


def test_runs_over_days(spark, tmp_path):
    """Two jobs, three days of ticks and two of samples, one asked for at a time; a feature that fails; what is there stays."""
    for day, stamp in (("20240304", "2024_3_4"), ("20240305", "2024_3_5"), ("20240306", "")):
        (tmp_path / "bars").mkdir(exist_ok=True)
        (tmp_path / "sample").mkdir(exist_ok=True)
        times = pd.date_range(f"{day} 09:30", periods=30, freq="min").astype("datetime64[us]")
        pd.DataFrame({"symbol": "A", "time": times, "close": [10 + k % 7 for k in range(30)], "volume": 1.0, "n": 1.0}).to_parquet(tmp_path / f"bars/{day}.parquet")
        if stamp:
            pd.DataFrame({"symbol": ["A", "B"]}).to_parquet(tmp_path / f"sample/{stamp}.parquet")
    pd.DataFrame({"symbol": ["A"]}).to_parquet(tmp_path / "sample/2024_3_9.parquet")
    at = {k: str(tmp_path / k) for k in ("bars", "sample", "out", "single")}
    only = "twap,rv_logret,garman_klass_session_vol"  # the bars have no high
    base = ["--sample", at["sample"], "--bars", at["bars"], "--only", only]
    states = lambda df: {(r.feature, str(r.date)): r.status.partition(":")[0] for r in df.collect()}
    first = states(run.main([*base, "--out", at["out"], "--start", "2024-03-05", "--end", "2024-03-05"]))
    assert first == {("twap", "2024-03-05"): "ok", ("rv_logret", "2024-03-05"): "ok", ("garman_klass_session_vol", "2024-03-05"): "error"}
    opened = files.read_ticks(spark, at["bars"], "bars", start="2024-03-05", end="2024-03-05").inputFiles()
    assert [f[-16:] for f in opened] == ["20240305.parquet"]
    both = states(run.main([*base, "--out", at["out"], "--date-source", "sample"]))
    assert both["twap", "2024-03-04"] == "ok" and both["twap", "2024-03-05"] == "exists" and both["twap", "2024-03-09"] == "skip"
    for name in ("twap", "rv_logret"):  # two jobs into one root
        run.main(["--sample", at["sample"], "--bars", at["bars"], "--only", name, "--single", "--out", at["single"]])
    assert {r.feature for r in spark.read.parquet(at["single"]).collect()} == {"twap", "rv_logret"}
    assert files.read_ticks(spark, at["bars"], "bars", symbol="A").count() == 90 and files.read_ticks(spark, at["bars"], "bars", symbol="B").count() == 0
    with pytest.raises(FileNotFoundError):
        run.main([*base, "--out", at["out"], "--start", "2025-01-01"])


def test_times_of_any_kind(spark):
    """Epochs as numbers and strings, local times, and those that the clock skips or shows twice."""
    ns = int(pd.Timestamp("2024-03-04 10:00", tz="America/New_York").value)
    want = int(pd.Timestamp("2024-03-04 10:00").value)
    df = spark.createDataFrame([(ns, str(ns), float(ns // 1024 * 1024), "2024-03-04T10:00:00-05:00")], "a bigint, b string, c double, d string")
    df = df.withColumn("e", df.a.cast("decimal(30,0)"))
    got = df.select(*[files.local_nanos(df, k).alias(k) for k in df.columns]).first()
    assert got.a == got.b == got.d == got.e == want and abs(got.c - want) < 2048
    text = ["2024-03-10 02:30:00", "2024-11-03 01:30:00", "2024-11-03 03:30:00"]
    df = spark.createDataFrame([(t,) for t in text], "t string").selectExpr("CAST(t AS TIMESTAMP_NTZ) AS t")
    got = [r.x for r in df.select(files.local_nanos(df, "t").alias("x")).collect()]
    assert got == [int(pd.Timestamp("2024-03-10 03:00").value), None, int(pd.Timestamp(text[2]).value)]


def test_engine_agrees_with_single_features(spark):
    names = ["twap", "std_close", "rv_logret", "max_up_run_len", "quote_spread_all"]
    own = chosen(",".join(names))
    sample = derive(spark, SF, "sample")
    dealt = deal({s: derive(spark, SF, s) for s in ("bars", "quotes")}, sample)
    table = feature_table(own, dealt, sample).toPandas()
    assert len(table) == sample.count() * len(names)
    for f in own:
        want = one(f, derive(spark, SF, f.source), sample).toPandas().set_index(["date", "symbol"]).value.sort_index()
        got = table[table.feature == f.name].set_index(["date", "symbol"]).value.sort_index()
        pd.testing.assert_series_equal(got, want)
    assert {r.status for r in status(spark.createDataFrame(table.head(1), "date date, symbol string, feature string, value double")).collect()} <= {"ok", "empty"}
    with pytest.raises(KeyError):
        chosen("nothing")


def test_stream_ends_at_the_days_value(spark, tmp_path):
    from barloom.streaming.quotes import event_means, tw_spread

    quotes = derive(spark, "/root/testdata/sf0.001", "quotes").select("date", "symbol", "time", "tie", "open_ns", "close_ns", "bid", "ask")
    quotes = quotes.selectExpr("*", "timestamp_micros(time div 1000) AS ts").orderBy("time")
    quotes.coalesce(1).write.parquet(str(tmp_path / "in"))
    # a day later: the watermark passes all closes, and an old quote comes too late
    more = quotes.orderBy("time", ascending=False).limit(1)
    after = more.selectExpr("ts + INTERVAL 2 DAYS AS ts", "date_add(date, 2) AS date", "symbol", "time + 172800000000000 AS time", "tie", "open_ns + 172800000000000 AS open_ns", "close_ns + 172800000000000 AS close_ns", "bid", "ask").select(quotes.columns)
    stream = spark.readStream.schema(quotes.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = tw_spread(stream).writeStream.outputMode("update").format("memory").queryName("spreads").start()
    query.processAllAvailable()
    after.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    query.processAllAvailable()
    query.processAllAvailable()
    query.stop()
    last = spark.table("spreads").toPandas()
    in_time = last.date <= quotes.agg({"date": "max"}).first()[0]
    got = last[~last.final & in_time].set_index(["date", "symbol"]).value.sort_index()
    sample = derive(spark, "/root/testdata/sf0.001", "sample").where("symbol <> 'ZZZ'")
    want = one(features()["quote_tw_spread_all"], derive(spark, "/root/testdata/sf0.001", "quotes"), sample).toPandas().set_index(["date", "symbol"]).value.dropna().sort_index()
    pd.testing.assert_series_equal(got.dropna(), want.loc[got.dropna().index], rtol=1e-9)
    assert len(want) == len(got.dropna())
    final = last[last.final & in_time].set_index(["date", "symbol"]).value.sort_index()  # each day's state was freed, with its value
    assert len(final) >= len(got) - 10  # the newest days' closes may not have passed yet
    pd.testing.assert_series_equal(final, got.loc[final.index], rtol=1e-12)
    query = event_means(stream).writeStream.outputMode("complete").format("memory").queryName("means").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("means").count() > 0
