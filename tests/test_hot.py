"""Symbol-days cut in time against the same days in one piece."""

import pytest
from pyspark.sql import functions as F

from barloom.operators.catalog import QuoteParams, features
from barloom.plans import hot
from barloom.plans.engine import deal, feature_table
from barloom.sources.ticks import derive

SF = "/root/testdata/sf0.001"
PARAMS = QuoteParams(opening_conditions=(1,), ineligible_indicators=(2,), manual_conditions=(3,))


def table(spark, own, quotes, sample):
    dealt = {n: df.persist() for n, df in deal({"quotes": quotes}, sample).items()}
    rows = feature_table(own, dealt, sample).collect()
    return {(r.date, r.symbol, r.feature): r.value for r in rows}, dealt


def test_all_quote_features_of_cut_days(spark, monkeypatch):
    own = [f for f in features(PARAMS).values() if f.source == "quotes"]
    # some rows at one time, some without a side
    quotes = derive(spark, SF, "quotes").withColumn("time", F.expr("time - time % 600000000000 * if(tie % 5 = 0, 1, 0)")).withColumn("bid", F.expr("if(tie % 13 = 0, NULL, bid)"))
    sample = derive(spark, SF, "sample")
    want, dealt = table(spark, own, quotes, sample)
    assert "quotes_hot" not in dealt
    monkeypatch.setattr(hot, "HOT", 7)
    monkeypatch.setattr(hot, "CHUNK", 2)
    got, dealt = table(spark, own, quotes, sample)
    assert dealt["quotes_hot"].groupBy("date", "symbol").agg(F.countDistinct("chunk").alias("n")).agg(F.min("n")).first()[0] > 2
    assert dealt["quotes"].count() > 0  # smaller days stay whole
    assert got.keys() == want.keys() and len(want) > 1000
    for key, value in want.items():
        assert got[key] == pytest.approx(value, rel=1e-9, abs=1e-12) if value is not None else got[key] is None, key


def test_chunks_are_even(spark):
    quotes = spark.range(300_000).selectExpr("DATE '2024-03-04' date", "'A' symbol", "1709544600000000000 + id * 78000000 time", "id tie")
    rest, large = hot.cut(quotes, hot=100_000, chunk=20_000)
    assert rest.isEmpty()
    sizes = [r["count"] for r in large.groupBy("chunk").count().collect()]
    assert len(sizes) == 15 and max(sizes) < 21_000


def test_no_hot_day(spark):
    quotes = derive(spark, SF, "quotes")
    assert hot.cut(quotes)[1] is None
    assert hot.cut(quotes.where("false"), hot=1, chunk=1)[1] is None
