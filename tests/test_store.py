"""Bucketed tick tables: the same values, no exchange of ticks, days replaced one by one."""

import re

import pytest

from barloom.operators.catalog import features
from barloom.plans.engine import as_stored, deal, feature_table
from barloom.sources import store
from barloom.sources.ticks import derive

SF = "/root/testdata/sf0.001"
NAMES = ["twap", "rv_logret", "gini_absret", "qn_vol_logret", "run_count_total", "spearman_close_volume"]


@pytest.fixture
def table(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS kept LOCATION '{tmp_path}/kept'")
    yield "kept.bars"
    spark.sql("DROP TABLE IF EXISTS kept.bars")
    spark.sql("DROP DATABASE IF EXISTS kept CASCADE")


def test_stored_ticks_give_the_same_values_without_an_exchange(spark, table):
    bars, sample = derive(spark, SF, "bars"), derive(spark, SF, "sample")
    store.save(bars, table, buckets=4)
    own = [features()[n] for n in NAMES]
    got = feature_table(own, as_stored({"bars": store.read(spark, table)}, sample), sample)
    want = feature_table(own, deal({"bars": bars}, sample), sample)
    key = lambda rows: sorted((r.date, r.symbol, r.feature, None if r.value is None else f"{r.value:.9e}") for r in rows)
    assert key(got.collect()) == key(want.collect())
    # no exchange lies between a tick scan and the first grouping of its rows: those above group a few rows a day and symbol
    plan = feature_table([features()["rv_logret"]], as_stored({"bars": store.read(spark, table)}, sample), sample)._jdf.queryExecution().executedPlan().toString()
    branch = plan[: plan.index("FileScan parquet spark_catalog.kept.bars")]
    branch = branch[branch.rindex(":- ") if ":- " in branch else 0 :]
    assert "Window" in plan and not re.search(r"Exchange hashpartitioning\(date", branch.partition("Window")[2])


def test_days_are_replaced_one_by_one(spark, table):
    bars = derive(spark, SF, "bars")
    store.save(bars, table, buckets=4)
    days = store.days(spark, table)
    assert len(days) == 30 and store.days(spark, table, days[3], days[4]) == days[3:5]
    before = {r.date.isoformat(): r["count"] for r in store.read(spark, table).groupBy("date").count().collect()}
    store.save(bars.where(f"date = DATE '{days[3]}' AND symbol = 'click'"), table)
    after = {r.date.isoformat(): r["count"] for r in store.read(spark, table).groupBy("date").count().collect()}
    assert after[days[3]] < before[days[3]] and {d: n for d, n in after.items() if d != days[3]} == {d: n for d, n in before.items() if d != days[3]}
    assert store.read(spark, table, days[3], days[3]).select("symbol").distinct().count() == 1
    with pytest.raises(ValueError):
        store.save(bars.drop("vw"), table)
