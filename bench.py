"""Times the feature plan and single features over $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from barloom.operators.catalog import features
from barloom.plans import registry
from barloom.plans.engine import deal, jobs
from barloom.sources.ticks import derive

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SINGLE = ["rv_logret", "corr_absret_volume", "run_count_total", "gini_absret", "qn_vol_logret", "quote_tw_spread_all", "trade_rth_dollar_volume"]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known, took = registry.queries(), {}

    def timed(name: str, df) -> None:
        began = time.time()
        df.write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)

    timed("warm_up", known["twap"](spark, SF_DIR))
    for name in SINGLE:
        timed(name, known[name](spark, SF_DIR))
    ticks = {s: derive(spark, SF_DIR, s) for s in ("bars", "quotes", "trades")}
    sample = derive(spark, SF_DIR, "sample").persist()
    dealt = {name: df.persist() for name, df in deal(ticks, sample).items()}
    for source in ("trades", "quotes", "bars"):
        own = [f for f in features().values() if f.source == source]
        for k, table in enumerate(jobs(own, dealt, sample)):
            timed(f"all_{len(own)}_{source}_{k}", table)
    took.pop("warm_up")
    print(json.dumps({"metric": "all features, seconds", "value": round(sum(v for k, v in took.items() if k.startswith("all_")), 3), "unit": "sec", "queries": took, "sf": SF_DIR.rpartition("sf")[2]}))
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
