"""Runs features over daily files: python -m barloom.plans.run --sample DIR --bars DIR --out DIR [--only a,b] [--exclude c] [--set jump_tau=0.001]."""

from __future__ import annotations

import argparse
import datetime as dt

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.catalog import QuoteParams, features
from ..sources import files, sinks, store
from .engine import as_stored, deal, feature_table, grouped, status
from .feature import Feature


def chosen(only: str = "", exclude: str = "", params: QuoteParams | None = None) -> list[Feature]:
    """Features by comma-separated names; a name that isn't known is an error."""
    known = features(params)
    names, out = [n for n in only.split(",") if n], {n for n in exclude.split(",") if n}
    if unknown := {*names, *out} - set(known):
        raise KeyError(f"no such feature: {sorted(unknown)}")
    return [f for n, f in known.items() if (not names or n in names) and n not in out]


def write(table: DataFrame, a: argparse.Namespace) -> None:
    sinks.write_single(table, a.out) if a.single else sinks.write_partitions(table, a.out, a.overwrite)


def run_all(own: list[Feature], dealt: dict[str, DataFrame], sample: DataFrame, a: argparse.Namespace) -> dict[str, str]:
    """Writes all features, many in a job; where a job fails, its features run alone. Errors by feature."""
    errors: dict[str, str] = {}
    for group in grouped(own):
        try:
            write(feature_table(group, dealt, sample), a)
        except (PySparkException, Py4JError):
            for f in group:
                try:
                    write(feature_table([f], dealt, sample), a)
                except (PySparkException, Py4JError) as e:
                    errors[f.name] = f"error: {str(e).splitlines()[0]}"
    return errors


def report(own: list[Feature], days: list[str], sample: DataFrame, before: DataFrame | None, errors: dict[str, str], a: argparse.Namespace) -> DataFrame:
    """Rows (feature, date, status): exists (was there, and left), skip (no ticks or no sample that day), error, empty or ok."""
    spark = sample.sparkSession
    names = F.array(*[F.struct(F.lit(f.name).alias("feature"), F.lit(errors.get(f.name)).cast("string").alias("error")) for f in own])
    dates = sample.select("date").distinct()
    asked = dates.select("date", F.inline(names))
    # of what is there, the asked days alone are opened
    written = spark.read.parquet(a.out).where(F.col("date").isin([r.date for r in dates.toLocalIterator()]))
    out = asked.join(status(written).select("feature", "date", "status"), ["feature", "date"], "left")
    old = F.lit(False)
    if before is not None and not a.overwrite:
        out = out.join(before.withColumn("old", F.lit(True)), ["feature", "date"], "left")
        old = F.coalesce("old", F.lit(False))
    known = F.col("date").isin([dt.date.fromisoformat(d) for d in days])
    state = F.when(old, "exists").when(~known, "skip").when(F.col("error").isNotNull(), F.col("error")).otherwise(F.coalesce("status", F.lit("skip")))
    return out.select("feature", "date", state.alias("status"))


def table_of(root: str) -> str:
    """The name of a table of sources.store, given as table:NAME in place of a folder."""
    return root.removeprefix("table:") if root.startswith("table:") else ""


def main(args: list[str] | None = None) -> DataFrame | None:
    p = argparse.ArgumentParser(description=__doc__)
    for name in ("sample", "out"):
        p.add_argument(f"--{name}", required=True)
    for name in ("bars", "quotes", "trades", "start", "end", "only", "exclude"):
        p.add_argument(f"--{name}", default="")
    p.add_argument("--layout", default="auto", choices=["auto", "onefile", "dir"])
    p.add_argument("--date-source", default="intersect", choices=["sample", "ticks", "intersect"])
    p.add_argument("--set", action="append", default=[], metavar="NAME=VALUE", help="a threshold or code set of the quote features, as opening_conditions=1,16")
    p.add_argument("--tz", default=files.EXCHANGE_TZ)
    p.add_argument("--overwrite", action="store_true")
    p.add_argument("--single", action="store_true")
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("features").getOrCreate()
    own = [f for f in chosen(a.only, a.exclude, QuoteParams.of(a.set)) if getattr(a, f.source)]
    sources = sorted({f.source for f in own})
    start, end = a.start or None, a.end or None
    whole = files.read_sample(spark, a.sample, start, end)
    roots = {k: getattr(a, k) for k in sources}
    tables = {k: table_of(r) for k, r in roots.items() if table_of(r)}
    found = [set(store.days(spark, tables[k], start, end) if k in tables else files.tick_days(spark, r, files.layout_for(spark, r, k, a.layout), start, end)) for k, r in roots.items()]
    days = sorted(set.intersection(*found)) if found else []
    if not days:
        raise FileNotFoundError("no day has ticks")
    sample = whole if a.date_source == "sample" else files.on_days(whole, days)
    ticks = {k: files.read_ticks(spark, r, k, a.layout, a.tz, days[0], days[-1]) for k, r in roots.items() if k not in tables}
    kept = {k: store.read(spark, t, days[0], days[-1]) for k, t in tables.items()}
    dealt = {k: df.persist() for k, df in deal(ticks, files.on_days(whole, days)).items()} | as_stored(kept, files.on_days(whole, days))
    before = None if a.single else sinks.done(spark, a.out)
    if before is not None:  # partitions by name, which the driver lists anyway; what follows writes among them
        before = spark.createDataFrame(before.toArrow())
    errors = run_all(own, dealt, files.on_days(whole, days), a)
    if a.single:
        return None
    out = report(own, days, sample, before, errors, a)
    out.groupBy("status").count().show(truncate=False)
    return out


if __name__ == "__main__":
    main()
