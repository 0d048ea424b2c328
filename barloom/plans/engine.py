"""Many features in one plan: ticks are dealt out by day and symbol once, and features with a frame in common share it."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .feature import Feature, by_frame, values
from .frame import KEYS
from .hot import cut

#: Aggregates of one plan node (more make methods that the JVM doesn't compile), and frames of one job.
BATCH, FRAMES = 40, 20


def deal(ticks: dict[str, DataFrame], sample: DataFrame) -> dict[str, DataFrame]:
    """Ticks of the sample's days and symbols, dealt out by them and in order of time: persist it, and no frame sorts or deals again.

    Every window, grouping and array of the features is by these keys, or by these and more, and nearly all windows run in
    this order. Symbol-days of very many quotes are dealt out apart, in chunks of time, as quotes_hot.
    """
    days = sample.select(*KEYS).distinct()
    # a count of its own is kept, so that what is persisted still fits the features' groupings
    parts = int(sample.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own, out = {name: df.join(days, list(KEYS), "left_semi") for name, df in ticks.items()}, {}
    if "quotes" in own:
        own["quotes"], large = cut(own["quotes"])
        if large is not None:
            out["quotes_hot"] = large
    return out | {name: df.repartition(parts, *KEYS).sortWithinPartitions(*KEYS, "time", "tie") for name, df in own.items()}


def as_stored(ticks: dict[str, DataFrame], sample: DataFrame) -> dict[str, DataFrame]:
    """As deal(), for ticks of sources.store, whose buckets hold each symbol's rows together: they stay where they are.

    The sample is broadcast where Spark finds it small enough; symbol-days of very many quotes are cut as in deal().
    """
    days = sample.select(*KEYS).distinct()
    own, out = {name: df.join(days, list(KEYS), "left_semi") for name, df in ticks.items()}, {}
    if "quotes" in own:
        own["quotes"], large = cut(own["quotes"])
        if large is not None:
            out["quotes_hot"] = large
    return out | own


def feature_table(features: list[Feature], dealt: dict[str, DataFrame], sample: DataFrame) -> DataFrame:
    """Rows (date, symbol, feature, value) for each day and symbol of the sample and each feature.

    Each frame gives a row of values a day and symbol; an empty row of the sample stands beside it, and one grouping takes the two
    together. There is no join, and frames don't wait for each other.
    """
    days, parts, names = sample.select(*KEYS).distinct(), [], []
    for (source, _), group in by_frame(features).items():
        for lo in range(0, len(group), BATCH):
            some = group[lo : lo + BATCH]
            found = F.array(*[F.col(f.name) for f in some])
            parts.append(values(some, dealt[source], dealt.get(f"{source}_hot")).select(*KEYS, F.lit(len(names)).alias("frame"), found.alias("found"), F.lit(False).alias("asked")))
            names.append(F.array(*[F.lit(f.name) for f in some]))
    blank = F.lit(None).cast("array<double>").alias("found")
    asked = days.select(*KEYS, F.explode(F.array(*map(F.lit, range(len(names))))).alias("frame"), blank, F.lit(True).alias("asked"))
    rows = reduce(DataFrame.unionByName, parts, asked)
    table = rows.groupBy(*KEYS, "frame").agg(F.first("found", ignorenulls=True).alias("found"), F.max("asked").alias("asked")).where("asked")
    table = table.select(*KEYS, F.array(*names)[F.col("frame")].alias("feature"), "found")
    pairs = F.expr("transform(feature, (n, k) -> struct(n AS feature, found[k] AS value))")
    return table.select(*KEYS, F.inline(pairs))


def grouped(features: list[Feature], frames: int = FRAMES) -> list[list[Feature]]:
    """Features by jobs of at most so many frames each."""
    groups = list(by_frame(features).values())
    return [[f for g in groups[lo : lo + frames] for f in g] for lo in range(0, len(groups), frames)]


def jobs(features: list[Feature], dealt: dict[str, DataFrame], sample: DataFrame, frames: int = FRAMES) -> Iterator[DataFrame]:
    """Feature tables of at most so many frames each; persist what deal() gave where several follow."""
    for group in grouped(features, frames):
        yield feature_table(group, dealt, sample)


def status(table: DataFrame) -> DataFrame:
    """Per feature and day: rows, values, and `ok`, or `empty` where no symbol has a value."""
    per = table.groupBy("feature", "date").agg(F.count("symbol").alias("rows"), F.count("value").alias("found"))
    return per.withColumn("status", F.when(F.col("found") == 0, "empty").otherwise("ok"))
