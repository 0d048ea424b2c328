"""Features: a frame and one aggregate, which gives a value per day and symbol."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frame import KEYS, Frame, Group, run_frame, sql_frame
from .hot import chunked

#: Digits that results keep where two engines are compared, after a nudge that takes halves off the rounding edge.
DIGITS, NUDGE = 7, "1.0000000003e0"


@dataclass(frozen=True)
class Feature:
    """value is an aggregate over the frame's rows of a day and symbol.

    check: frame and value of a plainer definition, where the other engine isn't to do the same.
    """

    name: str
    source: str
    frame: Frame
    value: str
    check: tuple[Frame, str] | None = None


def by_frame(features: list[Feature]) -> dict[tuple[str, Frame], list[Feature]]:
    """Features that share a source and a frame."""
    found: dict[tuple[str, Frame], list[Feature]] = {}
    for f in features:
        found.setdefault((f.source, f.frame), []).append(f)
    return found


def values(features: list[Feature], ticks: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Columns date, symbol and one for each of features, which must share a frame. hot: ticks of days cut into chunks."""
    frame = features[0].frame
    if hot is None:
        rows = run_frame(frame, ticks)
    else:  # up to where rows are grouped, cut days go their own way
        at = next((k for k, step in enumerate(frame) if isinstance(step, Group)), len(frame))
        plain = run_frame(frame[:at], ticks)
        rows = run_frame(frame[at:], plain.unionByName(run_frame(chunked(frame[:at]), hot).select(plain.columns)))
    return rows.groupBy(*KEYS).agg(*[F.expr(f"CAST({f.value} AS DOUBLE)").alias(f.name) for f in features])


def one(feature: Feature, ticks: DataFrame, sample: DataFrame) -> DataFrame:
    """Rows (date, symbol, value), one for each day and symbol of the sample; null where the feature has no value."""
    own = values([feature], ticks).withColumnRenamed(feature.name, "value")
    return sample.join(own, list(KEYS), "left").select(*KEYS, "value")


def rounded(df: DataFrame) -> DataFrame:
    """value to DIGITS significant digits, and tiny values to 0."""
    text = F.format_string(f"%.{DIGITS - 1}e", F.col("value") * F.lit(float(NUDGE))).cast("double")
    return df.withColumn("value", F.when(F.abs("value") < 1e-12, F.lit(0.0)).otherwise(F.when(F.col("value").isNotNull(), text)))


def twin_sql(feature: Feature, sources: dict[str, str]) -> str:
    """One statement for DuckDB with the rounded result; sources has the statements of the ticks and the sample."""
    frame, value = feature.check or (feature.frame, feature.value)
    steps, last = sql_frame(frame, feature.source)
    text = ",\n".join([f"sample AS ({sources['sample']})", f"{feature.source} AS ({sources[feature.source]})", *steps, f"result AS (SELECT date, symbol, CAST({value} AS DOUBLE) AS value FROM {last} GROUP BY date, symbol)"])
    text += f"\nSELECT s.date, s.symbol, CASE WHEN abs(r.value) < 1e-12 THEN 0.0 WHEN isfinite(r.value) THEN CAST(printf('%.{DIGITS - 1}e', r.value * {NUDGE}) AS DOUBLE) END AS value FROM sample s LEFT JOIN result r ON s.date = r.date AND s.symbol = r.symbol"
    return "WITH RECURSIVE " + text.replace("percentile(", "quantile_cont(").replace("explode(array(", "unnest(list_value(")
