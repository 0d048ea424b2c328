"""Registered queries of the features and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.catalog import QuoteParams, features
from ..sources.ticks import derive, statements
from .feature import Feature, one, rounded, twin_sql


#: The derived quotes have conditions 0 to 4 and indicators 0 to 8: some of each make the flag features vary.
CODES = QuoteParams(
    ineligible_conditions=(1,), ineligible_indicators=(2, 7), nonfirm_conditions=(3,), manual_indicators=(4, 5), opening_conditions=(0,), opening_indicators=(8,)
)


def _query(feature: Feature) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(one(feature, derive(spark, sf_dir, feature.source), derive(spark, sf_dir, "sample")))

    run.__name__ = feature.name
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(f) for name, f in features(CODES).items()}


def oracles() -> dict[str, str]:
    sources = statements("duckdb")
    return {name: twin_sql(f, sources) for name, f in features(CODES).items()}
