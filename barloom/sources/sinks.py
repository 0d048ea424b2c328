"""Feature tables as Parquet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check(table: DataFrame) -> DataFrame:
    """table, which must have date, symbol, feature and value."""
    if lacking := {"date", "symbol", "feature", "value"} - set(table.columns):
        raise ValueError(f"a feature table needs {sorted(lacking)}")
    return table


def done(spark, root: str) -> DataFrame | None:
    """(feature, date) that root has, or None if it has nothing yet."""
    try:
        return spark.read.parquet(root).select("feature", "date").distinct()
    except AnalysisException:
        return None


def write_partitions(table: DataFrame, root: str, overwrite: bool = False) -> None:
    """root/feature=.../date=...; partitions that are there are replaced with overwrite, else skipped."""
    table = check(table).select("feature", "date", "symbol", F.col("value").cast("double"))
    old = None if overwrite else done(table.sparkSession, root)
    if old is not None:
        table = table.join(F.broadcast(old) if old.count() < 100_000 else old, ["feature", "date"], "left_anti")
    table = table.repartition("feature", "date")  # one file a partition
    table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy("feature", "date").parquet(root)


def write_single(table: DataFrame, root: str) -> None:
    """One folder of files in order of time, with the columns time, symbol and value, per feature; other features' folders stay."""
    rows = check(table).select("feature", F.col("date").cast("timestamp_ntz").alias("time"), "symbol", F.col("value").cast("double"))
    rows.repartitionByRange("feature", "time").sortWithinPartitions("feature", "time", "symbol").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("feature").parquet(root)
