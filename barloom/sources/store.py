"""Ticks kept as tables that features read without dealing them out again.

A table is partitioned by date and bucketed by symbol, each bucket in order of time, so a job opens the asked days alone, and
windows and groupings by date and symbol find their rows together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER = ("symbol", "time", "tie")


def save(ticks: DataFrame, table: str, buckets: int = 256) -> None:
    """Write ticks of some days; days that the table has are replaced, others stay. buckets counts for a new table only."""
    spark = ticks.sparkSession
    new = not spark.catalog.tableExists(table)
    if not new:
        buckets = int(next(r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").toLocalIterator() if r.col_name == "Num Buckets"))
    # one file a day and bucket: rows meet by symbol as the buckets do
    rows = ticks.repartition(buckets, "symbol").sortWithinPartitions("date", *ORDER)
    if new:
        rows.write.partitionBy("date").bucketBy(buckets, "symbol").sortBy(*ORDER).format("parquet").saveAsTable(table)
        return
    columns = spark.table(table).columns
    if set(columns) != set(rows.columns):
        raise ValueError(f"{table} has the columns {sorted(columns)}, not {sorted(rows.columns)}")
    mode = "spark.sql.sources.partitionOverwriteMode"  # an insert into a table takes it from the session alone
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.select(*columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def days(spark: SparkSession, table: str, start: str | None = None, end: str | None = None) -> list[str]:
    """Days (YYYY-MM-DD) of a table, from its partitions."""
    found = sorted(r.partition.partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator())
    return [d for d in found if (not start or d >= start) and (not end or d <= end)]


def read(spark: SparkSession, table: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The table's ticks of days from start to end."""
    df = spark.table(table)
    for cond, day in ((">=", start), ("<=", end)):
        if day:
            df = df.where(F.expr(f"date {cond} DATE '{day}'"))
    return df
