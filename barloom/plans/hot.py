"""Symbol-days that are too large for one task are cut in time.

A cut day's rows are dealt out by (date, symbol, chunk). Where a frame looks at the rows beside each row, the first and last rows of every
chunk are carried to the chunks beside it as ghosts, so that each chunk is worked through by itself; running sums take
the sums of earlier chunks from a small join. Ghosts go before anything is grouped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frame import KEYS, Add, Border, Frame, Group, Keep, Total

#: Rows from which a symbol-day is cut, and rows of a chunk, but for the minute that ends it.
HOT, CHUNK = 4_000_000, 1_000_000
_MINUTE = 60_000_000_000
_ORDERED, _BY_CHUNK = "PARTITION BY date, symbol ORDER BY ", "PARTITION BY date, symbol, chunk ORDER BY "
_RUNNING = " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def cut(ticks: DataFrame, hot: int | None = None, chunk: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Ticks of symbol-days of at most hot rows, and the others with cuts (times at which chunks begin) and chunk; None if there are none.

    time counts nanoseconds. Counts by minute, which tasks sum up first, place the cuts.
    """
    hot, chunk = hot or HOT, chunk or CHUNK
    large = ticks.groupBy(*KEYS).count().where(F.col("count") > hot).select(*KEYS).persist()
    if large.isEmpty():
        return ticks, None
    many = ticks.join(large, list(KEYS), "left_semi")
    minutes = many.groupBy(*KEYS, F.expr(f"time div {_MINUTE}").alias("minute")).count()
    before = F.sum("count").over(Window.partitionBy(*KEYS).orderBy("minute")) - F.col("count")
    pieces = minutes.withColumn("piece", F.floor(before / chunk)).groupBy(*KEYS, "piece").agg((F.min("minute") * _MINUTE).alias("begin"))
    cuts = pieces.groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.when(F.col("piece") > 0, F.col("begin")))).alias("cuts"))
    parts = int(ticks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunked_ = many.join(cuts, list(KEYS)).withColumn("chunk", F.expr("size(filter(cuts, x -> x <= time))"))
    dealt = chunked_.repartition(parts, *KEYS, "chunk").sortWithinPartitions(*KEYS, "chunk", "time", "tie")
    return ticks.join(large, list(KEYS), "left_anti"), dealt


def chunked(frame: Frame) -> Frame:
    """The frame's steps for the rows of cut days, up to where it groups; rows keep the columns chunk and cuts."""
    out: list = []
    bordered = False
    for step in frame:
        if isinstance(step, Group):
            raise ValueError("a chunked frame ends where rows are grouped")
        ordered = isinstance(step, Add) and any(_ORDERED in e for _, e in step.cols)
        if not ordered:
            out.append(step)
            continue
        sums = [(n, e.partition(" OVER ")[0].removeprefix("sum(").removesuffix(")")) for n, e in step.cols if e.startswith("sum(") and e.endswith(_RUNNING)]
        order = step.cols[0][1].partition(_ORDERED)[2].partition(")")[0].partition(" ROWS")[0]
        if sums:
            if len(sums) < len(step.cols) or not bordered:
                raise ValueError("running sums come alone, behind the borders")
            out += [Keep("NOT ghost"), *[Total(n, x, order) for n, x in sums]]
        else:
            if not bordered:
                out.append(Border(order))
                bordered = True
            out.append(Add(tuple((n, e.replace(_ORDERED, _BY_CHUNK)) for n, e in step.cols)))
    return (*out, Keep("NOT ghost")) if bordered else tuple(out)
