"""Frames: what is done to ticks before they are summed up per day and symbol, as steps of SQL expressions.

The same steps become a DataFrame plan for Spark and a chain of common table expressions for the checks in another
engine. Features with equal frames share one plan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .series import over_lists

G = "(PARTITION BY date, symbol)"
W = "(PARTITION BY date, symbol ORDER BY time, tie)"
KEYS = ("date", "symbol")


@dataclass(frozen=True)
class Keep:
    """Rows for which cond is true."""

    cond: str


@dataclass(frozen=True)
class Add:
    """New columns (name, expression), all from the columns before the step."""

    cols: tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class Group:
    """One row for each of keys, with aggregates (name, expression)."""

    keys: tuple[str, ...]
    aggs: tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class Pairs:
    """Pairs of rows of one day and symbol: columns of the left row as they are, those of the right one with a 2 behind, where cond holds.

    Only the plainer definitions that check other frames use it: the pairs of a group are the square of its rows.
    """

    left: tuple[str, ...]
    right: tuple[str, ...]
    cond: str


@dataclass(frozen=True)
class Fold:
    """An ordered walk over a day's rows, numbered by order from 1, with a state that each row changes.

    state: name, type, first value and next value, an expression over the state s and the row x. The result is one row a day and
    symbol with the last state. Spark folds the rows' array; the other engine recurs.
    """

    order: str
    cols: tuple[str, ...]
    state: tuple[tuple[str, str, str, str], ...]


@dataclass(frozen=True)
class Series:
    """One row a day and symbol: the columns as arrays in order, and numbers (name, function) from them.

    A function takes the arrays as numpy vectors and gives a number or None. Arrays hold a session's minute bars.
    """

    order: str
    cols: tuple[str, ...]
    numbers: tuple[tuple[str, Callable], ...]


@dataclass(frozen=True)
class Border:
    """For days cut into chunks: each chunk gets the rows beside it, the last of the chunk before and the first of the one behind, as ghosts.

    The order's first column decides a row's chunk by the day's cuts.
    """

    order: str


@dataclass(frozen=True)
class Total:
    """For days cut into chunks: the running sum of x over the day, from sums in the chunk and of the chunks before it."""

    name: str
    x: str
    order: str


Step = Keep | Add | Group | Pairs | Fold | Series | Border | Total
Frame = tuple[Step, ...]


def add(**cols: str) -> Add:
    return Add(tuple(cols.items()))


def lag(x: str, k: int = 1, over: str = W) -> str:
    return f"lag({x}, {k}) OVER {over}"


def lead(x: str, k: int = 1, over: str = W) -> str:
    return f"lead({x}, {k}) OVER {over}"


def over(agg: str) -> str:
    """An aggregate over the whole day of the symbol."""
    return f"{agg} OVER {G}"


def rows(agg: str, lo: str, hi: str, order: str = "time, tie") -> str:
    """An aggregate over a frame of rows, as `10 PRECEDING`."""
    return f"{agg} OVER (PARTITION BY date, symbol ORDER BY {order} ROWS BETWEEN {lo} AND {hi})"


def running(agg: str, order: str = "time, tie") -> str:
    return rows(agg, "UNBOUNDED PRECEDING", "CURRENT ROW", order)


def number(order: str = "time, tie") -> str:
    return f"row_number() OVER (PARTITION BY date, symbol ORDER BY {order})"


def div(a: str, b: str) -> str:
    return f"(({a}) / nullif(({b}), 0))"


def when(cond: str, value: str) -> str:
    return f"CASE WHEN {cond} THEN {value} END"


def clip(x: str, lo: float = 0.0, hi: float = 1.0) -> str:
    return f"CASE WHEN ({x}) < {lo} THEN CAST({lo} AS DOUBLE) WHEN ({x}) > {hi} THEN CAST({hi} AS DOUBLE) ELSE ({x}) END"


def total(x: str, cond: str) -> str:
    """Sum of x where cond holds; 0 if it never does."""
    return f"sum(CASE WHEN {cond} THEN {x} ELSE 0 END)"


def share(cond: str, of: str = "true") -> str:
    """Share of rows with cond among those with of; null if there are none."""
    return div(f"sum(CASE WHEN ({cond}) AND ({of}) THEN 1e0 ELSE 0e0 END)", f"sum(CASE WHEN {of} THEN 1e0 ELSE 0e0 END)")


def corr(x: str, y: str) -> str:
    """Pearson correlation; null where a side doesn't vary."""
    a, b = f"CASE WHEN ({y}) IS NOT NULL THEN ({x}) END", f"CASE WHEN ({x}) IS NOT NULL THEN ({y}) END"
    return f"CASE WHEN var_pop({a}) > 0 AND var_pop({b}) > 0 THEN covar_pop({x}, {y}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0) END"


def slope(y: str, x: str) -> str:
    """Least-squares slope of y on x; null where x doesn't vary."""
    return f"CASE WHEN regr_sxx({y}, {x}) > 0 THEN regr_slope({y}, {x}) END"


def pct(x: str, p: float) -> str:
    """Exact percentile by linear interpolation."""
    return f"percentile({x}, {p})"


def _bordered(df: DataFrame, order: str) -> DataFrame:
    columns = [c.strip() for c in order.split(",")]
    if columns[0] != "time":
        df = df.withColumn("chunk", F.expr(f"size(filter(cuts, x -> x <= {columns[0]}))"))
    whole, place = F.struct(*df.columns), F.struct(*columns)
    ends = df.groupBy(*KEYS, "chunk").agg(F.min_by(whole, place).alias("first"), F.max_by(whole, place).alias("last"))
    beside = Window.partitionBy(*KEYS).orderBy("chunk")
    ends = ends.withColumns({"back": F.lag("chunk").over(beside), "on": F.lead("chunk").over(beside)})
    given = F.array(F.struct("back", F.col("first").alias("row")), F.struct(F.col("on").alias("back"), F.col("last").alias("row")))
    ghosts = ends.select(F.inline(given)).where("back IS NOT NULL").select("back", "row.*").drop("chunk").withColumnRenamed("back", "chunk")
    return df.withColumn("ghost", F.lit(False)).unionByName(ghosts.withColumn("ghost", F.lit(True)))


def _totalled(df: DataFrame, step: Total) -> DataFrame:
    sums = df.groupBy(*KEYS, "chunk").agg(F.expr(f"sum({step.x})").alias("own"))
    before = F.sum("own").over(Window.partitionBy(*KEYS).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select(*KEYS, "chunk", F.coalesce(before, F.lit(0)).alias("before"))
    local = f"sum({step.x}) OVER (PARTITION BY date, symbol, chunk ORDER BY {step.order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return df.join(offsets, [*KEYS, "chunk"]).withColumn(step.name, F.expr(local) + F.col("before")).drop("before")


def run_frame(frame: Frame, df: DataFrame) -> DataFrame:
    """The frame's steps over a DataFrame."""
    for step in frame:
        if isinstance(step, Keep):
            df = df.where(step.cond)
        elif isinstance(step, Add):
            df = df.selectExpr("*", *[f"{e} AS {n}" for n, e in step.cols])
        elif isinstance(step, Group):
            df = df.groupBy(*step.keys).agg(*[F.expr(e).alias(n) for n, e in step.aggs])
        elif isinstance(step, Border):
            df = _bordered(df, step.order)
        elif isinstance(step, Total):
            df = _totalled(df, step)
        elif isinstance(step, Fold):
            first = ", ".join(f"'{n}', CAST({init} AS {t})" for n, t, init, _ in step.state)
            then = ", ".join(f"'{n}', CAST({e} AS {t})" for n, t, _, e in step.state)
            walk = f"aggregate(array_sort(collect_list(struct({step.order}, {', '.join(step.cols)}))), named_struct({first}), (s, x) -> named_struct({then}))"
            df = df.groupBy(*KEYS).agg(F.expr(walk).alias("state")).select(*KEYS, "state.*")
        elif isinstance(step, Series):
            ordered = f"array_sort(collect_list(struct({step.order}, {', '.join(step.cols)})))"
            df = df.groupBy(*KEYS).agg(F.expr(ordered).alias("rows"))
            lists = [F.expr(f"transform(rows, x -> CAST(x.{c} AS DOUBLE))") for c in step.cols]
            df = df.select(*KEYS, *[over_lists(f)(F.array(*lists)).alias(n) for n, f in step.numbers])
        else:
            a = df.select(*KEYS, *step.left)
            b = df.select(*KEYS, *[F.col(c).alias(f"{c}2") for c in step.right])
            df = a.join(b, [*KEYS]).where(step.cond)
    return df


def sql_frame(frame: Frame, source: str) -> tuple[list[str], str]:
    """The frame's steps as common table expressions for the other engine, and the last one's name."""
    out, last = [], source
    for k, step in enumerate(frame):
        name = f"{source}_{k}"
        if isinstance(step, Keep):
            body = f"SELECT * FROM {last} WHERE {step.cond}"
        elif isinstance(step, Add):
            body = "SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in step.cols) + f" FROM {last}"
        elif isinstance(step, Group):
            body = f"SELECT {', '.join(step.keys)}, " + ", ".join(f"{e} AS {n}" for n, e in step.aggs) + f" FROM {last} GROUP BY {', '.join(step.keys)}"
        elif isinstance(step, Fold):
            first = ", ".join(f"CAST({init} AS {t}) AS {n}" for n, t, init, _ in step.state)
            then = ", ".join(f"CAST({e} AS {t})" for _, t, _, e in step.state)
            walk = f"SELECT date, symbol, CAST(0 AS BIGINT) AS place, {first} FROM (SELECT DISTINCT date, symbol FROM {last}) UNION ALL SELECT s.date, s.symbol, s.place + 1, {then} FROM {name}w s JOIN {last} x ON s.date = x.date AND s.symbol = x.symbol AND x.{step.order} = s.place + 1"
            out.append(f"{name}w AS ({walk})")
            body = f"SELECT * FROM {name}w QUALIFY row_number() OVER (PARTITION BY date, symbol ORDER BY place DESC) = 1"
        elif not isinstance(step, Pairs):
            raise ValueError(f"{type(step).__name__} has no SQL: the feature needs a plainer frame to be checked by")
        else:
            left = ", ".join(f"a.{c}" for c in (*KEYS, *step.left))
            right = ", ".join(f"b.{c} AS {c}2" for c in step.right)
            body = f"SELECT * FROM (SELECT {left}, {right} FROM {last} a JOIN {last} b ON a.date = b.date AND a.symbol = b.symbol) WHERE {step.cond}"
        out.append(f"{name} AS ({body})")
        last = name
    return out, last
