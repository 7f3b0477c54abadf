"""Point-in-time window features over (date, id) order; frames exclude the current row unless they say otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def before(order: WindowSpec, n: int | None = None) -> WindowSpec:
    """The last n rows before this one; all of them without n."""
    return order.rowsBetween(W.unboundedPreceding if n is None else -n, -1)


def rolling(value: str | Column, order: WindowSpec, n: int, default: float | None = None) -> Column:
    out = F.avg(value).over(before(order, n))
    return out if default is None else F.coalesce(out, F.lit(default))


def cumulative(value: str | Column, order: WindowSpec) -> Column:
    return F.coalesce(F.sum(value).over(before(order)), F.lit(0))


def consistency(value: str, order: WindowSpec, n: int = 20, least: int = 3) -> Column:
    frame = before(order, n)
    return F.when(F.count(value).over(frame) >= least, -F.stddev_pop(value).over(frame))


def slope(value: str, order: WindowSpec, n: int = 10, clip: float = 3.0, least: int = 3, index: str = "game_no") -> Column:
    """OLS slope over the last n rows; ``index`` numbers the rows."""
    frame = before(order, n)
    fit = F.regr_slope(F.col(value).cast("double"), F.col(index).cast("double")).over(frame)
    return F.when(F.count(value).over(frame) >= least, F.greatest(F.lit(-clip), F.least(F.lit(clip), fit)))


def ewm(value: str, order: WindowSpec, span: int = 10, n: int = 30) -> Column:
    """Adjusted exponentially weighted mean of the last n rows."""
    keep = 1 - 2 / (span + 1)
    xs = F.reverse(F.collect_list(F.col(value).cast("double")).over(before(order, n)))
    start = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("w"), F.lit(1.0).alias("k"))
    step = lambda a, x: F.struct((a["s"] + a["k"] * x).alias("s"), (a["w"] + a["k"]).alias("w"), (a["k"] * keep).alias("k"))
    return F.when(F.size(xs) > 0, F.aggregate(xs, start, step, lambda a: a["s"] / a["w"]))


def islands(df: DataFrame, flag: str, by: list[str], order: list, name: str = "island") -> DataFrame:
    """Numbers the runs of equal ``flag``."""
    w = W.partitionBy(*by).orderBy(*order)
    change = (F.col(flag) != F.lag(flag).over(w)).cast("int")
    return df.withColumn(name, F.coalesce(F.sum(change).over(w.rowsBetween(W.unboundedPreceding, 0)), F.lit(0)))


def streaks(df: DataFrame, flag: str, by: list[str], order: list) -> DataFrame:
    """``streak``: signed length of the run of results before this row; 0 at the start of a group."""
    runs = islands(df, flag, by, order)
    inside = W.partitionBy(*by, "island").orderBy(*order)
    signed = F.row_number().over(inside) * F.when(F.col(flag) == 1, 1).otherwise(-1)
    return runs.withColumn("_s", signed).withColumn("streak", F.coalesce(F.lag("_s").over(W.partitionBy(*by).orderBy(*order)), F.lit(0))).drop("_s", "island")


def run_before(df: DataFrame, flag: str, by: list[str], order: list, name: str) -> DataFrame:
    """How many rows in a row before this one have ``flag`` = 1 (e.g. away games in a trip)."""
    w = W.partitionBy(*by).orderBy(*order)
    rows = df.withColumn("_n", F.row_number().over(w))
    last_other = F.coalesce(F.max(F.when(F.col(flag) == 0, F.col("_n"))).over(before(w)), F.lit(0))
    return rows.withColumn(name, F.col("_n") - 1 - last_other).drop("_n")


def rest_days(date: str, order: WindowSpec, most: int = 7, default: int = 3) -> Column:
    return F.coalesce(F.least(F.datediff(date, F.lag(date).over(order)), F.lit(most)), F.lit(default))


def range_mean(value: str, date: str, by: list[str], days: int) -> Column:
    """Mean over the days before this one, by date distance."""
    return F.avg(value).over(W.partitionBy(*by).orderBy(F.unix_date(date)).rangeBetween(-days, -1))
