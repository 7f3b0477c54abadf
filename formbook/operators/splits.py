"""Time-ordered splits and coverage of features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def by_season(season: str, dev: int, val: int, test: int) -> Column:
    s = F.col(season)
    return F.when(s < dev, "train").when(s < val, "dev").when(s < test, "val").otherwise("test")


def numbered(df: DataFrame, date: str, tie: str) -> DataFrame:
    """``i``: the place of a row in (date, tie) order from 0, and ``total``.

    Rows are numbered inside their day; only one row per day passes through a window without a key.
    """
    days = df.groupBy(date).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy(date).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = days.select(F.col(date).alias("_day"), before.alias("_before"), F.sum("_n").over(W.partitionBy()).alias("total"))
    inside = df.withColumn("_in", F.row_number().over(W.partitionBy(date).orderBy(tie)) - 1)
    return inside.join(offsets, F.col(date).eqNullSafe(F.col("_day"))).withColumn("i", F.col("_before") + F.col("_in")).drop("_day", "_before", "_in")


def availability(df: DataFrame, features: list[str]) -> DataFrame:
    """Share of rows that have each feature; a feature the frame lacks is missing."""
    share = {c: F.round(F.count(c) / F.count(F.lit(1)), 6) if c in df.columns else F.lit(0.0) for c in features}
    one = df.agg(*[F.struct(F.lit(c).alias("feature"), F.coalesce(v, F.lit(0.0)).alias("coverage")).alias(f"f{i}") for i, (c, v) in enumerate(share.items())])
    return one.select(F.explode(F.array(*[f"f{i}" for i in range(len(share))])).alias("r")).select("r.*", (F.col("r.coverage") == 0).alias("missing"))
