"""Distinct counts from stored sketches that can be merged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Base-2 logarithm of a sketch's registers: a relative error of about 0.4 %.
FINE = 16


def daily(df: DataFrame, day: str, value: str, fine: int = FINE) -> DataFrame:
    """(day, sketch, rows): one sketch of distinct values for each day, to be stored; a day is counted once, however many ranges it is in later."""
    return df.groupBy(day).agg(F.hll_sketch_agg(value, fine).alias("sketch"), F.count(F.lit(1)).alias("rows"))


def over_ranges(days: DataFrame, ranges: DataFrame, day: str, first: str, last: str) -> DataFrame:
    """(first, last, about): distinct values of each range of days, from the days' sketches alone."""
    each = ranges.select(first, last).distinct().withColumn(day, F.explode(F.sequence(first, last)))
    return each.join(days.select(day, "sketch"), day).groupBy(first, last).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("about"))
