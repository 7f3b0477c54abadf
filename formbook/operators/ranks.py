"""Ranks over a whole table without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formbook.sources.sinks import stored


def ahead(values: DataFrame, value: str, count: str, name: str = "ahead") -> DataFrame:
    """values has one row for each ``value``; ``name`` is the sum of ``count`` over smaller values.

    Spark deals the values out by ranges; the table keeps each row's range, ranges are totalled (a row for each), and only
    then is each range summed on its own.
    """
    dealt = stored(values.repartitionByRange(value).withColumn("_range", F.spark_partition_id()), "ranges")
    totals = dealt.groupBy("_range").agg(F.sum(count).alias("_sum"))
    before = totals.select("_range", F.coalesce(F.sum("_sum").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # a row for each range
    inside = W.partitionBy("_range").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    return dealt.join(before, "_range").withColumn(name, F.col("_before") + F.coalesce(F.sum(count).over(inside), F.lit(0))).drop("_range", "_before")
