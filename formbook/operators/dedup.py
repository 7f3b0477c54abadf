"""Latest rows, top-k and fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``; give a unique last column so that ties cannot differ between runs."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).where("_rn = 1").drop("_rn")


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int, rank_col: str = "rank") -> DataFrame:
    return df.withColumn(rank_col, F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col(rank_col) <= k)


def both_ends(df: DataFrame, by: list[str], value: str, tie: str, k: int, high: float, low: float) -> DataFrame:
    """The k highest at or above ``high`` and the k lowest at or below ``low`` of each group."""
    up = W.partitionBy(*by).orderBy(F.desc(value), tie)
    down = W.partitionBy(*by).orderBy(F.asc(value), tie)
    ranked = df.withColumn("_u", F.row_number().over(up)).withColumn("_d", F.row_number().over(down))
    end = F.when((F.col("_u") <= k) & (F.col(value) >= high), "hot").when((F.col("_d") <= k) & (F.col(value) <= low), "cold")
    return ranked.withColumn("end", end).where("end IS NOT NULL").drop("_u", "_d")


def fallback_union(primary: DataFrame, secondary: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``secondary`` only for keys that ``primary`` has not."""
    return primary.unionByName(secondary.join(primary.select(keys).distinct(), keys, "left_anti"), allowMissingColumns=True)
