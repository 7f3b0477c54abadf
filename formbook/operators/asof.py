"""As-of, validity, range and fallback joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def as_of(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, values: list[str], strict: bool = False) -> DataFrame:
    """Each left row with the values of the latest right row at (or before, if strict) its time.

    The sides are stacked and the last right row is carried forward in one window: one shuffle, and no
    pair of rows is ever made.
    """
    pick = F.struct(*[F.col(v) for v in values])
    r = right.select(*by, F.col(right_time).alias("_t"), F.lit(0 if not strict else 1).alias("_o"), pick.alias("_v"), *[F.lit(None).cast(t).alias(f"_l_{c}") for c, t in left.dtypes])
    own = left.select(*by, F.col(left_time).alias("_t"), F.lit(1 if not strict else 0).alias("_o"), F.lit(None).cast(r.schema["_v"].dataType).alias("_v"), *[F.col(c).alias(f"_l_{c}") for c in left.columns])
    both = r.withColumn("_left", F.lit(False)).unionByName(own.withColumn("_left", F.lit(True)))
    w = W.partitionBy(*by).orderBy("_t", "_o").rowsBetween(W.unboundedPreceding, 0)
    met = both.withColumn("_v", F.last("_v", ignorenulls=True).over(w)).where("_left")
    return met.select(*[F.col(f"_l_{c}").alias(c) for c in left.columns], *[F.col(f"_v.{v}").alias(v) for v in values])


def valid_at(facts: DataFrame, dimension: DataFrame, key: str, date: str) -> DataFrame:
    """Facts with the dimension row whose [valid_from, valid_to] holds their date."""
    d = dimension.withColumnRenamed(key, "_key")
    return facts.join(d, (F.col(key) == F.col("_key")) & (F.col(date) >= F.col("valid_from")) & (F.col(date) <= F.coalesce("valid_to", F.lit("9999-12-31").cast("date")))).drop("_key")


def scd2(snapshots: DataFrame, key: str, date: str, attributes: list[str]) -> DataFrame:
    """Validity intervals (type 2) from dated snapshots: a run of equal attributes is one version."""
    w = W.partitionBy(key).orderBy(date)
    state = F.xxhash64(*attributes)
    changed = snapshots.withColumn("_s", state).withColumn("_new", (F.col("_s") != F.lag("_s").over(w)) | F.lag("_s").over(w).isNull()).where("_new")
    return changed.select(key, *attributes, F.col(date).alias("valid_from"), F.date_sub(F.lead(date).over(w), 1).alias("valid_to"), F.lead(date).over(w).isNull().alias("is_current"))


def fallback_years(left: DataFrame, lookup: DataFrame, key: str, season: str, value: str, back: int, default: float | None = None) -> DataFrame:
    """The value of the newest of the seasons season .. season - back that the lookup has."""
    spread = lookup.select(F.col(key).alias("_k"), F.col(season).alias("_from"), F.col(value).alias("_v")).withColumn("_s", F.explode(F.sequence(F.col("_from"), F.col("_from") + back)))
    best = spread.groupBy("_k", "_s").agg(F.max_by("_v", "_from").alias("_v"))
    met = left.join(best, (F.col(key) == F.col("_k")) & (F.col(season) == F.col("_s")), "left")
    return met.withColumn(value, F.coalesce("_v", F.lit(default)) if default is not None else F.col("_v")).drop("_k", "_s", "_v")
