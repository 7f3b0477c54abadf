"""Data-quality checks as rows (check_name, severity, actual, passed)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def measure(df: DataFrame, checks: dict[str, tuple[Column, str]]) -> DataFrame:
    """checks: name -> (aggregate that counts faults, severity). All of them in one pass."""
    one = df.agg(*[F.coalesce(c.cast("long"), F.lit(0)).alias(n) for n, (c, _) in checks.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.lit(s).alias("severity"), F.col(n).alias("actual")) for n, (_, s) in checks.items()])
    return one.select(F.explode(rows).alias("r")).select("r.*", (F.col("r.actual") == 0).alias("passed"))


def duplicate_keys(df: DataFrame, keys: list[str], severity: str = "error") -> DataFrame:
    twice = df.groupBy(*keys).count().where("count > 1")
    return twice.agg(F.count(F.lit(1)).alias("actual")).select(F.lit("duplicate_" + "_".join(keys)).alias("check_name"), F.lit(severity).alias("severity"), "actual", (F.col("actual") == 0).alias("passed"))


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str, severity: str = "error") -> DataFrame:
    lost = df.join(parent.select(F.col(parent_key).alias("_k")).distinct(), F.col(key) == F.col("_k"), "left_anti")
    return lost.agg(F.count(F.lit(1)).alias("actual")).select(F.lit(f"orphan_{key}").alias("check_name"), F.lit(severity).alias("severity"), "actual", (F.col("actual") == 0).alias("passed"))


def report(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def exit_code(found: DataFrame) -> int:
    """0 all passed, 1 errors, 2 warnings alone."""
    bad = {r.severity for r in found.where("NOT passed").select("severity").distinct().collect()}
    return 1 if "error" in bad else 2 if bad else 0


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table; an empty one is a warning."""
    one = [df.agg(F.count(F.lit(1)).alias("actual")).select(F.lit(f"rows_{n}").alias("check_name"), F.lit("warning").alias("severity"), "actual", (F.col("actual") > 0).alias("passed")) for n, df in tables.items()]
    return report(one)


def freshness(df: DataFrame, date: str, today: Column, most_days: int, name: str, severity: str = "warning") -> DataFrame:
    """Days since the latest date; no data at all is stale."""
    old = df.agg(F.datediff(today, F.max(date)).cast("long").alias("actual"))
    return old.select(F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), "actual", F.coalesce(F.col("actual") <= most_days, F.lit(False)).alias("passed"))


def required_columns(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """How many of the required columns a table lacks, by its schema alone."""
    lacking = sum(c not in df.columns for c in columns)
    return df.sparkSession.range(1).select(F.lit(f"columns_{name}").alias("check_name"), F.lit("error").alias("severity"), F.lit(lacking).cast("long").alias("actual"), F.lit(lacking == 0).alias("passed"))


def surplus(df: DataFrame, keys: list[str], severity: str = "error") -> DataFrame:
    """Rows beyond one for each key: COUNT(*) - COUNT(DISTINCT keys), by a count of counts."""
    one = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("actual"))
    return one.select(F.lit("surplus_" + "_".join(keys)).alias("check_name"), F.lit(severity).alias("severity"), "actual", (F.col("actual") == 0).alias("passed"))


def union_coverage(union: DataFrame, date: str, keys: list[str]) -> DataFrame:
    """Distinct dates, first, last, rows, and keys that are there more than once."""
    days = union.groupBy(date).agg(F.count(F.lit(1)).alias("n")).agg(F.count(date).alias("distinct_dates"), F.min(date).alias("earliest"), F.max(date).alias("latest"), F.sum("n").alias("total"))
    twice = union.groupBy(*keys).count().where("count > 1").agg(F.count(F.lit(1)).alias("duplicates"))
    return days.join(twice)  # two single rows
