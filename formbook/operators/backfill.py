"""Backfill of a range of days with failure as data: a day that breaks is an error row, the others go on."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formbook.sources import sinks, versions

OUTCOME = "day date, status string, rows long, error string"


def checked(rows: DataFrame, day: str, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows of the days that break no rule, and one outcome for each day: its rows, or the broken rules with how many rows break them.

    A rule is a condition that a row must meet; null counts as broken. One aggregation over all days; the rows of broken days are left out by a join on days.
    """
    broken = [F.count_if(~F.coalesce(c, F.lit(False))).alias(f"_{i}") for i, c in enumerate(rules.values())]
    per = rows.groupBy(day).agg(F.count(F.lit(1)).alias("rows"), *broken)
    texts = F.array(*[F.when(F.col(f"_{i}") > 0, F.concat(F.lit(f"{name}: "), F.col(f"_{i}").cast("string"))) for i, name in enumerate(rules)])
    error = F.array_join(F.filter(texts, lambda x: x.isNotNull()), "; ") if rules else F.lit("")
    outcome = per.select(F.col(day).alias("day"), F.when(error == "", "ok").otherwise("error").alias("status"), F.when(error == "", F.col("rows")).otherwise(0).alias("rows"), F.when(error != "", error).alias("error"))
    good = outcome.where("status = 'ok'").select(F.col("day").alias(day))
    return rows.join(good, day, "left_semi"), outcome


@dataclass
class Backfill:
    """``build`` makes a day's rows; they go to the partition ``by`` = day of a versioned table, so a day that is run again replaces itself."""

    path: str
    by: str
    build: Callable[[SparkSession, date], DataFrame]

    def run(self, spark: SparkSession, days: list[date], side_by_side: int = 4) -> DataFrame:
        """(day, status, rows, error) for every day. Days are computed side by side; those that came out well enter the table in one version, in order."""

        def one(day: date):
            try:
                rows = self.build(spark, day).withColumn(self.by, F.lit(day).cast("date"))
                return day, sinks.stored(rows, "backfill"), None
            except Exception as e:  # noqa: BLE001  whatever a day's input breaks is that day's outcome
                return day, None, f"{type(e).__name__}: {e}".splitlines()[0][:300]

        with ThreadPoolExecutor(side_by_side) as pool:
            done = list(pool.map(inheritable_thread_target(spark)(one), days))
        good = [r for _, r, e in done if e is None]
        if good:
            every = good[0]
            for r in good[1:]:
                every = every.unionByName(r, allowMissingColumns=True)
            fine = [str(d) for d, _, e in done if e is None]
            if versions.exists(spark, self.path):
                versions.overwrite_partitions(every, self.path, also_emptied=fine)
            else:
                versions.create(every, self.path, self.by)
        return spark.createDataFrame([(d, "ok" if e is None else "error", r.count() if e is None else 0, e) for d, r, e in done], OUTCOME)

    def failed(self, outcomes: DataFrame) -> list[date]:
        """The days to run again."""
        return [r.day for r in outcomes.where("status = 'error'").orderBy("day").collect()]
