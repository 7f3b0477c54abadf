"""Narrative rules as rows, and what a report takes of those that hold: so many for each opponent, so many in all.

A rule is (place, kind, condition, text): both SQL expressions over the subject's columns, so a table of rules is data that can be stored and changed. Of the
rules of one kind (a ladder) a subject takes the first that holds. Facts are ranked inside (report, opponent), then inside the
report, both by the rules' order; a report is never gathered as a list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    place: int
    kind: str
    condition: str
    text: str


def facts(subjects: DataFrame, rules: list[Rule], keep: list[str]) -> DataFrame:
    """``keep`` columns, then place, kind, text: of each kind the first rule that holds for a subject."""
    ladders: dict[str, Column] = {}
    for r in sorted(rules, key=lambda r: r.place, reverse=True):
        own = F.struct(F.lit(r.place).alias("place"), F.lit(r.kind).alias("kind"), F.expr(r.text).cast("string").alias("text"))
        ladders[r.kind] = F.when(F.expr(r.condition), own).otherwise(ladders[r.kind]) if r.kind in ladders else F.when(F.expr(r.condition), own)
    each = F.explode(F.filter(F.array(*ladders.values()), lambda x: x.isNotNull()))
    return subjects.select(*keep, each.alias("_fact")).select(*keep, "_fact.*")


def capped(found: DataFrame, report: list[str], opponent: list[str], order: list[Column], each: int, in_all: int) -> DataFrame:
    """At most ``each`` facts for an opponent (facts without one are not counted so) and ``in_all`` in a report; ``fact_no`` from 1."""
    within = F.row_number().over(W.partitionBy(*report, *opponent).orderBy(*order))
    free = F.coalesce(*[F.col(c).cast("string") for c in opponent]).isNull() if opponent else F.lit(True)
    first = found.withColumn("_within", within).where(free | (F.col("_within") <= each)).drop("_within")
    return first.withColumn("fact_no", F.row_number().over(W.partitionBy(*report).orderBy(*order))).where(F.col("fact_no") <= in_all)


#: The thresholds of the reports.
HIT_STREAKS = [
    Rule(1, "hit_streak", "hit_streak >= 15", "concat(player, ' is on fire: hits in ', hit_streak, ' consecutive games')"),
    Rule(2, "hit_streak", "hit_streak >= 10", "concat(player, ' has hit in ', hit_streak, ' straight games')"),
    Rule(3, "hit_streak", "hit_streak >= 7", "concat(player, ' has a ', hit_streak, '-game hit streak')"),
]
BATTERS = [
    Rule(10, "batter", "woba >= 0.420 AND pa >= 10", "concat(player, ' is mashing against ', opponent, ': ', woba, ' in ', pa)"),
    Rule(11, "batter", "woba >= 0.375 AND pa >= 15", "concat(player, ' has owned ', opponent, ': ', woba, ', ', hr, ' home runs in ', pa)"),
    Rule(12, "batter", "hr >= 4", "concat(player, ' has ', hr, ' home runs against ', opponent, ' in ', pa)"),
    Rule(13, "batter", "woba <= 0.220 AND pa >= 15", "concat(player, ' struggles against ', opponent, ': ', woba, ' in ', pa)"),
]
RIVALRIES = [
    Rule(20, "rivalry", "h2h_games >= 8 AND h2h_pct >= 0.625", "concat(home, ' dominated: ', round(h2h_pct * h2h_games), ' of ', h2h_games)"),
    Rule(21, "rivalry", "h2h_games >= 8 AND h2h_pct <= 0.375", "concat(away, ' own the rivalry: ', h2h_games - round(h2h_pct * h2h_games), ' of ', h2h_games)"),
]
WATCHED = [
    Rule(1, "h2h", "h2h_woba <> 0 AND h2h_pa >= 15 AND abs(h2h_woba - 0.320) < 0.015", "concat('lineup ', team, ' is familiar: ', h2h_woba, ' in ', h2h_pa)"),
    Rule(2, "h2h", "h2h_woba <> 0 AND h2h_pa >= 15 AND h2h_woba - 0.320 < -0.015", "concat('lineup ', team, ' dominates: ', h2h_woba, ' in ', h2h_pa)"),
    Rule(3, "h2h", "h2h_woba <> 0 AND h2h_pa >= 15", "concat('lineup ', team, ' struggles: ', h2h_woba, ' in ', h2h_pa)"),
    Rule(4, "streak", "abs(streak) >= 4", "concat(team, ' riding a ', if(streak > 0, 'W', 'L'), abs(streak), ' streak')"),
    Rule(5, "hot_player", "hot_woba IS NOT NULL", "concat(hot_player, ' is hot: ', hot_woba)"),
]
