"""Lineup projection and bullpen load."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def leverage_load() -> Column:
    """Pitches, weighed 1.5 where many were thrown in two innings or less."""
    return F.col("n") * F.when((F.col("n") > 60) & (F.col("ip") <= 2), 1.5).otherwise(1.0)


def week_load(use: DataFrame, days: int = 7) -> DataFrame:
    """use (team_id, pitcher, game_date, game_pk, n, ip): the load of the days before each day of a team, and how many arms carried it."""
    per_day = use.groupBy("team_id", "game_date").agg(F.sum("n").alias("n"), F.sum("ip").alias("ip"), F.sum(leverage_load()).alias("load"), F.count_distinct("game_pk").alias("games"))
    frame = W.partitionBy("team_id").orderBy(F.unix_date("game_date")).rangeBetween(-days, -1)
    took = lambda c, name: F.coalesce(F.round(F.sum(c).over(frame), 6), F.lit(0)).alias(name)
    sums = per_day.select("team_id", "game_date", took("n", f"pitches_{days}"), took("ip", f"innings_{days}").cast("double"), took("load", f"load_{days}").cast("double"), took("games", f"games_{days}"))
    # an arm counts on each of the days after its appearance: bounded by the window, not by the pairs of days
    spread = use.select("team_id", "pitcher", "game_date").distinct().select("team_id", "pitcher", F.explode(F.sequence(F.date_add("game_date", 1), F.date_add("game_date", days))).alias("game_date"))
    depth = spread.groupBy("team_id", "game_date").agg(F.count_distinct("pitcher").alias("depth"))
    return sums.join(depth, ["team_id", "game_date"], "left").withColumn("depth", F.coalesce("depth", F.lit(0)))


def project(recent: DataFrame, by: list[str], days: int = 14, slots: int = 9) -> DataFrame:
    """recent (by, game_date, game_pk, player_id, batting_order, target_date): one projected lineup of each group.

    Scores are summed by Spark (weight 1 / days ago); only (player, slot) scores of one team reach the greedy step,
    a few hundred rows. A player is taken once; groups with too few players give none.
    """
    ago = F.datediff("target_date", "game_date")
    seen = recent.where(ago.between(1, days) & F.col("batting_order").between(1, slots) & F.col("player_id").isNotNull()).withColumn("_w", 1.0 / ago)
    overall = seen.groupBy(*by, "player_id").agg(F.sum("_w").alias("score"), F.count_distinct("game_pk").alias("starts"), F.avg("batting_order").alias("mean_order"))
    scored = seen.groupBy(*by, "player_id", "batting_order").agg(F.sum("_w").alias("slot_score")).join(overall, [*by, "player_id"])
    kinds = dict(recent.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in by) + f", batting_order int, player_id {kinds['player_id']}, score double"

    def greedy(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["batting_order", "slot_score", "score", "starts", "player_id"], ascending=[True, False, False, False, True])
        taken: dict[int, tuple] = {}
        used = set()
        for slot, player, score in zip(rows["batting_order"], rows["player_id"], rows["score"], strict=True):
            if slot not in taken and player not in used:
                taken[slot] = (player, score)
                used.add(player)
        rest = rows[~rows["player_id"].isin(used)].drop_duplicates("player_id").sort_values(["score", "starts", "mean_order", "player_id"], ascending=[False, False, True, True])
        free = [s for s in range(1, slots + 1) if s not in taken]
        taken |= dict(zip(free, zip(rest["player_id"], rest["score"], strict=True), strict=False))
        found = sorted(taken.items()) if len(taken) == slots else []
        out = {c: [rows[c].iloc[0]] * len(found) for c in by}
        return pd.DataFrame(out | {"batting_order": [s for s, _ in found], "player_id": [p for _, (p, _) in found], "score": [x for _, (_, x) in found]})

    return scored.groupBy(*by).applyInPandas(greedy, schema)


def with_pitchers(lineups: DataFrame, probable: DataFrame, by: list[str]) -> DataFrame:
    """Projected batters and, after them, each group's probable pitcher (by, player_id); none of them is confirmed."""
    starters = probable.where("player_id IS NOT NULL").join(lineups.select(*by).distinct(), by, "left_semi").select(*by, F.lit(None).cast("int").alias("batting_order"), "player_id", F.lit(True).alias("is_probable_pitcher"))
    batters = lineups.select(*by, "batting_order", "player_id", F.lit(False).alias("is_probable_pitcher"))
    return batters.unionByName(starters).withColumn("lineup_confirmed", F.lit(False))


def only_unknown(target: DataFrame, known: DataFrame, by: list[str], enough: int = 8) -> DataFrame:
    """Groups that still need a projection: those with fewer than ``enough`` known batters."""
    full = known.where("batting_order IS NOT NULL").groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= enough)
    return target.join(full.select(*by), by, "left_anti")


def current_candidates(recent: DataFrame, current: DataFrame, by: list[str], least: int = 6) -> DataFrame:
    """Recent rows of players on the current list, where at least ``least`` of a group are on it; else all its rows."""
    listed = recent.join(current.select(*by, "player_id").distinct().withColumn("_on", F.lit(True)), [*by, "player_id"], "left")
    many = listed.where("_on").groupBy(*by).agg(F.count_distinct("player_id").alias("_n"))
    return listed.join(many, by, "left").where(F.col("_on").isNotNull() | (F.coalesce("_n", F.lit(0)) < least)).drop("_on", "_n")
