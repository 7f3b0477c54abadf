"""Flattening of landed JSON payloads: standings, team statistics, rosters, transactions, teams and lineups.

Each reader takes a frame with one payload per row. Fields the payload lacks come as nulls, or as 0 where a count is meant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formbook.operators.dedup import fallback_union

NAMED = "struct<id: bigint, name: string>"
SPLIT = "struct<type: string, wins: int, losses: int>"
STANDINGS = (
    f"records array<struct<division: {NAMED}, league: {NAMED}, teamRecords: array<struct<team: {NAMED}, wins: int, losses: int, winningPercentage: string, gamesBack: string, divisionRank: string, "
    f"runsScored: int, runsAllowed: int, runDifferential: int, streak: struct<streakCode: string>, records: struct<splitRecords: array<{SPLIT}>>>>>>"
)


def zero(c: Column | str) -> Column:
    return F.coalesce(c if isinstance(c, Column) else F.col(c), F.lit(0))


def number(c: str) -> Column:
    """``-`` (no gap, no value) counts as 0."""
    return F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))


def standings(raw: DataFrame, body: str = "body") -> DataFrame:
    rec = raw.select(F.explode(F.from_json(body, STANDINGS)["records"]).alias("r")).select("r.division", "r.league", F.explode("r.teamRecords").alias("t"))
    kind = lambda name: F.get(F.filter(F.col("t.records.splitRecords"), lambda x: x["type"] == name), F.lit(0))
    first = F.get(F.col("t.records.splitRecords"), F.lit(0))
    return rec.select(
        F.col("t.team.id").alias("team_id"), F.col("t.team.name").alias("team_name"), F.col("league.id").alias("league_id"), F.col("division.id").alias("division_id"), zero("t.wins").alias("wins"), zero("t.losses").alias("losses"),
        number("t.winningPercentage").alias("win_percentage"), number("t.gamesBack").alias("games_back"), F.col("t.divisionRank").alias("division_rank"), zero("t.runsScored").alias("runs_scored"), zero("t.runsAllowed").alias("runs_allowed"),
        *[zero(kind(k)[v]).alias(f"{k}_{v}") for k in ("home", "away") for v in ("wins", "losses")], F.col("t.streak.streakCode").alias("streak"),
        F.concat_ws("-", zero(first["wins"]), zero(first["losses"])).alias("last_ten"),
    )


#: Fields of the feed, and the column of each, by kind of statistic.
STATS = {
    "batting": {"atBats": "at_bats", "runs": "runs", "hits": "hits", "homeRuns": "home_runs", "baseOnBalls": "walks", "strikeOuts": "strikeouts", "avg": "batting_avg", "obp": "obp", "slg": "slg", "ops": "ops"},
    "pitching": {"era": "era", "whip": "whip", "inningsPitched": "innings_pitched", "strikeOuts": "strikeouts", "baseOnBalls": "walks", "homeRuns": "home_runs_allowed"},
}


def team_stats(raw: DataFrame, body: str = "body", stat_type: str = "stat_type", who: str = "team") -> DataFrame:
    """Columns of both kinds; those of the other kind are null. ``who``: team, or player for the leaders' feed."""
    shape = f"stats array<struct<splits: array<struct<{who}: struct<id: bigint, name: string, fullName: string>, stat: map<string, string>>>>>"
    rows = raw.select(F.col(stat_type).alias("stat_type"), F.explode(F.get(F.from_json(body, shape)["stats"], F.lit(0))["splits"]).alias("s"))
    columns: dict[str, Column] = {}
    for kind, fields in STATS.items():
        for field, name in fields.items():
            value = F.when(F.col("stat_type") == kind, F.coalesce(F.col("s.stat")[field].try_cast("double"), F.lit(0.0)))
            columns[name] = F.coalesce(columns[name], value) if name in columns else value
    return rows.select(F.col(f"s.{who}.id").alias(f"{who}_id"), F.coalesce(f"s.{who}.name", f"s.{who}.fullName").alias(f"{who}_name"), "stat_type", F.coalesce(F.col("s.stat")["gamesPlayed"].try_cast("int"), F.lit(0)).alias("games_played"), *[c.alias(n) for n, c in columns.items()])


ROSTER = "roster array<struct<person: struct<id: bigint, fullName: string>, jerseyNumber: string, position: struct<code: string, name: string, type: string>, status: struct<code: string>>>"
MOVES = f"transactions array<struct<id: bigint, person: struct<id: bigint, fullName: string>, fromTeam: {NAMED}, toTeam: {NAMED}, date: date, typeCode: string, description: string>>"
TEAMS = f"teams array<struct<id: bigint, name: string, abbreviation: string, league: {NAMED}, division: {NAMED}, venue: {NAMED}, active: boolean>>"


def rosters(raw: DataFrame, body: str = "body", team: str = "team_id") -> DataFrame:
    p = raw.select(F.col(team).alias("team_id"), F.explode(F.from_json(body, ROSTER)["roster"]).alias("p"))
    return p.select("team_id", F.col("p.person.id").alias("player_id"), F.col("p.person.fullName").alias("player_name"), F.col("p.jerseyNumber").alias("jersey_number"), F.col("p.position.code").alias("position_code"), F.col("p.position.type").alias("position_type"), F.col("p.status.code").alias("status"))


def transactions(raw: DataFrame, body: str = "body") -> DataFrame:
    """Moves of a person; those without one go."""
    t = raw.select(F.explode(F.from_json(body, MOVES)["transactions"]).alias("t"))
    return t.select(F.col("t.id").alias("transaction_id"), F.col("t.person.id").alias("player_id"), F.col("t.person.fullName").alias("player_name"), F.col("t.fromTeam.id").alias("from_team_id"), F.col("t.toTeam.id").alias("to_team_id"), F.col("t.date").alias("date"), F.col("t.typeCode").alias("type_code"), F.col("t.description").alias("description")).dropna(subset=["player_id"])


def teams(raw: DataFrame, body: str = "body") -> DataFrame:
    t = raw.select(F.explode(F.from_json(body, TEAMS)["teams"]).alias("t"))
    return t.select(F.col("t.id").alias("team_id"), F.col("t.name").alias("name"), F.col("t.abbreviation").alias("abbreviation"), F.col("t.league.id").alias("league_id"), F.col("t.division.id").alias("division_id"), F.col("t.venue.id").alias("venue_id"), F.col("t.active").alias("active"))


def lineups_with_fallback(primary: DataFrame, raw: DataFrame, body: str = "body", key: str = "game_pk") -> DataFrame:
    """``primary`` (key, player_id, batting_order); games without an order there take the place in their payload's list, from 1."""
    listed = raw.select(key, F.posexplode(F.from_json(body, "lineup array<bigint>")["lineup"]).alias("at", "player_id"))
    return fallback_union(primary.where("batting_order IS NOT NULL"), listed.select(key, "player_id", (F.col("at") + 1).cast("int").alias("batting_order")), [key])
