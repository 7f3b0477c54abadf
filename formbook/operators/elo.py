"""Elo: a sequential recurrence over one pool, in parallel over pools and configurations.

Spark sorts the games of a pool (on disk where they are many) and a Python worker takes them in order, batch by
batch: it holds one batch and one rating per team, whatever the number of games.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Defaults: points per result, home bonus, off-season regression to the mean.
K, BONUS, REGRESSION, START = 15.0, 80.0, 0.40, 1500.0
OUT = "pool string, config string, game_pk long, home_elo double, away_elo double, home_probability double"
STATE = "pool string, team_id long, rating double, games long"
#: Rows of an output batch.
BATCH = 10_000


def results(games: DataFrame, pool: str | None = None) -> DataFrame:
    """The finished games in seven slim columns."""
    return games.where("home_score IS NOT NULL AND away_score IS NOT NULL").select(
        (F.col(pool).cast("string") if pool else F.lit("all")).alias("pool"), "game_pk", F.unix_date("game_date").alias("day"), "season", "home_team_id", "away_team_id", (F.col("home_score") > F.col("away_score")).cast("double").alias("result")
    )


class Ratings:
    """The recurrence itself: one rating per team, regressed to the mean when a game of another season comes."""

    def __init__(self, k: float = K, bonus: float = BONUS, regression: float = REGRESSION, rating: dict[int, float] | None = None, season: int | None = None):
        self.k, self.bonus, self.regression, self.season = k, bonus, regression, season
        self.rating = rating or {}

    def play(self, season: int, home: int, away: int, result: float) -> tuple[float, float, float]:
        """Both ratings before the game and the home side's probability; the game is applied."""
        if self.season is not None and season != self.season:
            self.rating = {t: START + (1 - self.regression) * (r - START) for t, r in self.rating.items()}
        self.season = season
        x, y = self.rating.get(home, START), self.rating.get(away, START)
        p = 1 / (1 + 10 ** ((y - x - self.bonus) / 400))
        self.rating[home], self.rating[away] = x + self.k * (result - p), y - self.k * (result - p)
        self.rating.pop(None, None)  # an unknown team keeps no rating
        return x, y, p


def _in_order(rows: DataFrame, keys: list[str], first: list[str]) -> DataFrame:
    """Whole groups in one partition each, in (day, game) order; other columns break ties."""
    order = [*keys, *first, "day", "game_pk"]
    return rows.repartition(*keys).sortWithinPartitions(*[F.asc_nulls_last(c) for c in [*order, *(c for c in rows.columns if c not in order)]])


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def replay(games: DataFrame, configs: DataFrame | None = None, pool: str | None = None) -> DataFrame:
    """Pre-game ratings of both sides for every game of every (pool, configuration).

    A pool's games depend on each other in order, so a pool is one task's time, but not its memory.
    ``configs`` (config, k, bonus, regression) replays all of them side by side.
    """
    slim = results(games, pool)
    if configs is None:
        slim = slim.withColumns({"config": F.lit("default"), "k": F.lit(K), "bonus": F.lit(BONUS), "regression": F.lit(REGRESSION)})
    else:
        slim = slim.join(F.broadcast(configs))  # a parameter grid: a few dozen rows
    slim = slim.select("pool", "config", "k", "bonus", "regression", "day", "game_pk", "season", "home_team_id", "away_team_id", "result")
    return _in_order(slim, ["pool", "config"], []).mapInArrow(_replay, OUT)


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("pool", pa.string()), ("config", pa.string()), ("game_pk", pa.int64()), ("home_elo", pa.float64()), ("away_elo", pa.float64()), ("home_probability", pa.float64())])
    now, ratings, out = None, Ratings(), []
    for pool, config, k, bonus, regression, _, game, season, home, away, result in _tuples(batches):
        if now != (pool, config):
            now, ratings = (pool, config), Ratings(float(k), float(bonus), float(regression))
        out.append((pool, config, game, *ratings.play(season, home, away, result)))
        if len(out) == BATCH:
            yield _batch(out, schema)
            out = []
    if out:
        yield _batch(out, schema)


def grid(games: DataFrame, configs: list[tuple[str, float, float, float]], pool: str | None = None) -> DataFrame:
    """(config, n, accuracy, brier) of every configuration (name, k, bonus, regression), all in one pass over a pool: a team's rating is a vector with one number for each."""
    rows = results(games, pool).select("pool", "day", "game_pk", "season", "home_team_id", "away_team_id", "result")
    sums = _in_order(rows, ["pool"], []).mapInArrow(_grid(configs), "config string, n long, right long, squares double")
    per = sums.groupBy("config").agg(F.sum("n").alias("n"), F.sum("right").alias("right"), F.sum("squares").alias("squares"))
    return per.select("config", "n", (F.col("right") / F.col("n")).alias("accuracy"), (F.col("squares") / F.col("n")).alias("brier"))


def _grid(configs: list[tuple[str, float, float, float]]):
    names = [c[0] for c in configs]
    k, bonus, regression = np.array([c[1:] for c in configs], float).T

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, season_now, rating, n = None, None, {}, 0
        right, squares, start = np.zeros(len(names), np.int64), np.zeros(len(names)), np.full(len(names), START)
        for pool, _, _, season, home, away, result in _tuples(batches):
            if now != (pool,):
                now, season_now, rating = (pool,), None, {}
            if season_now is not None and season != season_now:
                rating = {t: START + (1 - regression) * (r - START) for t, r in rating.items()}
            season_now = season
            x, y = rating.get(home, start), rating.get(away, start)
            p = 1 / (1 + 10 ** ((y - x - bonus) / 400))
            rating[home], rating[away] = x + k * (result - p), y - k * (result - p)
            rating.pop(None, None)
            n += 1
            right += (p >= 0.5) == (result > 0.5)
            squares += (p - result) ** 2
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([n] * len(names), pa.int64()), pa.array(right), pa.array(squares)], ["config", "n", "right", "squares"])

    return of


def seed(ratings: DataFrame, regression: float = REGRESSION) -> DataFrame:
    """Ratings for a new season: regressed to the mean, their games counted anew."""
    return ratings.withColumns({"rating": START + (1 - regression) * (F.col("rating") - START), "games": F.lit(0).cast("long")})


def ratings_after(games: DataFrame, state: DataFrame | None = None, pool: str | None = None) -> DataFrame:
    """(pool, team_id, rating, games) after applying ``games`` to ``state``; teams without games keep their rating.

    Only new games and one row per team of a pool meet in its task. Games of a state must be of one season, or begin with the state's.
    """
    none = lambda kind: F.lit(None).cast(kind)
    rows = results(games, pool).withColumns({"rating": none("double"), "games": none("long"), "played": F.lit(True)})
    if state is not None:
        kept = state.select("pool", none("long").alias("game_pk"), none("int").alias("day"), none("long").alias("season"), F.col("team_id").alias("home_team_id"), none("long").alias("away_team_id"), none("double").alias("result"), "rating", "games", F.lit(False).alias("played"))
        rows = kept.unionByName(rows)
    rows = rows.select("pool", "played", "day", "game_pk", "season", "home_team_id", "away_team_id", "result", "rating", "games")
    return _in_order(rows, ["pool"], ["played"]).mapInArrow(_advance, STATE)


def _advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A pool's rows are its state, then its games in order; its ratings leave when the next pool begins."""
    schema = pa.schema([("pool", pa.string()), ("team_id", pa.int64()), ("rating", pa.float64()), ("games", pa.int64())])
    now, ratings, games = None, Ratings(), {}

    def state() -> Iterator[pa.RecordBatch]:
        teams = sorted(ratings.rating)
        for i in range(0, len(teams), BATCH):
            yield _batch([(now[0], t, ratings.rating[t], games[t]) for t in teams[i : i + BATCH]], schema)

    for pool, played, _, _, season, home, away, result, rating, count in _tuples(batches):
        if now != (pool,):
            if now is not None:
                yield from state()
            now, ratings, games = (pool,), Ratings(), {}
        if played:
            ratings.play(season, home, away, result)
            games[home], games[away] = games.get(home, 0) + 1, games.get(away, 0) + 1
        elif home is not None:
            ratings.rating[home], games[home] = rating, count
    if now is not None:
        yield from state()
