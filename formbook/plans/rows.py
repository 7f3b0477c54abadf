"""Registered queries of whole game rows: form, quality, starters, series and ratings in one table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formbook.functions import features as X
from formbook.operators import elo
from formbook.operators import windows as win
from formbook.plans.assembled import m9_m10_full_table
from formbook.plans.catalog import G, games, leagues, oracle_of, r6, register, table

#: Days between two games of one pairing that still belong to one series.
SERIES_GAP = 4
PAIR = "(PARTITION BY home_team_id, away_team_id, season ORDER BY game_date, game_pk)"


def series(g: DataFrame, gap: int = SERIES_GAP) -> DataFrame:
    """(game_pk, series_game, series_home_wins): place of a game in its series, and what the home side won of it before."""
    pair = W.partitionBy("home_team_id", "away_team_id", "season").orderBy("game_date", "game_pk")
    opens = (F.coalesce(F.datediff("game_date", F.lag("game_date").over(pair)), F.lit(gap + 1)) > gap).cast("int")
    rows = g.withColumn("_opens", opens).withColumn("_series", F.sum("_opens").over(pair.rowsBetween(W.unboundedPreceding, 0)))
    inside = W.partitionBy("home_team_id", "away_team_id", "season", "_series").orderBy("game_date", "game_pk")
    won = (F.col("home_score") > F.col("away_score")).cast("int")
    return rows.select("game_pk", F.row_number().over(inside).cast("long").alias("series_game"), win.cumulative(won, inside).alias("series_home_wins"))


def starters(spark, d) -> DataFrame:
    """(game_pk, home_starter, away_starter) of the games."""
    return games(spark, d).select("game_pk", ((F.col("game_pk") * 7 + F.col("home_team_id")) % 50).alias("home_starter"), ((F.col("game_pk") * 11 + F.col("away_team_id")) % 50).alias("away_starter"))


def percentiles(spark, d) -> DataFrame:
    """(pitcher, xera, k_pct): percentile ranks of known pitchers (the brands stand for them), one row each."""
    brands = table(spark, d, "part").groupBy("p_brand").agg(F.avg("p_retailprice").alias("v"), F.count(F.lit(1)).alias("n"))
    rank = lambda c: F.percent_rank().over(W.orderBy(c)) * 100  # noqa: E731  a row for each brand
    return brands.select((F.row_number().over(W.orderBy("p_brand")) - 1).cast("long").alias("pitcher"), rank("v").alias("xera"), rank("n").alias("k_pct"))


def starter_quality(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """(game_pk, sp_quality_composite_diff, home_sp_known, away_sp_known, sp_both_known); an unknown starter, or metric, is at 50."""
    x = pairs
    for side in ("home", "away"):
        x = x.join(known.select(F.col("pitcher").alias(f"{side}_starter"), *[F.col(c).alias(f"{side}_{c}") for c in known.columns if c != "pitcher"], F.lit(1).alias(f"{side}_k")), f"{side}_starter", "left")
    metric = lambda side: {m: F.col(f"{side}_{m}") if m in known.columns else F.lit(None).cast("double") for m in X.STARTER_WEIGHTS}
    flag = lambda side: F.coalesce(f"{side}_k", F.lit(0))
    return x.select("game_pk", (F.round(X.starter_composite(metric("home"), metric("away")), 6) + 0.0).alias("sp_quality_composite_diff"), flag("home").alias("home_sp_known"), flag("away").alias("away_sp_known"), (flag("home") * flag("away")).alias("sp_both_known"))


def game_rows(spark, d) -> DataFrame:
    """The full table with starters and series."""
    quality, place = starter_quality(starters(spark, d), percentiles(spark, d)), series(games(spark, d))
    return m9_m10_full_table(spark, d).join(quality, "game_pk", "left").join(place, "game_pk", "left").withColumn("series_opener", (F.col("series_game") == 1).cast("int"))


@register(
    lambda: f"""WITH full_table AS ({oracle_of("m9_m10_full_table")}), {G}, b AS (SELECT p_brand, avg(p_retailprice) AS v, count(*) AS n FROM part GROUP BY 1),
 q AS (SELECT row_number() OVER (ORDER BY p_brand) - 1 AS pitcher, percent_rank() OVER (ORDER BY v) * 100 AS xera, percent_rank() OVER (ORDER BY n) * 100 AS k_pct FROM b),
 st AS (SELECT game_pk, (game_pk * 7 + home_team_id) % 50 AS hs, (game_pk * 11 + away_team_id) % 50 AS aws FROM g),
 sq AS (SELECT game_pk, round(0.35 * (coalesce(h.xera, 50) - coalesce(a.xera, 50)) + 0.25 * (coalesce(h.k_pct, 50) - coalesce(a.k_pct, 50)), 6) + 0.0::DOUBLE AS sp_quality_composite_diff, (h.pitcher IS NOT NULL)::INT AS home_sp_known, (a.pitcher IS NOT NULL)::INT AS away_sp_known FROM st LEFT JOIN q h ON h.pitcher = hs LEFT JOIN q a ON a.pitcher = aws),
 o AS (SELECT *, (coalesce(date_diff('day', lag(game_date) OVER {PAIR}, game_date), {SERIES_GAP + 1}) > {SERIES_GAP})::INT AS opens FROM g), s AS (SELECT *, sum(opens) OVER {PAIR} AS ser FROM o),
 sr AS (SELECT game_pk, row_number() OVER w::BIGINT AS series_game, coalesce(sum((home_score > away_score)::INT) OVER (PARTITION BY home_team_id, away_team_id, season, ser ORDER BY game_date, game_pk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS series_home_wins FROM s WINDOW w AS (PARTITION BY home_team_id, away_team_id, season, ser ORDER BY game_date, game_pk))
 SELECT full_table.*, sp_quality_composite_diff, home_sp_known, away_sp_known, home_sp_known * away_sp_known AS sp_both_known, series_game, series_home_wins, (series_game = 1)::INT AS series_opener FROM full_table LEFT JOIN sq USING (game_pk) LEFT JOIN sr USING (game_pk)"""
)
def m10_game_row(spark, d):
    return game_rows(spark, d)


@register()
def m10_rated_row(spark, d):
    """The game row with ratings before the game, their difference and the home side's probability."""
    rated = elo.replay(leagues(spark, d), pool="league").select("game_pk", r6(F.col("home_elo"), "home_elo"), r6(F.col("away_elo"), "away_elo"), r6(F.col("home_elo") - F.col("away_elo"), "elo_differential"), r6(F.col("home_probability"), "elo_home_win_prob"))
    return game_rows(spark, d).join(rated, "game_pk", "left")
