"""Registered queries of the reference's operators, each beside its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formbook.functions import scalars as S
from formbook.operators import asof, dedup, elo, quality, ranks, reshape, upkeep
from formbook.operators import windows as win
from formbook.sources.tables import games, leagues, pitches, predictions, table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

G = """g AS (SELECT o_orderkey AS game_pk, o_orderdate::DATE AS game_date, year(o_orderdate)::BIGINT AS season, o_custkey % 30 AS home_team_id, (o_custkey + 1 + o_orderkey % 29) % 30 AS away_team_id,
 floor(o_totalprice)::BIGINT % 11 AS home_score, floor(o_totalprice / 11)::BIGINT % 11 AS away_score, o_custkey % 30 AS venue_id, o_orderstatus AS status_code FROM orders)"""
T = (
    G
    + """, t AS (SELECT game_pk, game_date, season, TRUE AS is_home, home_team_id AS team_id, away_team_id AS opponent_id, home_score AS runs, away_score AS runs_allowed, (home_score > away_score)::INT AS won FROM g
 UNION ALL SELECT game_pk, game_date, season, FALSE, away_team_id, home_team_id, away_score, home_score, (away_score > home_score)::INT FROM g)"""
)
P = """p AS (SELECT event_id AS pitch_id, user_id % 50 AS pitcher, (props->>'$.k')::BIGINT AS batter, ts::DATE AS game_date, ts,
 CASE event_type WHEN 'purchase' THEN 'home_run' WHEN 'signup' THEN 'single' WHEN 'click' THEN 'walk' WHEN 'error' THEN 'strikeout' WHEN 'view' THEN 'field_out' END AS events, value AS release_speed,
 CASE WHEN user_id % 3 = 0 THEN 'L' ELSE 'R' END AS p_throws, CASE WHEN (props->>'$.k')::BIGINT % 2 = 0 THEN 'L' ELSE 'R' END AS stand,
 1 + event_id % 9 AS inning, CASE WHEN event_id % 2 = 0 THEN 'Top' ELSE 'Bot' END AS inning_topbot, (day(ts) * 10 + user_id % 10)::BIGINT AS game_pk FROM events)"""
ALL_T, SEASON_T = "PARTITION BY team_id ORDER BY game_date, game_pk", "PARTITION BY team_id, season ORDER BY game_date, game_pk"


def team_order():
    return W.partitionBy("team_id").orderBy("game_date", "game_pk")


def season_order():
    return W.partitionBy("team_id", "season").orderBy("game_date", "game_pk")


def r6(c, name: str):
    return F.round(c, 6).alias(name)


def register(sql: str | Callable[[], str] | None = None):
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql() if callable(sql) else sql
        return f

    return add


def oracle_of(name: str) -> str:
    return _SQL[name]


def team_rows(spark: SparkSession, d: str) -> DataFrame:
    return reshape.to_team_grain(games(spark, d))


# --- form table: U3, L1, U1, W1, W3, W8, W12, U2 ------------------------------
@register(
    f"""WITH {T}, a AS (SELECT *, avg(won) OVER ({ALL_T} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS f10, coalesce(sum(won) OVER ({SEASON_T} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w,
 least(date_diff('day', lag(game_date) OVER ({ALL_T}), game_date), 7) AS rest, lag(won) OVER ({SEASON_T}) AS lw FROM t),
 b AS (SELECT *, coalesce(sum((won <> lw)::INT) OVER ({SEASON_T} ROWS UNBOUNDED PRECEDING), 0) AS isl FROM a),
 c AS (SELECT *, row_number() OVER (PARTITION BY team_id, season, isl ORDER BY game_date, game_pk) * (CASE WHEN won = 1 THEN 1 ELSE -1 END) AS s FROM b),
 e AS (SELECT *, coalesce(lag(s) OVER ({SEASON_T}), 0) AS streak FROM c)
 SELECT game_pk, game_date, season, round(coalesce(max(f10) FILTER (is_home), 0.5), 6) AS home_form_10, max(w) FILTER (is_home)::BIGINT AS home_wins, max(streak) FILTER (is_home)::BIGINT AS home_streak, coalesce(max(rest) FILTER (is_home), 3)::BIGINT AS home_rest,
 round(coalesce(max(f10) FILTER (NOT is_home), 0.5), 6) AS away_form_10, max(w) FILTER (NOT is_home)::BIGINT AS away_wins, max(streak) FILTER (NOT is_home)::BIGINT AS away_streak, coalesce(max(rest) FILTER (NOT is_home), 3)::BIGINT AS away_rest FROM e GROUP BY 1, 2, 3"""
)
def form_table(spark: SparkSession, d: str) -> DataFrame:
    rows = team_rows(spark, d).withColumn("form_10", F.round(win.rolling("won", team_order(), 10, 0.5), 6)).withColumn("wins", win.cumulative("won", season_order()).cast("long")).withColumn("rest", win.rest_days("game_date", team_order()).cast("long"))
    rows = win.streaks(rows, "won", ["team_id", "season"], ["game_date", "game_pk"]).withColumn("streak", F.col("streak").cast("long"))
    return reshape.to_game_grain(rows, ["form_10", "wins", "streak", "rest"])


@register(f"WITH {T} SELECT * FROM t")
def u1_team_grain(spark, d):
    return team_rows(spark, d)


@register(
    f"""WITH {T} SELECT game_pk, team_id, round(avg(runs) OVER ({ALL_T} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS runs_3, round(avg(runs) OVER ({ALL_T} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS runs_7,
 round(avg(runs) OVER ({ALL_T} ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING), 6) AS runs_14, round(avg(runs) OVER ({ALL_T} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), 6) AS runs_30,
 round(avg(runs) OVER ({ALL_T} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) - avg(runs) OVER ({ALL_T} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), 6) AS recent_minus_base FROM t"""
)
def w1_w6_rolling_means(spark, d):
    cols = [r6(win.rolling("runs", team_order(), n), f"runs_{n}") for n in (3, 7, 14, 30)]
    return team_rows(spark, d).select("game_pk", "team_id", *cols, r6(win.rolling("runs", team_order(), 7) - win.rolling("runs", team_order(), 30), "recent_minus_base"))


@register(f"WITH {T} SELECT game_pk, team_id, round(avg(won) OVER ({ALL_T} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS win_rate_10, sum(runs) OVER ({SEASON_T} ROWS UNBOUNDED PRECEDING)::BIGINT AS season_runs, sum(won) OVER ({SEASON_T} ROWS UNBOUNDED PRECEDING)::BIGINT AS season_wins FROM t")
def w2_w3_inclusive(spark, d):
    upto = season_order().rowsBetween(W.unboundedPreceding, 0)
    return team_rows(spark, d).select("game_pk", "team_id", r6(F.avg("won").over(team_order().rowsBetween(-9, 0)), "win_rate_10"), F.sum("runs").over(upto).alias("season_runs"), F.sum("won").over(upto).cast("long").alias("season_wins"))


@register(
    f"""WITH {T}, n AS (SELECT *, row_number() OVER ({ALL_T}) AS i FROM t) SELECT game_pk, team_id,
 round(CASE WHEN count(runs) OVER ({ALL_T} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) >= 3 THEN -stddev_pop(runs) OVER ({ALL_T} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) END, 6) + 0.0::DOUBLE AS consistency,
 round(CASE WHEN count(runs) OVER ({ALL_T} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) >= 3 THEN greatest(-3.0, least(3.0, regr_slope(runs, i) OVER ({ALL_T} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING))) END, 6) + 0.0::DOUBLE AS momentum FROM n"""
)
def w4_w5_consistency_slope(spark, d):
    rows = team_rows(spark, d).withColumn("game_no", F.row_number().over(team_order()))
    return rows.select("game_pk", "team_id", (F.round(win.consistency("runs", team_order()), 6) + 0.0).alias("consistency"), (F.round(win.slope("runs", team_order()), 6) + 0.0).alias("momentum"))


@register(
    f"""WITH {T}, n AS (SELECT *, row_number() OVER ({ALL_T}) AS i FROM t), j AS (SELECT x.game_pk, x.team_id, sum(y.won * power(9.0 / 11.0, x.i - y.i - 1)) / sum(power(9.0 / 11.0, x.i - y.i - 1)) AS e
 FROM n x LEFT JOIN n y ON x.team_id = y.team_id AND y.i BETWEEN x.i - 30 AND x.i - 1 GROUP BY 1, 2) SELECT game_pk, team_id, round(e, 6) AS ema_form FROM j"""
)
def w7_ewm(spark, d):
    return team_rows(spark, d).select("game_pk", "team_id", r6(win.ewm("won", team_order()), "ema_form"))


@register(
    f"""WITH {T}, a AS (SELECT *, lag(won) OVER ({SEASON_T}) AS lw FROM t), b AS (SELECT *, coalesce(sum((won <> lw)::INT) OVER ({SEASON_T} ROWS UNBOUNDED PRECEDING), 0) AS isl FROM a),
 c AS (SELECT *, row_number() OVER (PARTITION BY team_id, season, isl ORDER BY game_date, game_pk) * (CASE WHEN won = 1 THEN 1 ELSE -1 END) AS s FROM b), e AS (SELECT *, coalesce(lag(s) OVER ({SEASON_T}), 0) AS streak FROM c)
 SELECT game_pk, team_id, streak::BIGINT AS streak, (streak >= 3)::INT AS hot, (streak <= -3)::INT AS cold, abs(streak)::BIGINT AS magnitude, sign(streak)::INT AS direction, CASE WHEN streak > 0 THEN 'W' || streak WHEN streak < 0 THEN 'L' || (-streak) ELSE '-' END AS label FROM e"""
)
def w8_w9_n24_streaks(spark, d):
    rows = win.streaks(team_rows(spark, d), "won", ["team_id", "season"], ["game_date", "game_pk"])
    s = F.col("streak")
    label = F.when(s > 0, F.concat(F.lit("W"), s)).when(s < 0, F.concat(F.lit("L"), -s)).otherwise("-")
    return rows.select("game_pk", "team_id", s.cast("long").alias("streak"), (s >= 3).cast("int").alias("hot"), (s <= -3).cast("int").alias("cold"), F.abs(s).cast("long").alias("magnitude"), F.signum(s.cast("double")).cast("int").alias("direction"), label.alias("label"))


@register(
    f"""WITH {P}, b AS (SELECT batter, pitch_id, (events IN ('single', 'home_run'))::INT AS hit, row_number() OVER (PARTITION BY batter ORDER BY game_date DESC, pitch_id DESC) AS rn FROM p WHERE batter IS NOT NULL)
 SELECT batter, coalesce(min(rn) FILTER (hit = 0) - 1, count(*))::BIGINT AS hit_streak FROM b GROUP BY 1"""
)
def w10_hit_streak(spark, d):
    rn = F.row_number().over(W.partitionBy("batter").orderBy(F.desc("game_date"), F.desc("pitch_id")))
    rows = pitches(spark, d).where("batter IS NOT NULL").select("batter", F.col("events").isin("single", "home_run").alias("hit"), rn.alias("rn"))
    return rows.groupBy("batter").agg(F.coalesce(F.min(F.when(~F.col("hit"), F.col("rn"))) - 1, F.count(F.lit(1))).cast("long").alias("hit_streak"))


@register(f"WITH {T} SELECT game_pk, team_id, lag(runs) OVER ({ALL_T}) AS last_runs, runs - lag(runs) OVER ({ALL_T}) AS delta, coalesce(least(date_diff('day', lag(game_date) OVER ({ALL_T}), game_date), 7), 3)::BIGINT AS rest, coalesce(date_diff('day', lag(game_date) OVER ({ALL_T}), game_date) = 1, FALSE) AS back_to_back FROM t")
def w11_w13_lag_rest(spark, d):
    last = F.lag("runs").over(team_order())
    gap = F.datediff("game_date", F.lag("game_date").over(team_order()))
    return team_rows(spark, d).select("game_pk", "team_id", last.alias("last_runs"), (F.col("runs") - last).alias("delta"), win.rest_days("game_date", team_order()).cast("long").alias("rest"), F.coalesce(gap == 1, F.lit(False)).alias("back_to_back"))


@register(
    f"""WITH {T}, n AS (SELECT *, row_number() OVER ({ALL_T}) AS i FROM t) SELECT game_pk, team_id, (i - 1 - coalesce(max(CASE WHEN is_home THEN i END) OVER ({ALL_T} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS trip FROM n"""
)
def w14_road_trip(spark, d):
    rows = team_rows(spark, d).withColumn("away", (~F.col("is_home")).cast("int"))
    return win.run_before(rows, "away", ["team_id"], ["game_date", "game_pk"], "trip").select("game_pk", "team_id", F.col("trip").cast("long").alias("trip"))


@register(f"WITH {T}, a AS (SELECT season, team_id, sum(won)::BIGINT AS wins FROM t GROUP BY 1, 2) SELECT *, row_number() OVER (PARTITION BY season ORDER BY wins DESC, team_id)::BIGINT AS place, rank() OVER (PARTITION BY season ORDER BY wins DESC)::BIGINT AS shared_place FROM a QUALIFY place <= 10")
def w15_w16_rank_qualify(spark, d):
    table_ = team_rows(spark, d).groupBy("season", "team_id").agg(F.sum("won").alias("wins"))
    by = W.partitionBy("season")
    ranked = table_.withColumn("place", F.row_number().over(by.orderBy(F.desc("wins"), "team_id")).cast("long")).withColumn("shared_place", F.rank().over(by.orderBy(F.desc("wins"))).cast("long"))
    return ranked.where("place <= 10")


STARTS = "s AS (SELECT pitcher, game_date, avg(release_speed) AS velo, count(*) AS n FROM p GROUP BY 1, 2)"


def starts(spark, d):
    return pitches(spark, d).groupBy("pitcher", "game_date").agg(F.avg("release_speed").alias("velo"), F.count(F.lit(1)).alias("n"))


@register(f"WITH {P}, {STARTS}, r AS (SELECT *, row_number() OVER (PARTITION BY pitcher ORDER BY game_date DESC) AS rn FROM s) SELECT pitcher, round(avg(velo) FILTER (rn <= 2) - avg(velo) FILTER (rn > 2), 6) AS velo_trend FROM r GROUP BY 1")
def w18_velocity_trend(spark, d):
    rn = F.row_number().over(W.partitionBy("pitcher").orderBy(F.desc("game_date")))
    r = starts(spark, d).withColumn("rn", rn)
    return r.groupBy("pitcher").agg(r6(F.avg(F.when(F.col("rn") <= 2, F.col("velo"))) - F.avg(F.when(F.col("rn") > 2, F.col("velo"))), "velo_trend"))


@register(
    f"WITH {P}, {STARTS} SELECT pitcher, game_date, round(coalesce(avg(velo) OVER (PARTITION BY pitcher ORDER BY game_date RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), avg(velo) OVER (PARTITION BY pitcher ORDER BY game_date RANGE BETWEEN INTERVAL 18 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)), 6) AS velo_recent FROM s"
)
def w19_time_range_mean(spark, d):
    s = starts(spark, d)
    return s.select("pitcher", "game_date", r6(F.coalesce(win.range_mean("velo", "game_date", ["pitcher"], 3), win.range_mean("velo", "game_date", ["pitcher"], 18)), "velo_recent"))


@register(
    f"""WITH {T}, h AS (SELECT *, least(team_id, opponent_id) AS a, greatest(team_id, opponent_id) AS b FROM t WHERE is_home), m AS (SELECT *, CASE WHEN runs > runs_allowed THEN team_id WHEN runs < runs_allowed THEN opponent_id END AS winner FROM h)
 SELECT game_pk, coalesce(count(*) OVER w, 0)::BIGINT AS met, coalesce(sum((winner = a)::INT) OVER w, 0)::BIGINT AS lower_id_won FROM m WINDOW w AS (PARTITION BY a, b ORDER BY game_date, game_pk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
)
def w21_head_to_head(spark, d):
    g = games(spark, d).withColumn("a", F.least("home_team_id", "away_team_id")).withColumn("b", F.greatest("home_team_id", "away_team_id"))
    winner = F.when(F.col("home_score") > F.col("away_score"), F.col("home_team_id")).when(F.col("home_score") < F.col("away_score"), F.col("away_team_id"))
    w = win.before(W.partitionBy("a", "b").orderBy("game_date", "game_pk"))
    return g.withColumn("winner", winner).select("game_pk", F.count(F.lit(1)).over(w).alias("met"), F.coalesce(F.sum((F.col("winner") == F.col("a")).cast("int")).over(w), F.lit(0)).cast("long").alias("lower_id_won"))


@register(f"WITH {T}, a AS (SELECT game_pk, team_id, count(*) OVER ({SEASON_T} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)::BIGINT AS played FROM t) SELECT *, round(played / 162.0, 6) AS complete, CASE WHEN played < 40 THEN 'early' WHEN played < 120 THEN 'middle' ELSE 'late' END AS stage FROM a")
def w22_season_stage(spark, d):
    rows = team_rows(spark, d).withColumn("played", F.count(F.lit(1)).over(win.before(season_order())))
    return rows.select("game_pk", "team_id", "played", r6(F.col("played") / F.lit(162.0), "complete"), S.season_stage(F.col("played")).alias("stage"))


@register(f"WITH {P}, c AS (SELECT game_date, game_pk, inning_topbot, pitcher, count(*) AS n FROM p WHERE inning <= 3 GROUP BY 1, 2, 3, 4) SELECT game_date, game_pk, CASE WHEN inning_topbot = 'Top' THEN 'home' ELSE 'away' END AS side, pitcher AS starter FROM c QUALIFY row_number() OVER (PARTITION BY game_date, game_pk, inning_topbot ORDER BY n DESC, pitcher) = 1")
def w23_starters(spark, d):
    c = pitches(spark, d).where("inning <= 3").groupBy("game_date", "game_pk", "inning_topbot", "pitcher").agg(F.count(F.lit(1)).alias("n"))
    first = dedup.latest_per_key(c, ["game_date", "game_pk", "inning_topbot"], [F.desc("n"), F.asc("pitcher")])
    return first.select("game_date", "game_pk", F.when(F.col("inning_topbot") == "Top", "home").otherwise("away").alias("side"), F.col("pitcher").alias("starter"))


@register(f"WITH {P}, c AS (SELECT game_date, game_pk, inning_topbot, batter, min(pitch_id) AS first_at FROM p WHERE batter IS NOT NULL GROUP BY 1, 2, 3, 4) SELECT game_date, game_pk, inning_topbot, batter, row_number() OVER (PARTITION BY game_date, game_pk, inning_topbot ORDER BY first_at, batter)::BIGINT AS slot FROM c QUALIFY slot <= 9")
def w24_lineup_slots(spark, d):
    c = pitches(spark, d).where("batter IS NOT NULL").groupBy("game_date", "game_pk", "inning_topbot", "batter").agg(F.min("pitch_id").alias("first_at"))
    return dedup.top_k(c, ["game_date", "game_pk", "inning_topbot"], [F.asc("first_at"), F.asc("batter")], 9, "slot").withColumn("slot", F.col("slot").cast("long")).drop("first_at")


# --- aggregations -------------------------------------------------------------
#: Linear weights of events, in thousandths, so that sums are exact.
WEIGHTS = {"walk": 690, "hit_by_pitch": 720, "single": 880, "double": 1247, "triple": 1578, "home_run": 2031}


def weight():
    return F.coalesce(F.create_map(*[F.lit(x) for kv in WEIGHTS.items() for x in kv])[F.col("events")], F.lit(0)).cast("long")


SPLIT = "count(*)::BIGINT AS pa, count(*) FILTER (events = 'strikeout')::BIGINT AS k, count(*) FILTER (events = 'walk')::BIGINT AS bb, count(*) FILTER (events = 'home_run')::BIGINT AS hr, round(sum(CASE events WHEN 'walk' THEN 690 WHEN 'single' THEN 880 WHEN 'home_run' THEN 2031 ELSE 0 END) / (1000.0 * count(*)), 6) AS woba"


def split(df: DataFrame, *by: str) -> DataFrame:
    is_ = lambda e: F.count_if(F.col("events") == e)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("pa"), is_("strikeout").alias("k"), is_("walk").alias("bb"), is_("home_run").alias("hr"), r6(F.sum(weight()) / (1000 * F.count(F.lit(1))), "woba"))


@register(f"WITH {P} SELECT batter, p_throws, {SPLIT} FROM p GROUP BY 1, 2 HAVING count(*) >= 15")
def a1_a3_a13_batter_splits(spark, d):
    return split(pitches(spark, d), "batter", "p_throws").where("pa >= 15")


@register(f"WITH {P} SELECT pitcher, batter, {SPLIT} FROM p GROUP BY 1, 2")
def a17_pitcher_batter_splits(spark, d):
    return split(pitches(spark, d), "pitcher", "batter")


@register(f"WITH {P} SELECT pitcher, stand, game_date, {SPLIT} FROM p GROUP BY GROUPING SETS ((pitcher, stand), (pitcher, game_date))")
def a18_grouping_sets(spark, d):
    return spark.sql(
        """SELECT pitcher, stand, game_date, count(1) AS pa, count_if(events = 'strikeout') AS k, count_if(events = 'walk') AS bb, count_if(events = 'home_run') AS hr,
        round(sum(CASE events WHEN 'walk' THEN 690 WHEN 'single' THEN 880 WHEN 'home_run' THEN 2031 ELSE 0 END) / (1000 * count(1)), 6) AS woba FROM {p} GROUP BY GROUPING SETS ((pitcher, stand), (pitcher, game_date))""",
        p=pitches(spark, d),
    )


@register(
    f"""WITH {P}, m AS (SELECT game_pk, batter, count(*) AS pa, sum(CASE events WHEN 'walk' THEN 690 WHEN 'single' THEN 880 WHEN 'home_run' THEN 2031 ELSE 0 END) AS num FROM p GROUP BY 1, 2)
 SELECT game_pk, round(sum(CASE WHEN pa >= 2 THEN num END) / nullif(1000 * sum(CASE WHEN pa >= 2 THEN pa END), 0), 5) AS ratio_of_sums, round(avg(CASE WHEN pa >= 2 THEN num / (1000 * pa) END), 5) AS mean_of_ratios FROM m GROUP BY 1"""
)
def a4_a5_lineup_rates(spark, d):
    m = pitches(spark, d).groupBy("game_pk", "batter").agg(F.count(F.lit(1)).alias("pa"), F.sum(weight()).alias("num"))
    ok = lambda c: F.when(F.col("pa") >= 2, c)
    return m.groupBy("game_pk").agg(F.round(S.ratio(F.sum(ok(F.col("num"))), 1000 * F.sum(ok(F.col("pa")))), 5).alias("ratio_of_sums"), F.round(F.avg(ok(F.col("num") / (1000 * F.col("pa")))), 5).alias("mean_of_ratios"))


@register(
    f"""WITH {P}, m AS (SELECT pitcher, batter, count(*) AS n, avg((events IN ('single', 'home_run'))::INT) AS rate, sum((events IN ('single', 'home_run'))::INT) AS x FROM p GROUP BY 1, 2)
 SELECT pitcher, batter, round(CASE WHEN n >= 5 THEN n / (n + 50.0) * rate + (1 - n / (n + 50.0)) * 0.32 END, 6) AS shrunk, round((x + 2.0) / (n + 4.0), 6) AS beta_mean, round(sqrt((x + 2.0) * (n - x + 2.0) / (power(n + 4.0, 2) * (n + 5.0))), 6) AS beta_std FROM m"""
)
def a7_a8_shrinkage(spark, d):
    hit = F.col("events").isin("single", "home_run").cast("int")
    m = pitches(spark, d).groupBy("pitcher", "batter").agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("rate"), F.sum(hit).alias("x"))
    mean, std = S.beta_posterior(F.col("x"), F.col("n"))
    return m.select("pitcher", "batter", r6(S.shrunken(F.col("rate"), F.col("n"), 0.32), "shrunk"), r6(mean, "beta_mean"), r6(std, "beta_std"))


@register(f"WITH {P} SELECT pitcher, round(avg((stand = p_throws)::INT), 6) AS same_hand, count(DISTINCT batter)::BIGINT AS batters, count(DISTINCT CASE WHEN inning > 6 THEN batter END)::BIGINT AS late_batters, count(DISTINCT date_trunc('month', game_date))::BIGINT AS months, max(p_throws) AS throws FROM p GROUP BY 1")
def a9_a14_distinct_counts(spark, d):
    return pitches(spark, d).groupBy("pitcher").agg(
        r6(F.avg((F.col("stand") == F.col("p_throws")).cast("int")), "same_hand"), F.countDistinct("batter").alias("batters"), F.countDistinct(F.when(F.col("inning") > 6, F.col("batter"))).alias("late_batters"),
        F.countDistinct(F.trunc("game_date", "month")).alias("months"), F.max("p_throws").alias("throws"),
    )


@register(f"WITH {P} SELECT pitcher, game_date, count(*)::BIGINT AS n, round(avg(release_speed), 6) AS velo, round(stddev_samp(release_speed), 6) AS velo_sd, round(avg((events = 'strikeout')::INT), 6) AS k_share, round(min(release_speed), 6) AS slowest, round(max(release_speed), 6) AS fastest FROM p GROUP BY 1, 2")
def a15_a16_a27_pitcher_games(spark, d):
    v = F.col("release_speed")
    return pitches(spark, d).groupBy("pitcher", "game_date").agg(F.count(F.lit(1)).alias("n"), r6(F.avg(v), "velo"), r6(F.stddev_samp(v), "velo_sd"), r6(F.avg((F.col("events") == "strikeout").cast("int")), "k_share"), r6(F.min(v), "slowest"), r6(F.max(v), "fastest"))


@register(f"WITH {G}, v AS (SELECT venue_id, avg(home_score + away_score) AS m, count(*) AS n FROM g GROUP BY 1), a AS (SELECT avg(home_score + away_score) AS m FROM g) SELECT venue_id, n::BIGINT AS games, round(v.m / a.m, 6) AS park_factor, CASE WHEN v.m / a.m > 1.05 THEN 'hitter' WHEN v.m / a.m < 0.95 THEN 'pitcher' ELSE 'neutral' END AS kind FROM v, a WHERE n >= 100")
def a19_n17_park_factors(spark, d):
    g = games(spark, d).withColumn("total", F.col("home_score") + F.col("away_score"))
    per = g.groupBy("venue_id").agg(F.avg("total").alias("m"), F.count(F.lit(1)).alias("games")).where("games >= 100")
    factor = F.col("m") / F.col("overall")
    return per.join(F.broadcast(g.agg(F.avg("total").alias("overall")))).select("venue_id", "games", r6(factor, "park_factor"), F.when(factor > 1.05, "hitter").when(factor < 0.95, "pitcher").otherwise("neutral").alias("kind"))  # one row


@register(f"WITH {P}, x AS (SELECT *, date_diff('day', game_date, DATE '2024-02-01') AS ago FROM p) SELECT pitcher, round(sum(greatest(0.0, 1 - 0.1 * ago)) / 100, 6) AS fatigue, count(*) FILTER (ago <= 7)::BIGINT AS load_7, round(sum(release_speed * inning) / sum(inning), 6) AS weighted_speed FROM x GROUP BY 1")
def a21_a22_weighted(spark, d):
    ago = F.datediff(F.lit("2024-02-01").cast("date"), "game_date")
    return pitches(spark, d).withColumn("ago", ago).groupBy("pitcher").agg(r6(F.sum(F.greatest(F.lit(0.0), 1 - 0.1 * F.col("ago"))) / 100, "fatigue"), F.count_if(F.col("ago") <= 7).alias("load_7"), r6(F.sum(F.col("release_speed") * F.col("inning")) / F.sum("inning"), "weighted_speed"))


@register(f"WITH {G} SELECT least(home_team_id, away_team_id) AS a, greatest(home_team_id, away_team_id) AS b, season, count(*)::BIGINT AS met, sum(CASE WHEN (home_score > away_score AND home_team_id < away_team_id) OR (away_score > home_score AND away_team_id < home_team_id) THEN 1 ELSE 0 END)::BIGINT AS a_won FROM g GROUP BY 1, 2, 3")
def a23_yearly_h2h(spark, d):
    first = ((F.col("home_score") > F.col("away_score")) & (F.col("home_team_id") < F.col("away_team_id"))) | ((F.col("away_score") > F.col("home_score")) & (F.col("away_team_id") < F.col("home_team_id")))
    return games(spark, d).groupBy(F.least("home_team_id", "away_team_id").alias("a"), F.greatest("home_team_id", "away_team_id").alias("b"), "season").agg(F.count(F.lit(1)).alias("met"), F.count_if(first).alias("a_won"))


@register(
    """WITH s AS (SELECT p_brand, avg(p_retailprice) AS v FROM part GROUP BY 1), m AS (SELECT min(v) AS lo, max(v) AS hi, count(*) AS n FROM s)
 SELECT p_brand, round((v - lo) / (hi - lo + 1e-6) * 100, 6) AS scaled, round((rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0) / n * 100, 6) AS percentile FROM s, m"""
)
def a24_a25_scaling(spark, d):
    s = table(spark, d, "part").groupBy("p_brand").agg(F.avg("p_retailprice").alias("v"))  # one row for each brand
    m = s.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n"))
    both = s.join(F.broadcast(m))
    rank = F.rank().over(W.orderBy("v")) + (F.count(F.lit(1)).over(W.partitionBy("v")) - 1) / 2
    return both.select("p_brand", r6((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo") + 1e-6) * 100, "scaled"), r6(rank / F.col("n") * 100, "percentile"))


@register("SELECT median(l_quantity) AS quantity, median(l_discount) AS discount, median(l_tax) AS tax FROM lineitem")
def a26_medians(spark, d):
    found = upkeep.medians(table(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"])
    return spark.range(1).select(*[F.lit(v).cast("double").alias(c.removeprefix("l_")) for c, v in found.items()])


@register(f"WITH {T} SELECT team_id, round(avg(won) FILTER (is_home), 6) AS home_rate, round(avg(won) FILTER (NOT is_home), 6) AS away_rate, round(avg(won) FILTER (is_home) - avg(won) FILTER (NOT is_home), 6) AS advantage FROM t GROUP BY 1")
def a28_home_advantage(spark, d):
    home, away = F.avg(F.when(F.col("is_home"), F.col("won"))), F.avg(F.when(~F.col("is_home"), F.col("won")))
    return team_rows(spark, d).groupBy("team_id").agg(r6(home, "home_rate"), r6(away, "away_rate"), r6(home - away, "advantage"))


# --- top-k, joins -------------------------------------------------------------
@register(f"WITH {G} SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY home_team_id ORDER BY game_date DESC, game_pk DESC) = 1")
def l1_latest(spark, d):
    return dedup.latest_per_key(games(spark, d), ["home_team_id"], [F.desc("game_date"), F.desc("game_pk")])


@register(f"WITH {P}, s AS (SELECT pitcher, batter, avg(release_speed) AS v FROM p GROUP BY 1, 2), x AS (SELECT *, row_number() OVER (PARTITION BY pitcher ORDER BY v DESC, batter) AS u, row_number() OVER (PARTITION BY pitcher ORDER BY v, batter) AS dn FROM s) SELECT pitcher, batter, round(v, 6) AS v, CASE WHEN u <= 3 AND v >= 50 THEN 'hot' ELSE 'cold' END AS \"end\" FROM x WHERE (u <= 3 AND v >= 50) OR (dn <= 3 AND v <= 20)")
def l5_l6_both_ends(spark, d):
    s = pitches(spark, d).groupBy("pitcher", "batter").agg(F.avg("release_speed").alias("v"))
    return dedup.both_ends(s, ["pitcher"], "v", "batter", 3, 50.0, 20.0).withColumn("v", F.round("v", 6))


@register(f"WITH {P}, s AS (SELECT pitcher, count(*)::BIGINT AS n, avg(release_speed) AS v FROM p GROUP BY 1 HAVING count(*) > 100) SELECT pitcher, n, round(v, 6) AS velo FROM s ORDER BY v DESC, pitcher LIMIT 10")
def l4_l11_top(spark, d):
    s = pitches(spark, d).groupBy("pitcher").agg(F.count(F.lit(1)).alias("n"), F.avg("release_speed").alias("v")).where("n > 100")
    return s.orderBy(F.desc("v"), "pitcher").limit(10).select("pitcher", "n", r6(F.col("v"), "velo"))


@register(f"WITH {T}, s AS (SELECT team_id, game_date, sum(runs)::BIGINT AS day_runs FROM t GROUP BY 1, 2) SELECT g.game_pk, x.day_runs AS last_day_runs FROM g LEFT JOIN LATERAL (SELECT day_runs FROM s WHERE s.team_id = g.home_team_id AND s.game_date < g.game_date ORDER BY s.game_date DESC LIMIT 1) x ON TRUE")
def j5_j6_as_of(spark, d):
    snaps = team_rows(spark, d).groupBy("team_id", "game_date").agg(F.sum("runs").alias("day_runs")).withColumnRenamed("game_date", "snap_date")
    left = games(spark, d).select("game_pk", F.col("home_team_id").alias("team_id"), "game_date")
    met = asof.as_of(left, snaps, ["team_id"], "game_date", "snap_date", ["day_runs"], strict=True)
    return met.select("game_pk", F.col("day_runs").alias("last_day_runs"))


MONTHS = "m AS (SELECT home_team_id AS team_id, date_trunc('month', game_date)::DATE AS snapshot_date, (sum(home_score) % 3)::BIGINT AS grade FROM g GROUP BY 1, 2)"
SCD = f"{MONTHS}, c AS (SELECT *, lag(grade) OVER (PARTITION BY team_id ORDER BY snapshot_date) AS lg FROM m), v AS (SELECT team_id, grade, snapshot_date AS valid_from, (lead(snapshot_date) OVER (PARTITION BY team_id ORDER BY snapshot_date) - INTERVAL 1 DAY)::DATE AS valid_to FROM c WHERE lg IS NULL OR lg <> grade)"


def grade_versions(spark, d):
    m = games(spark, d).groupBy(F.col("home_team_id").alias("team_id"), F.trunc("game_date", "month").alias("snapshot_date")).agg((F.sum("home_score") % 3).alias("grade"))
    return asof.scd2(m, "team_id", "snapshot_date", ["grade"])


@register(f"WITH {G}, {SCD} SELECT team_id, grade, valid_from, valid_to, valid_to IS NULL AS is_current FROM v")
def z7_scd2(spark, d):
    return grade_versions(spark, d)


@register(f"WITH {G}, {SCD} SELECT g.game_pk, v.grade FROM g JOIN v ON g.home_team_id = v.team_id AND g.game_date >= v.valid_from AND g.game_date <= coalesce(v.valid_to, DATE '9999-12-31')")
def j7_validity_join(spark, d):
    facts = games(spark, d).select("game_pk", F.col("home_team_id").alias("team_id"), "game_date")
    return asof.valid_at(facts, grade_versions(spark, d).select("team_id", "grade", "valid_from", "valid_to"), "team_id", "game_date").select("game_pk", "grade")


@register(f"WITH {T}, s AS (SELECT team_id, season, avg(runs) AS v FROM t WHERE team_id % 4 <> season % 4 GROUP BY 1, 2) SELECT g.game_pk, round(coalesce((SELECT v FROM s WHERE s.team_id = g.home_team_id AND s.season BETWEEN g.season - 3 AND g.season ORDER BY s.season DESC LIMIT 1), 4.5), 6) AS quality FROM g")
def j12_j13_fallback_years(spark, d):
    lookup = team_rows(spark, d).where("team_id % 4 <> season % 4").groupBy("team_id", "season").agg(F.avg("runs").alias("quality"))
    left = games(spark, d).select("game_pk", F.col("home_team_id").alias("team_id"), "season")
    return asof.fallback_years(left, lookup, "team_id", "season", "quality", 3, 4.5).select("game_pk", r6(F.col("quality"), "quality"))


@register(f"WITH {G}, a AS (SELECT game_pk, home_team_id, 'games' AS src FROM g WHERE game_pk % 3 = 0), b AS (SELECT game_pk, home_team_id, 'other' AS src FROM g) SELECT * FROM a UNION ALL SELECT * FROM b WHERE game_pk NOT IN (SELECT game_pk FROM a)")
def j9_fallback_union(spark, d):
    g = games(spark, d).select("game_pk", "home_team_id")
    return dedup.fallback_union(g.where("game_pk % 3 = 0").withColumn("src", F.lit("games")), g.withColumn("src", F.lit("other")), ["game_pk"])


@register("SELECT n_name, r_name, count(*)::BIGINT AS orders, round(sum(o_totalprice), 2) AS spend FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2")
def j1_j17_star_join(spark, d):
    # Dimensions are joined plainly: Spark broadcasts them by their measured size.
    o, c, n, r = (table(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    met = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return met.groupBy("n_name", "r_name").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("spend"))


@register("SELECT (SELECT count(*) FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))::BIGINT AS semi, (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))::BIGINT AS anti")
def j14_j15_semi_anti(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    semi = o.join(c.where("c_acctbal > 0"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").agg(F.count(F.lit(1)).alias("semi"))
    anti = c.join(o, F.col("o_custkey") == F.col("c_custkey"), "left_anti").agg(F.count(F.lit(1)).alias("anti"))
    return semi.join(anti)  # two single rows


@register(
    f"""WITH {P}, a AS (SELECT pitcher, batter, p_throws, count(*) AS n, avg(release_speed) AS h2h FROM p GROUP BY 1, 2, 3), b AS (SELECT batter, p_throws, avg(release_speed) AS platoon FROM p GROUP BY 1, 2)
 SELECT a.pitcher, a.batter, round(h2h, 6) AS h2h, round(platoon, 6) AS platoon, round(h2h - platoon, 6) AS edge FROM a LEFT JOIN b ON a.batter = b.batter AND a.p_throws = b.p_throws WHERE a.batter IS NOT NULL"""
)
def j19_j22_double_left_join(spark, d):
    p = pitches(spark, d)
    a = p.where("batter IS NOT NULL").groupBy("pitcher", "batter", "p_throws").agg(F.avg("release_speed").alias("h2h"))
    b = p.groupBy("batter", "p_throws").agg(F.avg("release_speed").alias("platoon"))
    return a.join(b, ["batter", "p_throws"], "left").select("pitcher", "batter", r6(F.col("h2h"), "h2h"), r6(F.col("platoon"), "platoon"), r6(F.col("h2h") - F.col("platoon"), "edge"))


# --- scalars ------------------------------------------------------------------
@register(f"WITH {T}, s AS (SELECT team_id, season, sum(runs) AS f, sum(runs_allowed) AS a, avg(won) AS w FROM t GROUP BY 1, 2) SELECT team_id, season, round(CASE WHEN f + a > 0 THEN power(f, 1.83) / (power(f, 1.83) + power(a, 1.83)) ELSE 0.5 END, 6) AS expected, round(w - CASE WHEN f + a > 0 THEN power(f, 1.83) / (power(f, 1.83) + power(a, 1.83)) ELSE 0.5 END, 6) AS luck FROM s")
def n2_n3_pythagorean(spark, d):
    s = team_rows(spark, d).groupBy("team_id", "season").agg(F.sum("runs").alias("f"), F.sum("runs_allowed").alias("a"), F.avg("won").alias("w"))
    x = S.pythagorean(F.col("f"), F.col("a"))
    return s.select("team_id", "season", r6(x, "expected"), r6(F.col("w") - x, "luck"))


@register(
    f"""WITH {G} SELECT game_pk, month(game_date)::INT AS month, (isodow(game_date) - 1)::INT AS weekday, (isodow(game_date) >= 5)::INT AS weekend_fri, (isodow(game_date) >= 6)::INT AS weekend_sat, quarter(game_date)::INT AS quarter, dayofyear(game_date)::INT AS day_of_year,
 round(power(sin(pi() * ((date_diff('day', DATE '2000-01-06', game_date) % 29.53059::DOUBLE + 29.53059::DOUBLE) % 29.53059::DOUBLE) / 29.53059::DOUBLE), 2), 6) AS moon FROM g"""
)
def n18_n20_calendar(spark, d):
    g, x = games(spark, d), F.col("game_date")
    return g.select("game_pk", F.month(x).alias("month"), F.weekday(x).alias("weekday"), (F.weekday(x) >= 4).cast("int").alias("weekend_fri"), (F.weekday(x) >= 5).cast("int").alias("weekend_sat"), F.quarter(x).alias("quarter"), F.dayofyear(x).alias("day_of_year"), r6(S.moon_illumination(x), "moon"))


@register(f"WITH {G} SELECT game_pk, " + ", ".join(f"(month(game_date) = {m})::INT AS month_{m}" for m in range(3, 11)) + ", CASE WHEN home_score > 0 AND home_score <= 3 THEN 'low' WHEN home_score > 3 AND home_score <= 6 THEN 'mid' WHEN home_score > 6 THEN 'high' END AS scored FROM g")
def u6_u7_one_hot_buckets(spark, d):
    g = reshape.one_hot(games(spark, d).withColumn("month", F.month("game_date")), "month", list(range(3, 11)), "month")
    return g.select("game_pk", *[f"month_{m}" for m in range(3, 11)], reshape.bucketize(F.col("home_score"), [0, 3, 6], ["low", "mid", "high"]).alias("scored"))


PRED = "x AS (SELECT doc_id AS game_pk, toxic::BIGINT AS y, (doc_id * 37 % 100) / 100.0 AS p FROM labels)"


@register(
    f"""WITH {PRED}, c AS (SELECT *, greatest(1e-6, least(1 - 1e-6, p)) AS q, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS rk FROM x)
 SELECT count(*)::BIGINT AS n, round(avg(((p >= 0.5)::INT = y)::INT), 6) AS accuracy, round(avg(power(p - y, 2)), 6) AS brier, round(-avg(y * ln(q) + (1 - y) * ln(1 - q)), 6) AS log_loss,
 round((sum(rk) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0) / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)), 6) AS auc FROM c"""
)
def m23_metrics(spark, d):
    # Ranks from counts per distinct probability, summed by ranges of it.
    x = predictions(spark, d)
    per = ranks.ahead(x.groupBy("p").agg(F.count(F.lit(1)).alias("m"), F.sum("y").alias("pos")), "p", "m")
    pos = per.withColumn("rk", F.col("ahead") + (F.col("m") + 1) / 2).agg(F.sum(F.col("rk") * F.col("pos")).alias("ranks"))
    q = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("p")))
    one = x.agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg(((F.col("p") >= 0.5).cast("int") == F.col("y")).cast("int")), "accuracy"), r6(F.avg(F.pow(F.col("p") - F.col("y"), F.lit(2))), "brier"),
        r6(-F.avg(F.col("y") * F.log(q) + (1 - F.col("y")) * F.log(1 - q)), "log_loss"), F.sum("y").alias("n1"),
    )
    auc = (F.col("ranks") - F.col("n1") * (F.col("n1") + 1) / 2) / (F.col("n1") * (F.col("n") - F.col("n1")))
    return one.join(pos).select("n", "accuracy", "brier", "log_loss", r6(auc, "auc"))  # two single rows


@register(f"WITH {PRED}, h AS (SELECT unnest([0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8]) AS threshold) SELECT threshold::DOUBLE AS threshold, count(*)::BIGINT AS n, round(count(*) / (SELECT count(*) FROM x)::DOUBLE, 6) AS coverage, round(avg(((p >= 0.5)::INT = y)::INT), 6) AS accuracy FROM h JOIN x ON greatest(p, 1 - p) >= threshold GROUP BY 1")
def m24_confidence_curve(spark, d):
    x = predictions(spark, d).withColumn("sure", F.greatest(F.col("p"), 1 - F.col("p")))
    at = F.explode(F.filter(F.array(*[F.lit(t) for t in (0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8)]), lambda t: F.col("sure") >= t))
    total = x.agg(F.count(F.lit(1)).alias("total"))
    per = x.withColumn("threshold", at).groupBy("threshold").agg(F.count(F.lit(1)).alias("n"), r6(F.avg(((F.col("p") >= 0.5).cast("int") == F.col("y")).cast("int")), "accuracy"))
    return per.join(F.broadcast(total)).select("threshold", "n", r6(F.col("n") / F.col("total"), "coverage"), "accuracy")  # one row


@register(f"WITH {PRED} SELECT CASE WHEN greatest(p, 1 - p) >= 0.64 THEN 'high' WHEN greatest(p, 1 - p) >= 0.57 THEN 'medium' ELSE 'low' END AS tier, count(*)::BIGINT AS n, round(avg(((p >= 0.5)::INT = y)::INT), 6) AS accuracy, round(avg(power(p - y, 2)), 6) AS brier FROM x GROUP BY 1")
def m25_n22_backtest(spark, d):
    x = predictions(spark, d).withColumn("tier", S.confidence_tier(F.col("p")))
    return x.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), r6(F.avg(((F.col("p") >= 0.5).cast("int") == F.col("y")).cast("int")), "accuracy"), r6(F.avg(F.pow(F.col("p") - F.col("y"), F.lit(2))), "brier"))


@register(f"WITH {G}, s AS (SELECT min(season) AS lo, max(season) AS hi FROM g), f AS (SELECT unnest(generate_series(lo + 3, hi)) AS fold FROM s) SELECT fold::BIGINT AS fold, count(*) FILTER (season < fold)::BIGINT AS train, count(*) FILTER (season = fold)::BIGINT AS test FROM f JOIN g ON season <= fold GROUP BY 1")
def m12_walk_forward(spark, d):
    per = games(spark, d).groupBy("season").agg(F.count(F.lit(1)).alias("n"))  # a row for each season
    w = W.orderBy("season").rowsBetween(W.unboundedPreceding, -1)
    lo = F.min("season").over(W.orderBy("season").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return per.select(F.col("season").alias("fold"), F.sum("n").over(w).alias("train"), F.col("n").alias("test"), lo.alias("lo")).where("fold >= lo + 3").drop("lo")


@register(f"WITH {G} SELECT DISTINCT team_id FROM (SELECT home_team_id AS team_id FROM g UNION SELECT away_team_id FROM g)")
def u4_m34_dim_teams(spark, d):
    g = games(spark, d)
    return g.select(F.col("home_team_id").alias("team_id")).union(g.select("away_team_id")).distinct()


# --- quality ------------------------------------------------------------------
@register(
    f"""WITH {G}, l AS (SELECT count(*) AS c FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)), r AS (
 SELECT 'negative_score' AS check_name, 'error' AS severity, count(*) FILTER (home_score < 0 OR away_score < 0)::BIGINT AS actual FROM g UNION ALL SELECT 'null_date', 'error', count(*) FILTER (game_date IS NULL)::BIGINT FROM g
 UNION ALL SELECT 'high_score', 'warning', count(*) FILTER (home_score > 9)::BIGINT FROM g UNION ALL SELECT 'duplicate_l_orderkey_l_linenumber', 'warning', c::BIGINT FROM l
 UNION ALL SELECT 'orphan_o_custkey', 'error', count(*)::BIGINT FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) SELECT *, actual = 0 AS passed FROM r"""
)
def k1_k12_quality_report(spark, d):
    checks = {"negative_score": (F.count_if((F.col("home_score") < 0) | (F.col("away_score") < 0)), "error"), "null_date": (F.count_if(F.col("game_date").isNull()), "error"), "high_score": (F.count_if(F.col("home_score") > 9), "warning")}
    return quality.report([quality.measure(games(spark, d), checks), quality.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "warning"), quality.orphans(table(spark, d, "orders"), "o_custkey", table(spark, d, "customer"), "c_custkey")])


# --- state: no SQL twin; tests hold them against plain loops ------------------
@register()
def z1_elo_replay(spark, d):
    return elo.replay(leagues(spark, d), pool="league").select("game_pk", r6(F.col("home_elo"), "home_elo"), r6(F.col("away_elo"), "away_elo"), r6(F.col("home_probability"), "home_probability"))


@register()
def z2_elo_grid(spark, d):
    grid = [(f"k{k}-b{b}-r{r}", float(k), float(b), r) for k in (10, 15, 20, 25) for b in (40, 60, 80) for r in (0.25, 0.33, 0.40)]
    return elo.grid(leagues(spark, d), grid, "league").select("config", "n", r6(F.col("accuracy"), "accuracy"), r6(F.col("brier"), "brier"))


def _register_all() -> None:
    from formbook.plans import assembled, features, learned, live, matchups, reports, rows, upkeep  # noqa: F401  they register themselves with this module


def queries() -> dict[str, Query]:
    _register_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _register_all()
    return dict(_SQL)
