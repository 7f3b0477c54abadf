"""Registered queries of scalar features and assembled feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formbook.functions import features as X
from formbook.functions import scalars as S
from formbook.operators import dedup, lineup, reshape
from formbook.operators import windows as win
from formbook.plans.catalog import ALL_T, SEASON_T, G, P, T, games, pitches, r6, register, season_order, table, team_order, team_rows

#: Hitting value of events in thousandths, as the SQL has it.
CASES = "CASE events WHEN 'walk' THEN 690 WHEN 'single' THEN 880 WHEN 'home_run' THEN 2031 ELSE 0 END"
PREV_10, PREV_30 = f"({ALL_T} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)", f"({ALL_T} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"
BEFORE_SEASON = f"({SEASON_T} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"




# --- scalar features over one table of both sides -------------------------------
WIDE = f"""{T}, f AS (SELECT game_pk, game_date, is_home, team_id, coalesce(avg(won) OVER {PREV_10}, 0.5) AS wp10, coalesce(avg(won) OVER {PREV_30}, 0.5) AS wp30, coalesce(avg(won) OVER {BEFORE_SEASON}, 0.5) AS wps, coalesce(avg(won) OVER ({ALL_T} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0.5) AS wp7,
 coalesce(avg(runs) OVER {PREV_10}, 4.5) AS scored, coalesce(avg(runs_allowed) OVER {PREV_10}, 4.5) AS era, coalesce(least(date_diff('day', lag(game_date) OVER ({ALL_T}), game_date), 7), 3) AS rest, count(*) OVER {BEFORE_SEASON} AS played FROM t),
 w AS (SELECT h.game_pk, h.game_date, h.team_id AS home, a.team_id AS away, h.wp10 AS hw10, a.wp10 AS aw10, h.wp30 AS hw30, a.wp30 AS aw30, h.wps AS hws, a.wps AS aws, h.wp7 AS hw7, a.wp7 AS aw7, h.scored AS hs, a.scored AS asc_, h.era AS hera, a.era AS aera, h.rest AS hrest, a.rest AS arest, h.played AS hp, a.played AS ap
 FROM f h JOIN f a ON h.game_pk = a.game_pk AND h.is_home AND NOT a.is_home)"""


def both_sides(spark, d) -> DataFrame:
    """Form of both teams before a game, from one exchange by team and one by game."""
    season = win.before(season_order())
    rows = team_rows(spark, d).withColumns({
        "wp10": win.rolling("won", team_order(), 10, 0.5), "wp30": win.rolling("won", team_order(), 30, 0.5), "wps": F.coalesce(F.avg("won").over(season), F.lit(0.5)), "wp7": win.rolling("won", team_order(), 7, 0.5),
        "scored": win.rolling("runs", team_order(), 10, 4.5), "era": win.rolling("runs_allowed", team_order(), 10, 4.5), "rest": win.rest_days("game_date", team_order()), "played": F.count(F.lit(1)).over(season),
        "ema": F.coalesce(win.ewm("won", team_order()), F.lit(0.5)), "team": F.col("team_id"),
    })
    return reshape.to_game_grain(rows, ["wp10", "wp30", "wps", "wp7", "scored", "era", "rest", "played", "ema", "team"])


def clip_sql(x: str, low: float, high: float) -> str:
    return f"greatest({low}::DOUBLE, least({high}::DOUBLE, {x}))"


@register(
    f"""WITH {WIDE}, x AS (SELECT *, 1500 + 2 * (home % 7) + {clip_sql("(4.5 - hera) * 40", -60, 60)} AS he, 1500 + 2 * (away % 7) + {clip_sql("(4.5 - aera) * 40", -60, 60)} AS ae FROM w)
 SELECT game_pk, round(he, 6) AS home_elo_adj, round(ae, 6) AS away_elo_adj, round(1 / (1 + power(10.0, (ae - he - 70) / 400)), 6) AS probability FROM x"""
)
def n4_pitcher_adjusted_elo(spark, d):
    rated = lambda side: X.adjusted_elo((1500 + 2 * (F.col(f"{side}_team") % 7)).cast("double"), F.col(f"{side}_era"))
    x = both_sides(spark, d).select("game_pk", rated("home").alias("he"), rated("away").alias("ae"))
    return x.select("game_pk", r6(F.col("he"), "home_elo_adj"), r6(F.col("ae"), "away_elo_adj"), r6(X.adjusted_home_probability(F.col("he"), F.col("ae")), "probability"))


_RUN, _ELO = clip_sql("hs - hera - asc_ + aera", -10, 10), clip_sql("(home - away) / 400.0", -0.5, 0.5)
_LATE = "(hp >= 120)::INT"


@register(
    f"""WITH {WIDE} SELECT game_pk, round({clip_sql("hws - 0.5", -0.5, 0.5)} * {clip_sql("hw30 - aw30", -0.5, 0.5)}, 6) + 0.0::DOUBLE AS elo_pythag_alignment, round({_LATE} * {clip_sql("hrest - 3", -5, 5)}, 6) + 0.0::DOUBLE AS home_late_season_streak, round({_LATE} * {clip_sql("arest - 3", -5, 5)}, 6) + 0.0::DOUBLE AS away_late_season_streak,
 round({_LATE} * {clip_sql("hrest - 3", -5, 5)} - {_LATE} * {clip_sql("arest - 3", -5, 5)}, 6) + 0.0::DOUBLE AS late_season_streak_diff, round({clip_sql("(hrest - arest) / 5.0", -1, 1)} * {_ELO}, 6) + 0.0::DOUBLE AS rest_elo_compound,
 round({clip_sql("hw10 - hws", -0.2, 0.2)}, 6) + 0.0::DOUBLE AS home_regression_pending, round({clip_sql("aw10 - aws", -0.2, 0.2)}, 6) + 0.0::DOUBLE AS away_regression_pending, round({clip_sql("aw10 - aws", -0.2, 0.2)} - {clip_sql("hw10 - hws", -0.2, 0.2)}, 6) + 0.0::DOUBLE AS regression_differential,
 round({_RUN} * {_ELO} + {_RUN}, 6) + 0.0::DOUBLE AS run_diff_elo_weighted, round(hw7 - hws, 6) + 0.0::DOUBLE AS home_recent_surge, round(aw7 - aws, 6) + 0.0::DOUBLE AS away_recent_surge, round((hw7 - hws) - (aw7 - aws), 6) + 0.0::DOUBLE AS recent_surge_differential FROM w"""
)
def n5_interactions(spark, d):
    c, b = F.col, both_sides(spark, d)
    made = X.interactions({
        "probability": c("home_wps"), "expectation_diff": c("home_wp30") - c("away_wp30"), "late": (c("home_played") >= 120).cast("int"), "home_streak": (c("home_rest") - 3).cast("double"), "away_streak": (c("away_rest") - 3).cast("double"),
        "rest_balance": (c("home_rest") - c("away_rest")) / 5.0, "elo_diff": c("home_team") - c("away_team"), "home_luck": c("home_wp10") - c("home_wps"), "away_luck": c("away_wp10") - c("away_wps"),
        "run_diff": c("home_scored") - c("home_era") - c("away_scored") + c("away_era"), "home_7": c("home_wp7"), "home_season": c("home_wps"), "away_7": c("away_wp7"), "away_season": c("away_wps"),
    })
    return b.select("game_pk", *[(F.round(v, 6) + 0.0).alias(k) for k, v in made.items()])


@register(
    f"""WITH {P}, s AS (SELECT pitcher, sum((events IN ('strikeout', 'field_out'))::INT) / 3.0::DOUBLE AS ip, sum((events = 'strikeout')::INT) AS k, sum((events = 'walk')::INT) AS bb, count(*) AS bf, avg(release_speed) AS v, sum({CASES}) / (1000.0::DOUBLE * count(*)) AS woba FROM p WHERE inning > 2 GROUP BY 1)
 SELECT pitcher, round(CASE WHEN ip > 0 THEN k / ip * 9 ELSE 8.0 END, 6) AS k9, round(CASE WHEN ip > 0 THEN bb / ip * 9 ELSE 3.0 END, 6) AS bb9, round(CASE WHEN bf > 0 THEN k / bf::DOUBLE ELSE 0.22 END, 6) AS k_pct, round((v - 93) / 3, 6) AS velo_norm, round(2 * (k - bb) / bf::DOUBLE - woba + 0.05 * (v - 93) / 3, 6) AS arsenal FROM s"""
)
def n9_n10_n11_pitcher_rates(spark, d):
    is_ = lambda *e: F.count_if(F.col("events").isin(*e))
    s = pitches(spark, d).where("inning > 2").groupBy("pitcher").agg((is_("strikeout", "field_out") / 3.0).alias("ip"), is_("strikeout").alias("k"), is_("walk").alias("bb"), F.count(F.lit(1)).alias("bf"), F.avg("release_speed").alias("v"), (F.sum(weights()) / (1000.0 * F.count(F.lit(1)))).alias("woba"))
    c = F.col
    return s.select(
        "pitcher", r6(X.per_nine(c("k"), c("ip"), 8.0), "k9"), r6(X.per_nine(c("bb"), c("ip"), 3.0), "bb9"), r6(X.per_batter(c("k"), c("bf"), 0.22), "k_pct"), r6((c("v") - 93.0) / 3.0, "velo_norm"),
        r6(X.arsenal_quality((c("k") - c("bb")) / c("bf"), c("woba"), c("v")), "arsenal"),
    )


def weights():
    return F.expr(CASES).cast("long")


@register(
    f"""WITH {T}, s AS (SELECT team_id, season, avg(runs) AS v FROM t GROUP BY 1, 2), f AS (SELECT game_pk, team_id, season, count(*) OVER {BEFORE_SEASON} AS played FROM t), j AS (SELECT f.*, p.v AS prior, CASE WHEN f.team_id % 5 <> 0 THEN c.v END AS cur FROM f LEFT JOIN s p ON p.team_id = f.team_id AND p.season = f.season - 1 LEFT JOIN s c ON c.team_id = f.team_id AND c.season = f.season)
 SELECT game_pk, team_id, round(coalesce((1 - least(played / 162.0, 1.0)) * prior + least(played / 162.0, 1.0) * cur, cur, prior), 6)::DOUBLE AS quality FROM j"""
)
def n14_season_blend(spark, d):
    s = team_rows(spark, d).groupBy("team_id", "season").agg(F.avg("runs").alias("v"))
    f = team_rows(spark, d).select("game_pk", "team_id", "season", F.count(F.lit(1)).over(win.before(season_order())).alias("played"))
    j = f.join(s.select("team_id", (F.col("season") + 1).alias("season"), F.col("v").alias("prior")), ["team_id", "season"], "left").join(s.where("team_id % 5 != 0").withColumnRenamed("v", "cur"), ["team_id", "season"], "left")
    return j.select("game_pk", "team_id", r6(X.season_blend(F.col("prior"), F.col("cur"), F.col("played")), "quality"))


@register(
    f"""WITH {G}, m AS (SELECT *, CASE home_team_id % 3 WHEN 0 THEN 'East' WHEN 1 THEN 'West' END AS hd0, CASE away_team_id % 3 WHEN 0 THEN 'East' WHEN 1 THEN 'West' END AS ad0 FROM g), n AS (SELECT *, CASE WHEN home_team_id % 2 = 0 THEN 'A' ELSE 'N' END || hd0 AS hd, CASE WHEN away_team_id % 2 = 0 THEN 'A' ELSE 'N' END || ad0 AS ad,
 power(sin(pi() * ((date_diff('day', DATE '2000-01-06', game_date) % 29.53059::DOUBLE + 29.53059::DOUBLE) % 29.53059::DOUBLE) / 29.53059::DOUBLE), 2) AS moon FROM m)
 SELECT game_pk, coalesce((hd = ad)::INT, 0) AS is_divisional, coalesce((hd[1] <> ad[1])::INT, 0) AS is_interleague, round((0.9 + home_team_id / 100.0) * 0.72 * (1 - 0.05 * moon), 6)::DOUBLE AS park_advantage, CASE WHEN home_score >= 5 THEN home_team_id ELSE away_team_id END AS predicted FROM n"""
)
def n17_n21_n23_context(spark, d):
    def division(side: str):
        region = F.when(F.col(side) % 3 == 0, "East").when(F.col(side) % 3 == 1, "West")
        return F.concat(F.when(F.col(side) % 2 == 0, "A").otherwise("N"), region)

    g, hd, ad = games(spark, d), division("home_team_id"), division("away_team_id")
    park = X.park_home_advantage(0.9 + F.col("home_team_id") / 100.0, S.moon_illumination(F.col("game_date")))
    return g.select("game_pk", X.divisional(hd, ad).alias("is_divisional"), X.interleague(hd, ad).alias("is_interleague"), r6(park, "park_advantage"), X.predicted_winner(F.col("home_score"), F.col("home_team_id"), F.col("away_team_id"), 5).alias("predicted"))


@register(
    f"""WITH {P}, z AS (SELECT pitch_id, pitcher % 3 AS team, ts, (ts + (CASE pitcher % 3 WHEN 0 THEN -5 WHEN 1 THEN -7 END) * INTERVAL 1 HOUR) AS home_time FROM p)
 SELECT pitch_id, round(CASE WHEN team = 2 THEN 0.0 ELSE hour(home_time) + minute(home_time) / 60.0 - 18 END, 2)::DOUBLE AS circadian FROM z"""
)
def n19_circadian(spark, d):
    """Hours from the best hour by the team's own clock on the game's date (January: winter time); unknown zones give 0."""
    zone = F.when(F.col("pitcher") % 3 == 0, "America/New_York").when(F.col("pitcher") % 3 == 1, "America/Denver")
    return pitches(spark, d).select("pitch_id", X.circadian_offset(F.col("ts").cast("timestamp"), zone).alias("circadian"))


@register(
    """WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, 60 + l_quantity AS speed, 10 + 1000 * l_discount AS angle, 100 + l_quantity * 5 AS dist FROM lineitem), h AS (SELECT *, greatest(0.5, least(8.0, 2 * speed * sin(radians(angle)) / 32.174)) AS hang FROM x)
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, round(hang, 6) AS hang, round(1 / (1 + exp(-(hang - 2) / 0.5)), 6) AS catch, round(dist * 1.05 / (dist + 1e-5), 6) AS deviation FROM h"""
)
def n27_flight(spark, d):
    x = table(spark, d, "lineitem").withColumns({"speed": 60 + F.col("l_quantity"), "angle": 10 + 1000 * F.col("l_discount"), "dist": 100 + F.col("l_quantity") * 5})
    hang = X.hang_time(F.col("speed"), F.col("angle"))
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", r6(hang, "hang"), r6(X.catch_baseline(hang), "catch"), r6(X.route_deviation(F.col("dist") * 1.05, F.col("dist")), "deviation"))


@register(
    f"""WITH {P}, b AS (SELECT batter, count(*) AS pa, count(*) FILTER (events IN ('single', 'home_run')) AS hits, count(*) FILTER (events = 'home_run') AS hr, round(sum({CASES}) / (1000.0::DOUBLE * count(*)), 3) AS woba FROM p WHERE batter IS NOT NULL GROUP BY 1),
 f AS (SELECT batter, list_filter([CASE WHEN woba >= 0.85 AND pa >= 10 THEN 'mashing ' || pa END, CASE WHEN hr >= 25 THEN hr || ' home runs' END, CASE WHEN woba <= 0.6 AND pa >= 15 THEN 'struggles ' || pa END, CASE WHEN hits >= 30 THEN hits || ' hits' END], lambda x: x IS NOT NULL)[1:3] AS facts FROM b)
 SELECT batter, array_to_string(facts, '; ') AS facts FROM f"""
)
def n25_n26_facts(spark, d):
    """Ordered rules, the first three that hold."""
    b = pitches(spark, d).where("batter IS NOT NULL").groupBy("batter").agg(F.count(F.lit(1)).alias("pa"), F.count_if(F.col("events").isin("single", "home_run")).alias("hits"), F.count_if(F.col("events") == "home_run").alias("hr"), F.round(F.sum(weights()) / (1000.0 * F.count(F.lit(1))), 3).alias("woba"))
    c = F.col
    rules = [((c("woba") >= 0.85) & (c("pa") >= 10), F.concat(F.lit("mashing "), "pa")), (c("hr") >= 25, F.concat("hr", F.lit(" home runs"))), ((c("woba") <= 0.6) & (c("pa") >= 15), F.concat(F.lit("struggles "), "pa")), (c("hits") >= 30, F.concat("hits", F.lit(" hits")))]
    return b.select("batter", F.array_join(X.first_facts(rules, 3), "; ").alias("facts"))


@register("SELECT s_suppkey, split_part(s_name, '#', 1) || ' of ' || n_name AS full_name, list_extract(string_split_regex(trim(split_part(s_name, '#', 1) || ' of ' || n_name), '\\s+'), -1) AS last FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def n24_last_word(spark, d):
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    name = F.concat(F.split_part("s_name", F.lit("#"), F.lit(1)), F.lit(" of "), "n_name")
    return s.select("s_suppkey", name.alias("full_name"), X.last_word(name).alias("last"))


@register("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, round(coalesce(nullif(l_discount, 0), 0.5), 2) AS filled, round_even(l_quantity / 4, 0) AS half_even, round(l_quantity / 4, 0) AS half_up FROM lineitem")
def n28_nulls_and_rounding(spark, d):
    x = table(spark, d, "lineitem")
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.round(F.coalesce(F.nullif(F.col("l_discount"), F.lit(0.0)), F.lit(0.5)), 2).alias("filled"), F.bround(F.col("l_quantity") / 4, 0).alias("half_even"), F.round(F.col("l_quantity") / 4, 0).alias("half_up"))


# --- assembled tables -------------------------------------------------------------
E = f"""i AS (SELECT *, row_number() OVER ({ALL_T}) AS no FROM t), ema AS (SELECT x.game_pk, x.team_id, coalesce(sum(y.won * power(9.0 / 11.0, x.no - y.no - 1)) / sum(power(9.0 / 11.0, x.no - y.no - 1)), 0.5) AS e FROM i x LEFT JOIN i y ON x.team_id = y.team_id AND y.no BETWEEN x.no - 30 AND x.no - 1 GROUP BY 1, 2)"""


@register(
    f"""WITH {WIDE}, {E}, y AS (SELECT w.*, h.e AS he, a.e AS ae, 1 - least(hera, 10) / 10.0 AS hq, 1 - least(aera, 10) / 10.0 AS aq, CASE WHEN hrest = 1 THEN 1 ELSE 0 END AS b2b FROM w JOIN ema h ON h.game_pk = w.game_pk AND h.team_id = home JOIN ema a ON a.game_pk = w.game_pk AND a.team_id = away)
 SELECT y.game_pk, y.game_date, g.home_team_id, g.away_team_id, g.home_score, g.away_score, (g.home_score > g.away_score)::INT AS home_won, round(hw10, 4) AS home_win_pct_10d, round(aw10, 4) AS away_win_pct_10d, round(hw30, 4) AS home_win_pct_30d, round(aw30, 4) AS away_win_pct_30d, round(he, 4) AS home_ema_form, round(ae, 4) AS away_ema_form,
 round(hq, 4) AS home_pitcher_quality, round(aq, 4) AS away_pitcher_quality, hrest::BIGINT AS home_days_rest, arest::BIGINT AS away_days_rest, (hrest - arest)::BIGINT AS home_rest_advantage, b2b AS is_back_to_back, month(y.game_date)::INT AS month, (isodow(y.game_date) - 1)::INT AS day_of_week, (month(y.game_date) <= 4)::INT AS is_early_season, (month(y.game_date) >= 9)::INT AS is_late_season,
 (home % 6 = away % 6)::INT AS is_divisional_matchup, round(he * he, 4) AS home_form_squared, round(ae * ae, 4) AS away_form_squared, round((hrest - arest) / 5.0, 4)::DOUBLE AS rest_balance, round(hw10 - he, 4) + 0.0::DOUBLE AS home_momentum, round(aw10 - ae, 4) + 0.0::DOUBLE AS away_momentum, round(hq - aq, 4) + 0.0::DOUBLE AS pitcher_quality_diff, b2b * 2 AS fatigue_index, round(hw30 - aw30, 4) + 0.0::DOUBLE AS win_pct_diff,
 round(hw10 * aw10, 6) AS form_interaction, round(hw10 - aw10, 6) + 0.0::DOUBLE AS form_difference FROM y JOIN g USING (game_pk)"""
)
def m2_n6_n7_season_table(spark, d):
    """The season's feature row of every game: form, rest, calendar, and products of them."""
    return season_table(both_sides(spark, d), games(spark, d))


def season_table(sides: DataFrame, g: DataFrame) -> DataFrame:
    c, r4 = F.col, lambda x, n: (F.round(x, 4) + 0.0).alias(n)
    quality = {s: 1 - F.least(c(f"{s}_era"), F.lit(10.0)) / 10.0 for s in ("home", "away")}
    b2b = (c("home_rest") == 1).cast("int")
    met = sides.drop("game_date", "season").join(g.select("game_pk", "game_date", "home_team_id", "away_team_id", "home_score", "away_score"), "game_pk")
    return met.select(
        "game_pk", "game_date", "home_team_id", "away_team_id", "home_score", "away_score", (c("home_score") > c("away_score")).cast("int").alias("home_won"),
        *[r4(c(f"{s}_{k}"), f"{s}_{n}") for k, n in (("wp10", "win_pct_10d"), ("wp30", "win_pct_30d"), ("ema", "ema_form")) for s in ("home", "away")], *[r4(q, f"{s}_pitcher_quality") for s, q in quality.items()],
        *[c(f"{s}_rest").cast("long").alias(f"{s}_days_rest") for s in ("home", "away")], (c("home_rest") - c("away_rest")).cast("long").alias("home_rest_advantage"), b2b.alias("is_back_to_back"),
        F.month("game_date").alias("month"), F.weekday("game_date").alias("day_of_week"), (F.month("game_date") <= 4).cast("int").alias("is_early_season"), (F.month("game_date") >= 9).cast("int").alias("is_late_season"),
        (c("home_team") % 6 == c("away_team") % 6).cast("int").alias("is_divisional_matchup"), *[r4(c(f"{s}_ema") * c(f"{s}_ema"), f"{s}_form_squared") for s in ("home", "away")], r4((c("home_rest") - c("away_rest")) / 5.0, "rest_balance"),
        *[r4(c(f"{s}_wp10") - c(f"{s}_ema"), f"{s}_momentum") for s in ("home", "away")], r4(quality["home"] - quality["away"], "pitcher_quality_diff"), (b2b * 2).alias("fatigue_index"), r4(c("home_wp30") - c("away_wp30"), "win_pct_diff"),
        r6(c("home_wp10") * c("away_wp10"), "form_interaction"), (F.round(c("home_wp10") - c("away_wp10"), 6) + 0.0).alias("form_difference"),
    )


@register(
    f"""WITH {WIDE}, {E} SELECT w.game_pk, round(0.4 * hw10 + 0.3 * h.e + 0.2 * (1 - least(hera, 10) / 10.0) + 0.1 * hw30, 4) AS home_strength, round(0.4 * aw10 + 0.3 * a.e + 0.2 * (1 - least(aera, 10) / 10.0) + 0.1 * aw30, 4) AS away_strength
 FROM w JOIN ema h ON h.game_pk = w.game_pk AND h.team_id = home JOIN ema a ON a.game_pk = w.game_pk AND a.team_id = away WHERE game_date >= DATE '1998-05-01' AND game_date <= DATE '1998-05-07'"""
)
def m33_weekly_prediction(spark, d):
    """The Friday after a day and the six days that follow: one strength for each side of every game in that week."""
    day = F.next_day(F.lit("1998-04-30").cast("date"), "FRI")
    week = both_sides(spark, d).where((F.col("game_date") >= day) & (F.col("game_date") <= F.date_add(day, 6)))
    side = lambda s: F.round(X.strength(F.col(f"{s}_wp10"), F.col(f"{s}_ema"), 1 - F.least(F.col(f"{s}_era"), F.lit(10.0)) / 10.0, F.col(f"{s}_wp30")), 4).alias(f"{s}_strength")
    return week.select("game_pk", side("home"), side("away"))


SPLITS = f"""{P}, day AS (SELECT batter, pitcher, p_throws, game_date, count(*) AS pa, sum({CASES}) AS num FROM p WHERE batter IS NOT NULL GROUP BY 1, 2, 3, 4), hand AS (SELECT batter, p_throws, game_date, sum(pa) AS pa, sum(num) AS num FROM day GROUP BY 1, 2, 3),
 hand_b AS (SELECT batter, p_throws, game_date, sum(pa) OVER w AS pa, sum(num) OVER w AS num FROM hand WINDOW w AS (PARTITION BY batter, p_throws ORDER BY game_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 pair AS (SELECT batter, pitcher, game_date, sum(pa) AS pa, sum(num) AS num FROM day GROUP BY 1, 2, 3), pair_b AS (SELECT batter, pitcher, game_date, sum(pa) OVER w AS pa, sum(num) OVER w AS num FROM pair WINDOW w AS (PARTITION BY batter, pitcher ORDER BY game_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def _before(rows: DataFrame, by: list[str]) -> DataFrame:
    """Sums of earlier days of each key."""
    w = win.before(W.partitionBy(*by).orderBy("game_date"))
    return rows.groupBy(*by, "game_date").agg(F.sum("pa").alias("pa"), F.sum("num").alias("num")).select(*by, "game_date", F.sum("pa").over(w).alias("pa"), F.sum("num").over(w).alias("num"))


@register(
    f"""WITH {SPLITS}, st AS (SELECT game_date, game_pk, inning_topbot, pitcher, max(p_throws) AS p_throws FROM p WHERE inning <= 3 GROUP BY 1, 2, 3, 4 QUALIFY row_number() OVER (PARTITION BY game_date, game_pk, inning_topbot ORDER BY count(*) DESC, pitcher) = 1),
 lu AS (SELECT game_date, game_pk, inning_topbot, batter, row_number() OVER (PARTITION BY game_date, game_pk, inning_topbot ORDER BY min(pitch_id), batter) AS slot FROM p WHERE batter IS NOT NULL GROUP BY 1, 2, 3, 4 QUALIFY slot <= 9),
 m AS (SELECT lu.*, st.pitcher, st.p_throws, h.pa AS hpa, h.num AS hnum, b.pa AS bpa, b.num AS bnum FROM lu JOIN st USING (game_date, game_pk, inning_topbot) LEFT JOIN hand_b h ON h.batter = lu.batter AND h.p_throws = st.p_throws AND h.game_date = lu.game_date LEFT JOIN pair_b b ON b.batter = lu.batter AND b.pitcher = st.pitcher AND b.game_date = lu.game_date),
 s AS (SELECT game_date, game_pk, inning_topbot, sum(hnum) FILTER (hpa >= 5) / (1000.0::DOUBLE * nullif(sum(hpa) FILTER (hpa >= 5), 0)) AS lineup, sum(bnum) / (1000.0::DOUBLE * nullif(sum(bpa), 0)) AS h2h, sum(hnum) FILTER (slot <= 3) / (1000.0::DOUBLE * nullif(sum(hpa) FILTER (slot <= 3), 0)) AS top3 FROM m GROUP BY 1, 2, 3),
 j AS (SELECT a.game_date, a.game_pk, h.lineup AS hl, h.h2h AS hh, h.top3 AS ht, a.lineup AS al, a.h2h AS ah, a.top3 AS at_ FROM (SELECT * FROM s WHERE inning_topbot = 'Top') a JOIN (SELECT * FROM s WHERE inning_topbot = 'Bot') h USING (game_date, game_pk))
 SELECT game_date, game_pk, round(hl, 6) AS home_lineup_woba, round(al, 6) AS away_lineup_woba, round(hh, 6) AS home_h2h_woba, round(ah, 6) AS away_h2h_woba, round(ht, 6) AS home_top3_woba, round(at_, 6) AS away_top3_woba,
 round({clip_sql("(3 * coalesce(hl, 0.32) + 2 * coalesce(hh, hl, 0.32) + 1.5 * coalesce(ht, hl, 0.32) - 3 * coalesce(al, 0.32) - 2 * coalesce(ah, al, 0.32) - 1.5 * coalesce(at_, al, 0.32)) / 15.0 / 0.15", -1, 1)}, 5) + 0.0::DOUBLE AS matchup_advantage_home FROM j"""
)
def m4_m5_n13_matchup_table(spark, d):
    """Starters, lineups in order of first appearance, splits of earlier days against the opposing starter's hand and himself, both sides in one row.

    One aggregate by (batter, pitcher, hand, day) feeds both splits; batters of the top half face the home side's starter.
    """
    p, c = pitches(spark, d), F.col
    game = ["game_date", "game_pk", "inning_topbot"]
    day = p.where("batter IS NOT NULL").groupBy("batter", "pitcher", "p_throws", "game_date").agg(F.count(F.lit(1)).alias("pa"), F.sum(weights()).alias("num"))
    starters = dedup.latest_per_key(p.where("inning <= 3").groupBy(*game, "pitcher").agg(F.count(F.lit(1)).alias("n"), F.max("p_throws").alias("p_throws")), game, [F.desc("n"), F.asc("pitcher")]).drop("n")
    seen = p.where("batter IS NOT NULL").groupBy(*game, "batter").agg(F.min("pitch_id").alias("first_at"))
    batters = dedup.top_k(seen, game, [F.asc("first_at"), F.asc("batter")], 9, "slot").drop("first_at")
    hand = _before(day, ["batter", "p_throws"]).withColumnsRenamed({"pa": "hpa", "num": "hnum"})
    pair = _before(day, ["batter", "pitcher"]).withColumnsRenamed({"pa": "bpa", "num": "bnum"})
    m = batters.join(starters, game).join(hand, ["batter", "p_throws", "game_date"], "left").join(pair, ["batter", "pitcher", "game_date"], "left")
    rate = lambda num, pa, ok: F.sum(F.when(ok, c(num))) / (1000.0 * F.nullif(F.sum(F.when(ok, c(pa))), F.lit(0)))
    s = m.groupBy(*game).agg(rate("hnum", "hpa", c("hpa") >= 5).alias("lineup"), rate("bnum", "bpa", F.lit(True)).alias("h2h"), rate("hnum", "hpa", c("slot") <= 3).alias("top3"))
    pick = lambda half, col: F.max(F.when(c("inning_topbot") == half, c(col)))
    sides = {"home": "Bot", "away": "Top"}
    wide = s.groupBy("game_date", "game_pk").agg(F.count_distinct("inning_topbot").alias("halves"), *[pick(h, k).alias(f"{side}_{k}") for side, h in sides.items() for k in ("lineup", "h2h", "top3")]).where("halves = 2")
    two = lambda k: (c(f"home_{k}"), c(f"away_{k}"))
    none = F.lit(None).cast("double")
    advantage = X.simple_matchup(two("lineup"), two("h2h"), two("top3"), (none, none))
    return wide.select("game_date", "game_pk", *[r6(c(f"{side}_{k}"), f"{side}_{k}_woba") for k in ("lineup", "h2h", "top3") for side in sides], (F.round(advantage, 5) + 0.0).alias("matchup_advantage_home"))


@register(
    f"""WITH {P}, v AS (SELECT pitcher, game_date, sum(release_speed) AS s, count(*) AS n, sum((events = 'strikeout')::INT) AS k, sum((events = 'walk')::INT) AS bb, sum({CASES}) AS num FROM p GROUP BY 1, 2), b AS (SELECT pitcher, game_date, sum(s) OVER w / sum(n) OVER w AS velo, (sum(k) OVER w - sum(bb) OVER w) / (sum(n) OVER w)::DOUBLE AS kbb, sum(num) OVER w / (1000.0::DOUBLE * sum(n) OVER w) AS xwoba FROM v WINDOW w AS (PARTITION BY pitcher ORDER BY game_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 ve AS (SELECT batter, game_pk % 30 AS venue, game_date, sum({CASES}) AS num, count(*) AS n FROM p WHERE batter IS NOT NULL GROUP BY 1, 2, 3), vb AS (SELECT batter, venue, game_date, sum(n) OVER w AS pa, sum(num) OVER w AS num FROM ve WINDOW w AS (PARTITION BY batter, venue ORDER BY game_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 st AS (SELECT game_date, game_pk, inning_topbot, pitcher FROM p WHERE inning <= 3 GROUP BY 1, 2, 3, 4 QUALIFY row_number() OVER (PARTITION BY game_date, game_pk, inning_topbot ORDER BY count(*) DESC, pitcher) = 1), q AS (SELECT st.*, velo, 2 * coalesce(kbb, 0.1) - coalesce(xwoba, 0.32) + 0.05 * (coalesce(velo, 93.0) - 93) / 3 AS quality FROM st LEFT JOIN b USING (pitcher, game_date)),
 lv AS (SELECT x.game_date, x.game_pk, sum(vb.num) / (1000.0::DOUBLE * nullif(sum(vb.pa), 0)) AS venue_woba FROM (SELECT DISTINCT game_date, game_pk, batter FROM p WHERE batter IS NOT NULL) x LEFT JOIN vb ON vb.batter = x.batter AND vb.venue = x.game_pk % 30 AND vb.game_date = x.game_date GROUP BY 1, 2)
 SELECT game_date, game_pk, max(pitcher) FILTER (inning_topbot = 'Top') AS home_starter, max(pitcher) FILTER (inning_topbot = 'Bot') AS away_starter, round(max(quality) FILTER (inning_topbot = 'Top') - max(quality) FILTER (inning_topbot = 'Bot'), 6) AS arsenal_advantage, round(max(venue_woba), 6) AS venue_woba FROM q LEFT JOIN lv USING (game_date, game_pk) GROUP BY 1, 2"""
)
def m6_arsenal_and_venue(spark, d):
    """Starters' arsenal over their earlier days, and how the game's batters hit at its venue before."""
    p, c = pitches(spark, d), F.col
    before = win.before(W.partitionBy("pitcher").orderBy("game_date"))
    v = p.groupBy("pitcher", "game_date").agg(F.sum("release_speed").alias("s"), F.count(F.lit(1)).alias("n"), F.count_if(c("events") == "strikeout").alias("k"), F.count_if(c("events") == "walk").alias("bb"), F.sum(weights()).alias("num"))
    total = lambda x: F.sum(x).over(before)
    b = v.select("pitcher", "game_date", (total("s") / total("n")).alias("velo"), ((total("k") - total("bb")) / total("n")).alias("kbb"), (total("num") / (1000.0 * total("n"))).alias("xwoba"))
    game = ["game_date", "game_pk", "inning_topbot"]
    starters = dedup.latest_per_key(p.where("inning <= 3").groupBy(*game, "pitcher").agg(F.count(F.lit(1)).alias("n")), game, [F.desc("n"), F.asc("pitcher")]).drop("n")
    quality = X.arsenal_quality(F.coalesce("kbb", F.lit(0.1)), F.coalesce("xwoba", F.lit(0.32)), F.coalesce("velo", F.lit(93.0)))
    q = starters.join(b, ["pitcher", "game_date"], "left").withColumn("quality", quality)
    at = p.where("batter IS NOT NULL").withColumn("venue", c("game_pk") % 30)
    hit = _before(at.groupBy("batter", "venue", "game_date").agg(F.count(F.lit(1)).alias("pa"), F.sum(weights()).alias("num")), ["batter", "venue"])
    venue = at.select("game_date", "game_pk", "batter", "venue").distinct().join(hit, ["batter", "venue", "game_date"], "left").groupBy("game_date", "game_pk").agg((F.sum("num") / (1000.0 * F.nullif(F.sum("pa"), F.lit(0)))).alias("venue_woba"))
    of = lambda half, col: F.max(F.when(c("inning_topbot") == half, c(col)))
    wide = q.groupBy("game_date", "game_pk").agg(of("Top", "pitcher").alias("home_starter"), of("Bot", "pitcher").alias("away_starter"), (of("Top", "quality") - of("Bot", "quality")).alias("adv"))
    return wide.join(venue, ["game_date", "game_pk"], "left").select("game_date", "game_pk", "home_starter", "away_starter", r6(c("adv"), "arsenal_advantage"), r6(c("venue_woba"), "venue_woba"))


#: Runs at a venue against those of all, over the seasons before; null under a hundred games.
PARK = """ps AS (SELECT venue_id, season, sum(home_score + away_score) AS runs, count(*) AS n FROM g GROUP BY 1, 2), os AS (SELECT season, sum(runs) AS runs, sum(n) AS n FROM ps GROUP BY 1),
 pb AS (SELECT venue_id, season, sum(runs) OVER w AS runs, sum(n) OVER w AS n FROM ps WINDOW w AS (PARTITION BY venue_id ORDER BY season ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), ob AS (SELECT season, sum(runs) OVER w AS runs, sum(n) OVER w AS n FROM os WINDOW w AS (ORDER BY season ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 park AS (SELECT venue_id, season, CASE WHEN pb.n >= 100 THEN (pb.runs / pb.n::DOUBLE) / (ob.runs / ob.n::DOUBLE) END AS ratio FROM pb JOIN ob USING (season))"""


def park_before(g: DataFrame, least: int = 100) -> DataFrame:
    """(venue_id, season, ratio): runs at a venue against those of all, over earlier seasons; null under ``least`` games."""
    at = g.groupBy("venue_id", "season").agg(F.sum(F.col("home_score") + F.col("away_score")).alias("runs"), F.count(F.lit(1)).alias("n"))
    all_before = win.before(W.orderBy("season"))  # one row for each season
    overall = at.groupBy("season").agg(F.sum("runs").alias("r"), F.sum("n").alias("k")).select("season", (F.sum("r").over(all_before) / F.sum("k").over(all_before)).alias("mean"))
    own = win.before(W.partitionBy("venue_id").orderBy("season"))
    seen = at.select("venue_id", "season", F.sum("runs").over(own).alias("runs"), F.sum("n").over(own).alias("n"))
    return seen.join(overall, "season").select("venue_id", "season", F.when(F.col("n") >= least, F.col("runs") / F.col("n") / F.col("mean")).alias("ratio"))


@register(
    f"""WITH {WIDE}, {E}, s AS (SELECT team_id, season, avg(runs) AS v FROM t GROUP BY 1, 2), cur AS (SELECT game_pk, team_id, avg(runs) OVER {BEFORE_SEASON} AS v FROM t), {PARK},
 trip AS (SELECT game_pk, team_id, (row_number() OVER ({ALL_T}) - 1 - coalesce(max(CASE WHEN is_home THEN rn END) OVER ({ALL_T} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS road FROM (SELECT *, row_number() OVER ({ALL_T}) AS rn FROM t)),
 x AS (SELECT w.*, g.season, g.venue_id, 1 - least(hp / 162.0, 1.0) AS hk, 1 - least(ap / 162.0, 1.0) AS ak FROM w JOIN g USING (game_pk))
 SELECT x.game_pk, round(coalesce(hk * h1.v + (1 - hk) * h0.v, h0.v, h1.v), 6)::DOUBLE AS home_quality, round(coalesce(ak * a1.v + (1 - ak) * a0.v, a0.v, a1.v), 6)::DOUBLE AS away_quality, round(coalesce(ratio, 1.0), 6) AS home_park_factor, (coalesce(ratio, 1.0) > 1.05)::INT AS is_hitter_park, (coalesce(ratio, 1.0) < 0.95)::INT AS is_pitcher_park,
 round(hw10 - aw10, 6) + 0.0::DOUBLE AS form_differential, hrest::BIGINT AS home_days_rest, arest::BIGINT AS away_days_rest, (hrest >= 2)::INT AS home_rested, (arest <= 1)::INT AS away_tired, road::BIGINT AS away_road_trip_length, (road >= 5)::INT AS long_road_trip, month(x.game_date)::INT AS month, (isodow(x.game_date) >= 5)::INT AS is_weekend, round((hp + ap) / 2.0 / 162.0, 6)::DOUBLE AS season_pct_complete, ((hp + ap) / 2.0 / 162.0 >= 0.75)::INT AS is_late_season, ((hp + ap) / 2.0 / 162.0 <= 0.20)::INT AS is_early_season
 FROM x LEFT JOIN s h1 ON h1.team_id = home AND h1.season = x.season - 1 LEFT JOIN cur h0 ON h0.team_id = home AND h0.game_pk = x.game_pk LEFT JOIN s a1 ON a1.team_id = away AND a1.season = x.season - 1 LEFT JOIN cur a0 ON a0.team_id = away AND a0.game_pk = x.game_pk LEFT JOIN park ON park.venue_id = x.venue_id AND park.season = x.season LEFT JOIN trip ON trip.game_pk = x.game_pk AND trip.team_id = away"""
)
def m9_m10_full_table(spark, d):
    """Form, blended quality, park, rest, travel and season context of every game, of earlier games alone; lookups are left joins, so every game stays."""
    c, g, rows = F.col, games(spark, d), team_rows(spark, d)
    cur = rows.select("game_pk", "team_id", F.avg("runs").over(win.before(season_order())).alias("v"))
    s = rows.groupBy("team_id", (c("season") + 1).alias("season")).agg(F.avg("runs").alias("v"))
    trips = win.run_before(rows.withColumn("away", (~c("is_home")).cast("int")), "away", ["team_id"], ["game_date", "game_pk"], "road").where("away = 1").select("game_pk", c("road").cast("long").alias("road"))
    x = both_sides(spark, d).join(g.select("game_pk", "venue_id"), "game_pk").join(park_before(g), ["venue_id", "season"], "left").join(trips, "game_pk", "left").withColumn("ratio", F.coalesce("ratio", F.lit(1.0)))
    for side in ("home", "away"):
        this = cur.select("game_pk", c("team_id").alias(f"{side}_team"), c("v").alias(f"{side}_cur"))
        last = s.select(c("team_id").alias(f"{side}_team"), "season", c("v").alias(f"{side}_prior"))
        x = x.join(this, ["game_pk", f"{side}_team"], "left").join(last, [f"{side}_team", "season"], "left")
    done = (c("home_played") + c("away_played")) / 2.0 / 162.0
    blend = lambda side: r6(X.season_blend(c(f"{side}_prior"), c(f"{side}_cur"), c(f"{side}_played")), f"{side}_quality")
    flag = lambda cond, name: cond.cast("int").alias(name)
    return x.select(
        "game_pk", blend("home"), blend("away"), r6(c("ratio"), "home_park_factor"), flag(c("ratio") > 1.05, "is_hitter_park"), flag(c("ratio") < 0.95, "is_pitcher_park"), (F.round(c("home_wp10") - c("away_wp10"), 6) + 0.0).alias("form_differential"),
        c("home_rest").cast("long").alias("home_days_rest"), c("away_rest").cast("long").alias("away_days_rest"), flag(c("home_rest") >= 2, "home_rested"), flag(c("away_rest") <= 1, "away_tired"), c("road").alias("away_road_trip_length"), flag(c("road") >= 5, "long_road_trip"),
        F.month("game_date").alias("month"), flag(F.weekday("game_date") >= 4, "is_weekend"), r6(done, "season_pct_complete"), flag(done >= 0.75, "is_late_season"), flag(done <= 0.20, "is_early_season"),
    )


#: What relievers (innings after the first) threw, as in the load of a week.
USE = f"""{P}, u AS (SELECT pitcher % 10 AS team_id, pitcher, game_date, game_pk, count(*) AS n FROM p WHERE inning > 1 GROUP BY 1, 2, 3, 4), dy AS (SELECT team_id, game_date, sum(n) AS n FROM u GROUP BY 1, 2),
 wk AS (SELECT team_id, game_date, coalesce(sum(n) OVER (PARTITION BY team_id ORDER BY game_date RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING), 0) AS pitches_7 FROM dy)"""


@register(
    f"""WITH {USE}, gm AS (SELECT DISTINCT game_date, game_pk, game_pk % 10 AS home, (game_pk + 1) % 10 AS away FROM p)
 SELECT gm.game_date, game_pk, h.pitches_7::BIGINT AS home_pitches_7, a.pitches_7::BIGINT AS away_pitches_7, (a.pitches_7 - h.pitches_7)::BIGINT AS bullpen_differential, round(power(sin(pi() * ((date_diff('day', DATE '2000-01-06', gm.game_date) % 29.53059::DOUBLE + 29.53059::DOUBLE) % 29.53059::DOUBLE) / 29.53059::DOUBLE), 2), 6) AS moon
 FROM gm LEFT JOIN wk h ON h.team_id = home AND h.game_date = gm.game_date LEFT JOIN wk a ON a.team_id = away AND a.game_date = gm.game_date"""
)
def m7_bullpen_and_sky(spark, d):
    """Load of both bullpens in the week before a game (away minus home, as the tables have it) and the moon of its night."""
    p, c = pitches(spark, d), F.col
    use = p.where("inning > 1").groupBy((c("pitcher") % 10).alias("team_id"), "pitcher", "game_date", "game_pk").agg(F.count(F.lit(1)).alias("n")).withColumn("ip", c("n") / 4.0)
    week = lineup.week_load(use).select("team_id", "game_date", "pitches_7")
    gm = p.select("game_date", "game_pk").distinct().withColumns({"home": c("game_pk") % 10, "away": (c("game_pk") + 1) % 10})
    role = lambda side: week.select(c("team_id").alias(side), "game_date", c("pitches_7").cast("long").alias(f"{side}_pitches_7"))
    met = gm.join(role("home"), ["home", "game_date"], "left").join(role("away"), ["away", "game_date"], "left")
    return met.select("game_date", "game_pk", "home_pitches_7", "away_pitches_7", (c("away_pitches_7") - c("home_pitches_7")).alias("bullpen_differential"), r6(S.moon_illumination(c("game_date")), "moon"))


@register(
    f"""WITH {P}, q AS (SELECT p_brand AS k, percent_rank() OVER (ORDER BY avg(p_retailprice)) * 100 AS pct FROM part GROUP BY 1), r AS (SELECT row_number() OVER (ORDER BY k) - 1 AS pitcher, pct FROM q), st AS (SELECT DISTINCT game_pk, min(pitcher) AS hp, max(pitcher) AS ap FROM p GROUP BY 1)
 SELECT game_pk, round(0.35 * (coalesce(h.pct, 50) - coalesce(a.pct, 50)) + 0.25 * (coalesce(h.pct, 50) - 50) - 0.20 * (coalesce(a.pct, 50) - 50), 6) + 0.0::DOUBLE AS sp_quality_composite_diff, (h.pct IS NOT NULL)::INT AS home_sp_known, (a.pct IS NOT NULL)::INT AS away_sp_known FROM st LEFT JOIN r h ON h.pitcher = hp LEFT JOIN r a ON a.pitcher = ap"""
)
def n16_starter_composite(spark, d):
    """Percentiles of known starters (a table of brands stands for it), 50 for the others; unknown metrics are 50 as well."""
    brands = table(spark, d, "part").groupBy("p_brand").agg(F.avg("p_retailprice").alias("v"))  # one row for each brand
    r = brands.select((F.row_number().over(W.orderBy("p_brand")) - 1).cast("long").alias("pitcher"), (F.percent_rank().over(W.orderBy("v")) * 100).alias("pct"))
    st = pitches(spark, d).groupBy("game_pk").agg(F.min("pitcher").alias("hp"), F.max("pitcher").alias("ap"))
    x = st.join(r.select(F.col("pitcher").alias("hp"), F.col("pct").alias("h")), "hp", "left").join(r.select(F.col("pitcher").alias("ap"), F.col("pct").alias("a")), "ap", "left")
    none = F.lit(None).cast("double")
    own = {"xera": F.col("h"), "k_pct": F.col("h"), "bb_pct": none, "whiff": none, "fbv": none}
    other = {"xera": F.col("a"), "k_pct": none, "bb_pct": F.col("a"), "whiff": none, "fbv": none}
    return x.select("game_pk", (F.round(X.starter_composite(own, other), 6) + 0.0).alias("sp_quality_composite_diff"), F.col("h").isNotNull().cast("int").alias("home_sp_known"), F.col("a").isNotNull().cast("int").alias("away_sp_known"))


@register(
    f"""WITH {T}, f AS (SELECT game_pk, is_home, team_id, opponent_id, won, avg(won) OVER {PREV_10} AS rate_10, avg(runs) OVER {PREV_10} AS runs_10, sum(won) OVER {BEFORE_SEASON} AS season_wins FROM t)
 SELECT h.game_pk, hn.n_name AS home_name, an.n_name AS away_name, round(h.rate_10, 6) AS home_rate, round(a.rate_10, 6) AS away_rate, round(h.runs_10, 6) AS home_runs, round(a.runs_10, 6) AS away_runs, coalesce(h.season_wins, 0)::BIGINT AS home_wins, coalesce(a.season_wins, 0)::BIGINT AS away_wins, h.won AS label FROM f h JOIN f a ON h.game_pk = a.game_pk AND h.is_home AND NOT a.is_home
 LEFT JOIN nation hn ON hn.n_nationkey = h.team_id LEFT JOIN nation an ON an.n_nationkey = a.team_id"""
)
def m35_denormalised_training(spark, d):
    """One row a game with names of both sides and frames that stop before the game."""
    rows = team_rows(spark, d).withColumns({"rate": F.avg("won").over(win.before(team_order(), 10)), "avg_runs": F.avg("runs").over(win.before(team_order(), 10)), "wins": F.coalesce(F.sum("won").over(win.before(season_order())), F.lit(0)), "team": F.col("team_id")})
    wide = reshape.to_game_grain(rows, ["rate", "avg_runs", "wins", "team", "won"])
    names = lambda s: table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias(f"{s}_team"), F.col("n_name").alias(f"{s}_name"))
    wide = wide.join(names("home"), "home_team", "left").join(names("away"), "away_team", "left")
    c = F.col
    return wide.select("game_pk", "home_name", "away_name", *[r6(c(f"{s}_{k}"), f"{s}_{n}") for k, n in (("rate", "rate"), ("avg_runs", "runs")) for s in ("home", "away")], *[c(f"{s}_wins").cast("long").alias(f"{s}_wins") for s in ("home", "away")], c("home_won").alias("label"))
