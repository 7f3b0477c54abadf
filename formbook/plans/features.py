"""Registered queries of entity loads, recent form, splits of the time line and assembled feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formbook.functions import scalars as S
from formbook.operators import dedup, elo, lineup, ranks, reports, reshape, splits
from formbook.operators import windows as win
from formbook.plans.catalog import ALL_T, G, P, T, r6, register, season_order, team_order, team_rows, weight
from formbook.sources.tables import games, leagues, pitches, predictions

CASES = "CASE events WHEN 'walk' THEN 690 WHEN 'single' THEN 880 WHEN 'home_run' THEN 2031 ELSE 0 END"
RATED = "row_number() OVER (PARTITION BY team_id, season ORDER BY game_date, game_pk)"


@register(f"WITH {P} SELECT batter, sum({CASES})::BIGINT AS numerator, count(*)::BIGINT AS pa FROM p GROUP BY 1")
def a2_event_weights(spark: SparkSession, d: str) -> DataFrame:
    return pitches(spark, d).groupBy("batter").agg(F.sum(weight()).alias("numerator"), F.count(F.lit(1)).alias("pa"))


@register(
    f"""WITH {P}, s AS (SELECT *, 1 + batter % 9 AS slot FROM p) SELECT game_pk, round(avg(release_speed) FILTER (slot BETWEEN 1 AND 3), 6) AS top, round(avg(release_speed) FILTER (slot BETWEEN 4 AND 7), 6) AS middle,
 round(avg(release_speed) FILTER (slot >= 8), 6) AS bottom FROM s GROUP BY 1"""
)
def a6_position_groups(spark, d):
    slot = 1 + F.col("batter") % 9
    groups = {"top": slot.between(1, 3), "middle": slot.between(4, 7), "bottom": slot >= 8}
    return pitches(spark, d).groupBy("game_pk").agg(*[r6(F.avg(F.when(c, F.col("release_speed"))), n) for n, c in groups.items()])


@register()
def a12_approximate_distinct(spark, d):
    """HyperLogLog++ counts beside exact ones; a sketch has no SQL twin, a test holds its error."""
    return pitches(spark, d).groupBy("pitcher").agg(F.approx_count_distinct("batter", 0.02).alias("about"), F.count_distinct("batter").alias("exact"))


@register(
    f"""WITH {P}, m AS (SELECT pitcher, avg(release_speed) AS v, count(*) AS n FROM p GROUP BY 1), s AS (SELECT *, percent_rank() OVER (ORDER BY round(v, 6)) AS pct FROM m)
 SELECT pitcher % 10 AS team_id, round(avg(pct), 6) AS mean_percentile, round(sum(pct * n) / sum(n), 6) AS weighted_percentile FROM s GROUP BY 1"""
)
def a20_roster_average(spark, d):
    per = pitches(spark, d).groupBy("pitcher").agg(F.round(F.avg("release_speed"), 6).alias("v"), F.count(F.lit(1)).alias("n"))
    ranked = ranks.ahead(per.groupBy("v").count(), "v", "count", "below").select("v", "below").join(F.broadcast(per.agg(F.count(F.lit(1)).alias("total"))))  # one row
    pct = F.when(F.col("total") > 1, F.col("below") / (F.col("total") - 1)).otherwise(F.lit(0.0))
    return per.join(ranked, "v").withColumn("pct", pct).groupBy((F.col("pitcher") % 10).alias("team_id")).agg(r6(F.avg("pct"), "mean_percentile"), r6(F.sum(F.col("pct") * F.col("n")) / F.sum("n"), "weighted_percentile"))


@register(
    f"""WITH {P}, r AS (SELECT batter, count(DISTINCT game_pk)::BIGINT AS games, count(*)::BIGINT AS pa, sum({CASES}) / (1000.0 * count(*)) AS woba FROM p WHERE game_date > (SELECT max(game_date) FROM p) - 14 GROUP BY 1)
 SELECT batter, games, pa, round(woba, 6) AS woba, round(woba - 0.32, 6) AS delta FROM r WHERE games >= 4 AND pa >= 10"""
)
def a29_recent_form(spark, d):
    p = pitches(spark, d)
    last = p.agg(F.max("game_date").alias("last"))  # one row
    recent = p.join(F.broadcast(last), F.col("game_date") > F.date_sub("last", 14))
    woba = F.sum(weight()) / (1000 * F.count(F.lit(1)))
    form = recent.groupBy("batter").agg(F.count_distinct("game_pk").alias("games"), F.count(F.lit(1)).alias("pa"), r6(woba, "woba"), r6(woba - 0.32, "delta"))
    return form.where("games >= 4 AND pa >= 10")


@register(f"WITH {T} SELECT game_pk, team_id, sum(runs) OVER w::BIGINT AS runs_5, max(runs) OVER w AS most_5, round(avg(runs_allowed) OVER w, 6) AS allowed_5 FROM t WINDOW w AS ({ALL_T} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)")
def w17_named_window(spark, d):
    return spark.sql(
        """SELECT game_pk, team_id, sum(runs) OVER w AS runs_5, max(runs) OVER w AS most_5, round(avg(runs_allowed) OVER w, 6) AS allowed_5 FROM {t}
        WINDOW w AS (PARTITION BY team_id ORDER BY game_date, game_pk ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)""",
        t=team_rows(spark, d),
    )


USE = f"""{P}, u AS (SELECT pitcher, game_date, game_pk, count(*) AS n, count(*) / 4.0 AS ip FROM p WHERE inning > 1 GROUP BY 1, 2, 3),
 u2 AS (SELECT *, n * (CASE WHEN n > 60 AND ip <= 2 THEN 1.5 ELSE 1.0 END) AS load, pitcher % 10 AS team_id FROM u)"""


@register(
    f"""WITH {USE}, days AS (SELECT team_id, game_date, sum(n) AS n, sum(ip) AS ip, sum(load) AS load, count(DISTINCT game_pk) AS games FROM u2 GROUP BY 1, 2),
 arms AS (SELECT x.team_id, x.game_date, count(DISTINCT y.pitcher) AS depth FROM days x JOIN u2 y ON x.team_id = y.team_id AND y.game_date BETWEEN x.game_date - 7 AND x.game_date - 1 GROUP BY 1, 2),
 w AS (SELECT team_id, game_date, sum(n) OVER f AS pitches_7, sum(ip) OVER f AS innings_7, sum(load) OVER f AS load_7, sum(games) OVER f AS games_7 FROM days WINDOW f AS (PARTITION BY team_id ORDER BY game_date RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING))
 SELECT w.team_id, w.game_date, coalesce(pitches_7, 0)::BIGINT AS pitches_7, round(coalesce(innings_7, 0), 6)::DOUBLE AS innings_7, round(coalesce(load_7, 0), 6)::DOUBLE AS load_7, coalesce(games_7, 0)::BIGINT AS games_7, coalesce(depth, 0)::BIGINT AS depth FROM w LEFT JOIN arms USING (team_id, game_date)"""
)
def w20_week_load(spark, d):
    use = pitches(spark, d).where("inning > 1").groupBy("pitcher", "game_date", "game_pk").agg(F.count(F.lit(1)).alias("n")).withColumn("ip", F.col("n") / 4.0)
    return lineup.week_load(use.withColumn("team_id", F.col("pitcher") % 10))


@register(
    f"""WITH {USE}, c AS (SELECT team_id, pitcher, sum(load) AS load, max(game_date) AS last_pitched FROM u2 GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY load DESC, pitcher) AS rn FROM c)
 SELECT team_id, pitcher AS closer, date_diff('day', last_pitched, (SELECT max(game_date) FROM p))::BIGINT AS days_rest FROM r WHERE rn = 1"""
)
def w20_closer_rest(spark, d):
    p = pitches(spark, d)
    use = p.where("inning > 1").groupBy("pitcher", "game_date", "game_pk").agg(F.count(F.lit(1)).alias("n")).withColumn("ip", F.col("n") / 4.0)
    total = use.groupBy((F.col("pitcher") % 10).alias("team_id"), "pitcher").agg(F.sum(lineup.leverage_load()).alias("load"), F.max("game_date").alias("last_pitched"))
    top = dedup.latest_per_key(total, ["team_id"], [F.desc("load"), F.asc("pitcher")])
    last = p.agg(F.max("game_date").alias("last"))  # one row
    return top.join(F.broadcast(last)).select("team_id", F.col("pitcher").alias("closer"), F.datediff("last", "last_pitched").cast("long").alias("days_rest"))


@register(
    f"""WITH {T} SELECT game_pk, team_id, round(0.7 * avg(won) OVER w + 0.3 * sum(runs - runs_allowed) OVER w / 40.0, 6) AS momentum FROM t WINDOW w AS ({ALL_T} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)"""
)
def w25_momentum(spark, d):
    frame = win.before(team_order(), 10)
    score = 0.7 * F.avg("won").over(frame) + 0.3 * F.sum(F.col("runs") - F.col("runs_allowed")).over(frame) / 40.0
    return team_rows(spark, d).select("game_pk", "team_id", r6(score, "momentum"))


@register(
    f"""WITH {P}, a AS (SELECT pitcher, game_date, count(*) AS n FROM p GROUP BY 1, 2) SELECT pitcher, game_date, date_diff('day', lag(game_date) OVER (PARTITION BY pitcher ORDER BY game_date), game_date)::BIGINT AS days_off,
 round(avg(n) OVER (PARTITION BY pitcher ORDER BY game_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS mean_5 FROM a"""
)
def w26_workload(spark, d):
    days = pitches(spark, d).groupBy("pitcher", "game_date").agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy("pitcher").orderBy("game_date")
    return days.select("pitcher", "game_date", F.datediff("game_date", F.lag("game_date").over(w)).cast("long").alias("days_off"), r6(F.avg("n").over(w.rowsBetween(-4, 0)), "mean_5"))


@register(
    f"""WITH {P}, v AS (SELECT pitcher, game_pk % 30 AS venue_id, count(*) FILTER (events IN ('strikeout', 'field_out')) / 3.0 AS ip, count(*) FILTER (events = 'home_run') AS er, count(*) FILTER (events IN ('single', 'home_run', 'walk')) AS on_base,
 count(*) FILTER (events = 'strikeout') AS k, count(*) AS bf FROM p GROUP BY 1, 2) SELECT pitcher, venue_id, CASE WHEN ip >= 5 THEN round(er / ip * 9, 3) ELSE 4.25 END::DOUBLE AS venue_era, CASE WHEN ip >= 5 THEN round(on_base / ip, 3) ELSE 1.3 END::DOUBLE AS venue_whip,
 CASE WHEN ip >= 5 THEN round(k / ip * 9, 3) ELSE 8.0 END::DOUBLE AS venue_k9, CASE WHEN ip >= 5 THEN bf ELSE 0 END::BIGINT AS venue_pa FROM v"""
)
def m8_pitcher_at_venue(spark, d):
    """Earned runs are counted as home runs; under five innings the neutral defaults stand."""
    is_ = lambda *names: F.count_if(F.col("events").isin(*names))
    v = pitches(spark, d).groupBy("pitcher", (F.col("game_pk") % 30).alias("venue_id")).agg((is_("strikeout", "field_out") / 3.0).alias("ip"), is_("home_run").alias("er"), is_("single", "home_run", "walk").alias("on_base"), is_("strikeout").alias("k"), F.count(F.lit(1)).alias("bf"))
    enough = F.col("ip") >= 5
    pick = lambda c, neutral, name: F.when(enough, F.round(c, 3)).otherwise(F.lit(neutral)).alias(name)
    return v.select("pitcher", "venue_id", pick(F.col("er") / F.col("ip") * 9, 4.25, "venue_era"), pick(F.col("on_base") / F.col("ip"), 1.3, "venue_whip"), pick(F.col("k") / F.col("ip") * 9, 8.0, "venue_k9"), F.when(enough, F.col("bf")).otherwise(F.lit(0)).alias("venue_pa"))


@register(f"WITH {G} SELECT CASE WHEN season < 1996 THEN 'train' WHEN season = 1996 THEN 'dev' WHEN season = 1997 THEN 'val' ELSE 'test' END AS part, count(*)::BIGINT AS n, min(game_date) AS first_day, max(game_date) AS last_day FROM g GROUP BY 1")
def m11_temporal_split(spark, d):
    part = splits.by_season("season", dev=1996, val=1997, test=1998)
    return games(spark, d).groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("game_date").alias("first_day"), F.max("game_date").alias("last_day"))


@register(
    f"""WITH {G}, n AS (SELECT *, row_number() OVER (ORDER BY game_date, game_pk) - 1 AS i, count(*) OVER () AS total FROM g) SELECT game_pk, (i * 6 // total)::BIGINT AS fold, (i < floor(0.6 * total)) AS fits_calibration FROM n"""
)
def m13_m14_ordered_folds(spark, d):
    numbered = splits.numbered(games(spark, d), "game_date", "game_pk")
    return numbered.select("game_pk", F.expr("i * 6 div total").alias("fold"), (F.col("i") < F.floor(0.6 * F.col("total"))).alias("fits_calibration"))


@register(
    """WITH z AS (SELECT toxic::BIGINT AS y, doc_id * 37 % 100 AS p, doc_id * 61 % 100 AS q FROM labels), a AS (SELECT w, avg(((w * p + (10 - w) * q >= 500)::INT = y)::INT) AS acc, avg(power((w * p + (10 - w) * q) / 1000.0 - y, 2)) AS b FROM z, generate_series(0, 10) AS s(w) GROUP BY 1)
 SELECT (w / 10.0)::DOUBLE AS weight, round(acc, 6) AS accuracy, round(b, 6) AS brier, row_number() OVER (ORDER BY round(acc, 6) DESC, w) = 1 AS best FROM a"""
)
def m18_m19_blend_weights(spark, d):
    """All weights in one pass over the predictions: a column for each, no copy of the rows."""
    z = predictions(spark, d).select("y", (F.col("game_pk") * 37 % 100).alias("p"), (F.col("game_pk") * 61 % 100).alias("q"))
    mix = {w: w * F.col("p") + (10 - w) * F.col("q") for w in range(11)}
    one = z.agg(*[F.struct(F.lit(w / 10).alias("weight"), r6(F.avg(((m >= 500).cast("int") == F.col("y")).cast("int")), "accuracy"), r6(F.avg(F.pow(m / 1000.0 - F.col("y"), F.lit(2.0))), "brier")).alias(f"w{w}") for w, m in mix.items()])
    rows = one.select(F.explode(F.array(*[f"w{w}" for w in mix])).alias("r")).select("r.*")
    return rows.withColumn("best", F.row_number().over(W.orderBy(F.desc("accuracy"), "weight")) == 1)  # eleven rows


@register(
    f"""WITH {P} SELECT 'batter' AS feature, round(count(batter) / count(*), 6)::DOUBLE AS coverage, count(batter) = 0 AS missing FROM p UNION ALL SELECT 'release_speed', round(count(release_speed) / count(*), 6)::DOUBLE, count(release_speed) = 0 FROM p
 UNION ALL SELECT 'events', round(count(events) / count(*), 6)::DOUBLE, count(events) = 0 FROM p"""
)
def m28_availability(spark, d):
    return splits.availability(pitches(spark, d), ["batter", "release_speed", "events"])


@register(f"WITH {T}, n AS (SELECT *, {RATED} - 1 AS played FROM t) SELECT season, month(game_date)::INT AS month, count(*)::BIGINT AS n, round(avg(least(1.0, played / 30.0)), 6)::DOUBLE AS completeness FROM n GROUP BY 1, 2")
def m32_monitoring(spark, d):
    rows = team_rows(spark, d).withColumn("played", F.row_number().over(season_order()) - 1)
    return rows.groupBy("season", F.month("game_date").alias("month")).agg(F.count(F.lit(1)).alias("n"), r6(F.avg(F.least(F.lit(1.0), F.col("played") / 30.0)), "completeness"))


@register(
    """WITH z AS (SELECT toxic::BIGINT AS y, doc_id * 37 % 100 AS p FROM labels), o AS (SELECT unnest([0, 3, 5, 7, 10, 12, 15, 20]) AS o), a AS (SELECT o, count(*) AS n, avg(((p >= 50)::INT = y)::INT) AS acc FROM z JOIN o ON abs(p - 50) >= o GROUP BY 1)
 SELECT (o / 100.0)::DOUBLE AS cut, n::BIGINT AS n, round(acc, 6) AS accuracy FROM a WHERE n >= 0.1 * (SELECT count(*) FROM z) ORDER BY round(acc, 6) DESC, o LIMIT 1"""
)
def m36_best_confident(spark, d):
    z = predictions(spark, d).select("y", (F.col("game_pk") * 37 % 100).alias("p"))
    right = ((F.col("p") >= 50).cast("int") == F.col("y")).cast("int")
    sure = {o: F.abs(F.col("p") - 50) >= o for o in (0, 3, 5, 7, 10, 12, 15, 20)}
    one = z.agg(F.count(F.lit(1)).alias("total"), *[F.struct(F.lit(o / 100).alias("cut"), F.count_if(c).alias("n"), r6(F.avg(F.when(c, right)), "accuracy")).alias(f"o{o}") for o, c in sure.items()])
    rows = one.select("total", F.explode(F.array(*[f"o{o}" for o in sure])).alias("r")).where("r.n >= 0.1 * total").select("r.*")
    return rows.orderBy(F.desc("accuracy"), "cut").limit(1)


@register(
    f"""WITH {T}, f AS (SELECT *, avg(won) OVER w AS form, avg(runs) OVER w AS scored, avg(runs_allowed) OVER w AS allowed FROM t WINDOW w AS ({ALL_T} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING))
 SELECT game_pk, game_date, season, month(game_date)::INT AS month, isodow(game_date)::INT - 1 AS weekday, round(coalesce(max(form) FILTER (is_home), 0.5), 6) AS home_form, round(max(scored) FILTER (is_home), 6) AS home_scored, round(max(allowed) FILTER (is_home), 6) AS home_allowed,
 round(coalesce(max(form) FILTER (NOT is_home), 0.5), 6) AS away_form, round(max(scored) FILTER (NOT is_home), 6) AS away_scored, round(max(allowed) FILTER (NOT is_home), 6) AS away_allowed, max(won) FILTER (is_home)::INT AS home_won FROM f GROUP BY 1, 2, 3"""
)
def m1_training_set(spark, d):
    return training_set(team_rows(spark, d))


def training_set(teams: DataFrame) -> DataFrame:
    rows = teams.withColumn("form", F.round(win.rolling("won", team_order(), 10, 0.5), 6)).withColumn("scored", F.round(win.rolling("runs", team_order(), 10), 6)).withColumn("allowed", F.round(win.rolling("runs_allowed", team_order(), 10), 6))
    wide = reshape.to_game_grain(rows, ["form", "scored", "allowed", "won"])
    return wide.select("game_pk", "game_date", "season", F.month("game_date").alias("month"), F.weekday("game_date").alias("weekday"), *[f"{s}_{c}" for s in ("home", "away") for c in ("form", "scored", "allowed")], "home_won")


@register(
    f"""WITH {T}, s AS (SELECT t.*, status_code = 'F' AS final FROM t JOIN g USING (game_pk)), r AS (SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY game_date DESC, game_pk DESC) AS rn FROM s WHERE final),
 l AS (SELECT team_id, round(avg(runs) * 0.6 + 4.5 * 0.4, 6) AS scored, round(avg(runs_allowed) * 0.6 + 4.5 * 0.4, 6) AS allowed FROM r WHERE rn <= 10 GROUP BY 1)
 SELECT game_pk, s.team_id, coalesce(scored, 4.5) AS scored, coalesce(allowed, 4.5) AS allowed FROM s LEFT JOIN l ON s.team_id = l.team_id WHERE NOT final"""
)
def z6_carry_forward(spark, d):
    """Games without results get their teams' last ten finished games, 40 % of the way back to the league's mean."""
    rows = reshape.to_team_grain(games(spark, d)).join(games(spark, d).select("game_pk", (F.col("status_code") == "F").alias("final")), "game_pk")
    last = dedup.top_k(rows.where("final"), ["team_id"], [F.desc("game_date"), F.desc("game_pk")], 10).groupBy("team_id")
    state = last.agg(*[F.round(F.avg(c) * 0.6 + 4.5 * 0.4, 6).alias(n) for c, n in (("runs", "scored"), ("runs_allowed", "allowed"))])
    return rows.where("NOT final").join(state, "team_id", "left").select("game_pk", "team_id", F.coalesce("scored", F.lit(4.5)).alias("scored"), F.coalesce("allowed", F.lit(4.5)).alias("allowed"))


@register()
def m3_rating_features(spark, d):
    """The training set with pre-game ratings and the count of earlier meetings; ratings have no SQL twin."""
    g = games(spark, d)
    pair = W.partitionBy(F.least("home_team_id", "away_team_id"), F.greatest("home_team_id", "away_team_id")).orderBy("game_date", "game_pk").rowsBetween(W.unboundedPreceding, -1)
    met = g.select("game_pk", F.count(F.lit(1)).over(pair).alias("met_before"), F.avg((F.col("home_score") > F.col("away_score")).cast("int")).over(pair).alias("home_side_rate"))
    rated = elo.replay(leagues(spark, d), pool="league").select("game_pk", "home_elo", "away_elo", (F.col("home_elo") - F.col("away_elo")).alias("elo_differential"), "home_probability")
    return m1_training_set(spark, d).join(met, "game_pk", "left").join(rated, "game_pk", "left").withColumn("expected_home", S.elo_probability(F.col("home_elo"), F.col("away_elo"), elo.BONUS))


@register()
def z3_z4_incremental_elo(spark, d):
    """State before the last season, regressed, then only that season's games applied: equals the full replay."""
    g = leagues(spark, d)
    last = g.agg(F.max("season").alias("last"))  # one row
    g = g.join(F.broadcast(last))
    seeded = elo.seed(elo.ratings_after(g.where("season < last").drop("last"), pool="league"))
    return elo.ratings_after(g.where("season = last").drop("last"), seeded, pool="league").select(F.col("pool").cast("long").alias("league"), "team_id", r6(F.col("rating"), "rating"), F.col("games").cast("long").alias("games"))


@register()
def z5_lineup_projection(spark, d):
    """Lineups projected from the last 14 days: slots 1..9 of every team (pitchers' batters stand in for players)."""
    p = pitches(spark, d).where("batter IS NOT NULL")
    seen = p.groupBy((F.col("pitcher") % 10).alias("team_id"), "game_date", "game_pk", F.col("batter").alias("player_id")).agg(F.min(1 + F.col("pitch_id") % 9).cast("int").alias("batting_order"))
    last = p.agg(F.date_add(F.max("game_date"), 1).alias("target_date"))  # one row
    return lineup.project(seen.join(F.broadcast(last)), ["team_id"])


@register(
    f"""WITH {P}, b AS (SELECT game_pk, batter, count(*) AS pa, count(*) FILTER (events IN ('single', 'home_run')) AS hits FROM p WHERE batter IS NOT NULL GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY game_pk ORDER BY hits DESC, batter) AS rn FROM b)
 SELECT game_pk, string_agg(batter || ':' || hits || '/' || pa, ',' ORDER BY rn) AS best FROM r WHERE rn <= 3 GROUP BY 1"""
)
def m30_m31_report(spark, d):
    """Reports of all games, and from their JSON the three best batters of each."""
    p = pitches(spark, d).where("batter IS NOT NULL")
    batters = p.groupBy("game_pk", "batter").agg(F.count(F.lit(1)).alias("pa"), F.count_if(F.col("events").isin("single", "home_run")).alias("hits"))
    top = reports.section(dedup.top_k(batters, ["game_pk"], [F.desc("hits"), F.asc("batter")], 3), "game_pk", "batters", ["batter", "hits", "pa"], ["rank"])
    per_arm = p.groupBy("game_pk", "pitcher").agg(F.count(F.lit(1)).alias("n"))
    arms = reports.section(per_arm, "game_pk", "pitchers", ["pitcher", "n"], ["pitcher"])
    report = reports.assemble(p.select("game_pk").distinct(), "game_pk", [top, arms])
    read = F.from_json("report", "batters array<struct<batter: bigint, hits: bigint, pa: bigint>>")["batters"]
    return report.select("game_pk", F.array_join(F.transform(read, lambda x: F.concat(x["batter"], F.lit(":"), x["hits"], F.lit("/"), x["pa"])), ",").alias("best"))
