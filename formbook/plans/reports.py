"""Registered queries of versioned tables and views, layouts, backfills, models side by side, rules, terms and sketches."""

from __future__ import annotations

import uuid

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formbook.operators import backfill, dedup, models, reshape, rules, selection, sketches, terms, views
from formbook.operators import reports as nested
from formbook.operators import windows as win
from formbook.plans.assembled import weights
from formbook.plans.catalog import SEASON_T, G, P, T, games, pitches, r6, register, season_order, table
from formbook.plans.learned import FEATURES, split
from formbook.plans.features import m1_training_set
from formbook.sources import sinks, versions


# --- S21: a view that follows its source ------------------------------------------
def season_form(df):
    """Record of both teams in the season before each game; a season is a partition, so one season's games are all that it reads."""
    rows = reshape.to_team_grain(df)
    return rows.select("game_pk", "season", "team_id", F.count(F.lit(1)).over(win.before(season_order())).alias("played"), win.cumulative("won", season_order()).alias("won_before"), win.cumulative("runs", season_order()).alias("runs_before"))


@register(
    f"""WITH {T} SELECT game_pk, season, team_id, count(*) OVER w::BIGINT AS played, coalesce(sum(won) OVER w, 0)::BIGINT AS won_before, coalesce(sum(runs) OVER w, 0)::BIGINT AS runs_before FROM t
 WINDOW w AS ({SEASON_T} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
)
def s21_feature_view(spark, d):
    """The view is built without a tenth of the last two seasons' games; they come, and the refresh computes these seasons alone."""
    home = sinks.shared_folder(spark, "s21")
    g = games(spark, d)
    later = (F.col("season") >= 1997) & (F.col("game_pk") % 10 == 0)
    versions.create(g.where(~later), f"{home}/games", "season", ["game_pk"])
    view = views.View(f"{home}/games", f"{home}/form", season_form, "season")
    view.refresh(spark)
    versions.upsert(g.where(later), view.source)
    view.refresh(spark)
    return view.read(spark).select("game_pk", "season", "team_id", "played", "won_before", "runs_before")


# --- S22: failure as data ----------------------------------------------------------
@register(
    f"""WITH {G}, d AS (SELECT game_date AS day, count(*)::BIGINT AS n, count(*) FILTER (home_score = away_score)::BIGINT AS ties, count(*) FILTER (home_score + away_score > 19)::BIGINT AS many FROM g WHERE season = 1996 GROUP BY 1),
 e AS (SELECT day, n, concat_ws('; ', CASE WHEN ties > n // 3 THEN 'ties: ' || ties END, CASE WHEN many > 0 THEN 'many: ' || many END) AS error FROM (SELECT day, n, CASE WHEN ties > n // 3 THEN ties ELSE 0 END AS ties, many FROM d))
 SELECT day, CASE WHEN error = '' THEN 'ok' ELSE 'error' END AS status, CASE WHEN error = '' THEN n ELSE 0 END AS rows, nullif(error, '') AS error FROM e"""
)
def s22_backfill_outcomes(spark, d):
    """Days of a season with more ties than a third of their games, or a game of twenty runs, are errors; the others are filled."""
    g = games(spark, d).where("season = 1996")
    tie = (F.col("home_score") == F.col("away_score")).cast("int")
    per = W.partitionBy("game_date")
    marked = g.withColumn("odd_tie", (tie == 1) & (F.sum(tie).over(per) > F.expr("count(1) OVER (PARTITION BY game_date) div 3")))
    return backfill.checked(marked, "game_date", {"ties": ~F.col("odd_tie"), "many": F.col("home_score") + F.col("away_score") <= 19})[1]


# --- S20: buckets and integer ranges -----------------------------------------------
def bucketed(spark, d):
    """Games and their lines in buckets of the game's key."""
    home, tag = sinks.shared_folder(spark, "s20"), uuid.uuid4().hex
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("game_pk"), "l_linenumber", F.col("l_quantity").cast("double").alias("q"))
    sinks.bucketed_table(games(spark, d), f"games_{tag}", f"{home}/games", "game_pk", 16)
    sinks.bucketed_table(lines, f"lines_{tag}", f"{home}/lines", "game_pk", 16)
    return spark.table(f"games_{tag}"), spark.table(f"lines_{tag}")


@register(f"WITH {G} SELECT season, count(*)::BIGINT AS n, round(avg(l_quantity), 6) AS q FROM g JOIN lineitem ON l_orderkey = game_pk GROUP BY 1")
def s20_bucketed_join(spark, d):
    """The join of two tables in buckets of one key needs no exchange."""
    g, lines = bucketed(spark, d)
    return g.join(lines, "game_pk").groupBy("season").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("q"), "q"))


@register(f"WITH {G} SELECT CASE WHEN game_pk < 60000 THEN game_pk - game_pk % 5000 END AS key_range, count(*)::BIGINT AS n, min(game_pk)::BIGINT AS low, max(game_pk)::BIGINT AS high FROM g GROUP BY 1")
def s20_integer_ranges(spark, d):
    home, tag = sinks.shared_folder(spark, "s20"), uuid.uuid4().hex
    sinks.bucketed_table(games(spark, d), f"ranged_{tag}", f"{home}/games", "game_pk", 4, bounds=(0, 60_000, 5_000))
    return spark.table(f"ranged_{tag}").groupBy(F.col("key_range").cast("long").alias("key_range")).agg(F.count(F.lit(1)).alias("n"), F.min("game_pk").alias("low"), F.max("game_pk").alias("high"))


# --- M16, M20 ------------------------------------------------------------------------
@register()
def m16_model_kinds(spark, d):
    """Each kind of model fitted on the earlier seasons and measured on the last."""
    before, target = split(spark, d)
    out = None
    kinds = ("perceptron", "boosted", "forest", "logistic")  # the longest fit first
    for kind, model in zip(kinds, models.fit_each(before, FEATURES, [(k, {}) for k in kinds], side_by_side=2), strict=True):
        own = models.metrics(models.score(model, target, FEATURES)).select(F.lit(kind).alias("kind"), "n", *[r6(F.col(c), c) for c in ("accuracy", "brier", "log_loss")])
        out = own if out is None else out.unionByName(own)
    return out


@register()
def m20_parameter_search(spark, d):
    """Strengths of regularisation over all walk-forward seasons, fitted side by side."""
    rows = models.training_table(m1_training_set(spark, d))
    return models.search(rows, FEATURES, "logistic", [{"regParam": 0.001}, {"regParam": 0.1}, {"regParam": 1.0}]).select("params", "n", *[r6(F.col(c), c) for c in ("accuracy", "brier", "log_loss")])


# --- N25, N26 ------------------------------------------------------------------------
def against(spark, d):
    """Batters against the pitchers of a team: plate appearances, hits, home runs and hitting value."""
    p = pitches(spark, d).where("batter IS NOT NULL")
    per = p.groupBy((F.col("batter") % 10).alias("team"), (F.col("pitcher") % 10).alias("opponent"), "batter")
    value = F.round(F.sum(weights()) / (1000.0 * F.count(F.lit(1))) - 0.4, 3)
    return per.agg(F.count(F.lit(1)).alias("pa"), F.count_if(F.col("events") == "home_run").alias("hr"), value.alias("woba")).withColumn("player", F.concat(F.lit("player "), "batter")).where("team <> opponent")


def hit_runs(spark, d):
    """Days in a row with a hit, up to a batter's last day."""
    days = pitches(spark, d).where("batter IS NOT NULL").groupBy("batter", "game_date").agg(F.max(F.col("events").isin("single", "home_run").cast("int")).alias("hit"))
    rows = days.withColumn("rn", F.row_number().over(W.partitionBy("batter").orderBy(F.desc("game_date"))))
    runs = rows.groupBy("batter").agg(F.coalesce(F.min(F.when(F.col("hit") == 0, F.col("rn"))) - 1, F.count(F.lit(1))).cast("long").alias("hit_streak"))
    return runs.select((F.col("batter") % 10).alias("team"), "batter", F.concat(F.lit("player "), "batter").alias("player"), "hit_streak")


CASES = "CASE events WHEN 'walk' THEN 690 WHEN 'single' THEN 880 WHEN 'home_run' THEN 2031 ELSE 0 END"
AGAINST = f"""v AS (SELECT batter % 10 AS team, pitcher % 10 AS opponent, batter, 'player ' || batter AS player, count(*) AS pa, count(*) FILTER (events = 'home_run') AS hr, round(sum({CASES}) / (1000.0 * count(*))::DOUBLE - 0.4, 3) AS woba
 FROM p WHERE batter IS NOT NULL GROUP BY 1, 2, 3 HAVING batter % 10 <> pitcher % 10)"""
RIVALS = """r AS (SELECT 100 * least(team_id % 10, opponent_id % 10) + greatest(team_id % 10, opponent_id % 10) AS report, least(team_id % 10, opponent_id % 10) AS home, greatest(team_id % 10, opponent_id % 10) AS away,
 count(*)::BIGINT AS h2h_games, round(avg(CASE WHEN team_id % 10 < opponent_id % 10 THEN won ELSE 1 - won END), 6) AS h2h_pct FROM t WHERE is_home AND team_id % 10 <> opponent_id % 10 GROUP BY 1, 2, 3)"""


def rivals(spark, d):
    """Reports: pairs of teams, and how often the first won of late."""
    t = reshape.to_team_grain(games(spark, d)).where("is_home AND team_id % 10 <> opponent_id % 10")
    a, b = F.col("team_id") % 10, F.col("opponent_id") % 10
    per = t.groupBy((100 * F.least(a, b) + F.greatest(a, b)).alias("report"), F.least(a, b).alias("home"), F.greatest(a, b).alias("away"))
    return per.agg(F.count(F.lit(1)).alias("h2h_games"), r6(F.avg(F.when(a < b, F.col("won")).otherwise(1 - F.col("won"))), "h2h_pct"))


@register(
    f"""WITH {T}, {P}, {AGAINST}, {RIVALS},
 days AS (SELECT batter, game_date, max((events IN ('single', 'home_run'))::INT) AS hit FROM p WHERE batter IS NOT NULL GROUP BY 1, 2), rn AS (SELECT *, row_number() OVER (PARTITION BY batter ORDER BY game_date DESC) AS rn FROM days),
 hs AS (SELECT batter % 10 AS team, batter, coalesce(min(rn) FILTER (hit = 0) - 1, count(*)) AS s FROM rn GROUP BY 2, 1),
 f AS (SELECT report, NULL::BIGINT AS opponent, CASE WHEN hs.team = home THEN 0 ELSE 1 END AS part, CASE WHEN s >= 15 THEN 1 WHEN s >= 10 THEN 2 ELSE 3 END AS place, -s::DOUBLE AS strength, batter,
   CASE WHEN s >= 15 THEN 'player ' || batter || ' is on fire: hits in ' || s || ' consecutive games' WHEN s >= 10 THEN 'player ' || batter || ' has hit in ' || s || ' straight games' ELSE 'player ' || batter || ' has a ' || s || '-game hit streak' END AS text FROM r JOIN hs ON hs.team IN (home, away) WHERE s >= 7
  UNION ALL SELECT report, opponent, CASE WHEN team = home THEN 2 ELSE 3 END, CASE WHEN woba >= 0.42 AND pa >= 10 THEN 10 WHEN woba >= 0.375 AND pa >= 15 THEN 11 WHEN hr >= 4 THEN 12 ELSE 13 END, -woba, batter,
   CASE WHEN woba >= 0.42 AND pa >= 10 THEN player || ' is mashing against ' || opponent || ': ' || woba || ' in ' || pa WHEN woba >= 0.375 AND pa >= 15 THEN player || ' has owned ' || opponent || ': ' || woba || ', ' || hr || ' home runs in ' || pa
   WHEN hr >= 4 THEN player || ' has ' || hr || ' home runs against ' || opponent || ' in ' || pa ELSE player || ' struggles against ' || opponent || ': ' || woba || ' in ' || pa END
   FROM (SELECT r.report, r.home, v.*, row_number() OVER (PARTITION BY report, v.team ORDER BY woba DESC, batter) AS n FROM r JOIN v ON (v.team = home AND v.opponent = away) OR (v.team = away AND v.opponent = home)) WHERE n <= 5 AND ((woba >= 0.42 AND pa >= 10) OR (woba >= 0.375 AND pa >= 15) OR hr >= 4 OR (woba <= 0.22 AND pa >= 15))
  UNION ALL SELECT report, NULL, 4, CASE WHEN h2h_pct >= 0.625 THEN 20 ELSE 21 END, 0.0, 0, CASE WHEN h2h_pct >= 0.625 THEN home || ' dominated: ' || round(h2h_pct * h2h_games)::DOUBLE || ' of ' || h2h_games ELSE away || ' own the rivalry: ' || (h2h_games - round(h2h_pct * h2h_games))::DOUBLE || ' of ' || h2h_games END FROM r WHERE h2h_games >= 8 AND (h2h_pct >= 0.625 OR h2h_pct <= 0.375)),
 c AS (SELECT * FROM f QUALIFY opponent IS NULL OR row_number() OVER (PARTITION BY report, opponent ORDER BY part, strength, batter) <= 3)
 SELECT report::BIGINT AS report, row_number() OVER (PARTITION BY report ORDER BY part, strength, batter)::BIGINT AS fact_no, opponent, text FROM c QUALIFY fact_no <= 8"""
)
def n25_report_facts(spark, d):
    """Facts of a report: hit streaks, at most three of the five best batters against each opponent, the rivalry; eight in all."""
    r, v, runs = rivals(spark, d), against(spark, d), hit_runs(spark, d)
    none, keep = F.lit(None).cast("long").alias("opponent"), ["report", "opponent", "part", "strength", "batter"]
    streaks = r.join(runs, F.col("team").isin(F.col("home"), F.col("away"))).select("report", none, F.when(F.col("team") == F.col("home"), 0).otherwise(1).alias("part"), (-F.col("hit_streak")).cast("double").alias("strength"), "batter", "player", "hit_streak")
    sides = r.select("report", "home", F.explode(F.array(F.struct(F.col("home").alias("team"), F.col("away").alias("opponent")), F.struct(F.col("away").alias("team"), F.col("home").alias("opponent")))).alias("s")).select("report", "home", "s.*")
    best = F.row_number().over(W.partitionBy("report", "team").orderBy(F.desc("woba"), "batter"))
    batters = sides.join(v, ["team", "opponent"]).withColumn("n", best).where("n <= 5").withColumns({"part": F.when(F.col("team") == F.col("home"), 2).otherwise(3), "strength": -F.col("woba")})
    rivalry = r.select("*", none, F.lit(4).alias("part"), F.lit(0.0).alias("strength"), F.lit(0).cast("long").alias("batter"))
    found = rules.facts(streaks, rules.HIT_STREAKS, keep).unionByName(rules.facts(batters, rules.BATTERS, keep)).unionByName(rules.facts(rivalry, rules.RIVALRIES, keep))
    taken = rules.capped(found, ["report"], ["opponent"], [F.col("part"), F.col("strength"), F.col("batter")], 3, 8)
    return taken.select("report", F.col("fact_no").cast("long").alias("fact_no"), "opponent", "text")


@register(
    f"""WITH {T}, {P}, {AGAINST}, {RIVALS}, h AS (SELECT team, opponent, sum(pa)::BIGINT AS h2h_pa, round(sum(woba * pa) / sum(pa) - 0.06 + 0.02 * ((team + opponent) % 4), 3) AS h2h_woba FROM v GROUP BY 1, 2),
 top AS (SELECT team, player AS hot_player, woba AS hot_woba, opponent FROM v QUALIFY row_number() OVER (PARTITION BY team, opponent ORDER BY woba DESC, batter) = 1),
 e AS (SELECT team_id % 10 AS team, won, game_date, game_pk FROM t), x AS (SELECT *, row_number() OVER (PARTITION BY team ORDER BY game_date DESC, game_pk DESC, won) AS rn FROM e), l AS (SELECT team, won AS last FROM x WHERE rn = 1),
 k AS (SELECT x.team, CASE WHEN any_value(last) = 1 THEN 1 ELSE -1 END * coalesce(min(rn) FILTER (won <> last) - 1, count(*)) AS streak FROM x JOIN l USING (team) GROUP BY 1),
 side AS (SELECT report, home AS team, away AS opponent, 0 AS s FROM r UNION ALL SELECT report, away, home, 1 FROM r), j AS (SELECT side.*, h2h_pa, h2h_woba, streak, hot_player, hot_woba FROM side LEFT JOIN h USING (team, opponent) LEFT JOIN k USING (team) LEFT JOIN top USING (team, opponent)),
 f AS (SELECT report, 0 AS kind, s, CASE WHEN abs(h2h_woba - 0.32) < 0.015 THEN 'lineup ' || team || ' is familiar: ' || h2h_woba || ' in ' || h2h_pa WHEN h2h_woba - 0.32 < -0.015 THEN 'lineup ' || team || ' dominates: ' || h2h_woba || ' in ' || h2h_pa ELSE 'lineup ' || team || ' struggles: ' || h2h_woba || ' in ' || h2h_pa END AS text FROM j WHERE h2h_woba <> 0 AND h2h_pa >= 15
  UNION ALL SELECT report, 1, s, team || ' riding a ' || CASE WHEN streak > 0 THEN 'W' ELSE 'L' END || abs(streak) || ' streak' FROM j WHERE abs(streak) >= 4 UNION ALL SELECT report, 2, s, hot_player || ' is hot: ' || hot_woba FROM j WHERE hot_woba IS NOT NULL)
 SELECT report::BIGINT AS report, row_number() OVER (PARTITION BY report ORDER BY kind, s)::BIGINT AS fact_no, text FROM f QUALIFY fact_no <= 6"""
)
def n26_watch_list(spark, d):
    """What to watch: lineups that know the other side, streaks, the hottest batter of each side; six in all."""
    r, v = rivals(spark, d), against(spark, d)
    sides = r.select("report", F.explode(F.array(F.struct(F.col("home").alias("team"), F.col("away").alias("opponent"), F.lit(0).alias("s")), F.struct(F.col("away").alias("team"), F.col("home").alias("opponent"), F.lit(1).alias("s")))).alias("x")).select("report", "x.*")
    lineups = v.groupBy("team", "opponent").agg(F.sum("pa").alias("h2h_pa"), F.round(F.sum(F.col("woba") * F.col("pa")) / F.sum("pa") - 0.06 + 0.02 * ((F.col("team") + F.col("opponent")) % 4), 3).alias("h2h_woba"))
    hot = v.withColumn("n", F.row_number().over(W.partitionBy("team", "opponent").orderBy(F.desc("woba"), "batter"))).where("n = 1").select("team", "opponent", F.col("player").alias("hot_player"), F.col("woba").alias("hot_woba"))
    e = reshape.to_team_grain(games(spark, d)).select((F.col("team_id") % 10).alias("team"), "won", "game_date", "game_pk")
    x = e.withColumn("rn", F.row_number().over(W.partitionBy("team").orderBy(F.desc("game_date"), F.desc("game_pk"), "won")))
    x = x.withColumn("last", F.first("won").over(W.partitionBy("team").orderBy("rn")))
    streak = x.groupBy("team").agg((F.when(F.max("last") == 1, 1).otherwise(-1) * F.coalesce(F.min(F.when(F.col("won") != F.col("last"), F.col("rn"))) - 1, F.count(F.lit(1)))).alias("streak"))
    subjects = sides.join(lineups, ["team", "opponent"], "left").join(streak, "team", "left").join(hot, ["team", "opponent"], "left")
    found = rules.facts(subjects, rules.WATCHED, ["report", "s"])
    order = [F.array_position(F.array(*[F.lit(k) for k in ("h2h", "streak", "hot_player")]), F.col("kind")), F.col("s")]
    return rules.capped(found, ["report"], [], order, 6, 6).select("report", F.col("fact_no").cast("long").alias("fact_no"), "text")


# --- J8, A12 ---------------------------------------------------------------------------
@register(
    r"""WITH k AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[a-z]{6,}')) AS word FROM benchmark), m AS (SELECT word, count(*)::BIGINT AS articles, min(doc_id)::BIGINT AS first FROM documents JOIN k ON contains(text, word) GROUP BY 1) SELECT * FROM m"""
)
def j8_term_automaton(spark, d):
    """Every longer word of the benchmark as a keyword: one automaton, one pass over the texts."""
    words = table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("([a-z]{6,})"), 1)).alias("word"))
    return terms.met(table(spark, d, "documents"), words, "doc_id", "text", "word").groupBy("word").agg(F.count(F.lit(1)).alias("articles"), F.min("doc_id").alias("first"))


@register(
    f"""WITH {P}, r AS (SELECT a.game_date AS first_day, b.game_date AS last_day FROM (SELECT DISTINCT game_date FROM p) a JOIN (SELECT DISTINCT game_date FROM p) b ON b.game_date >= a.game_date AND b.game_date - a.game_date IN (0, 6, 20))
 SELECT first_day, last_day, count(DISTINCT pitcher * 1000000 + batter)::BIGINT AS exact, TRUE AS close FROM r JOIN p ON game_date BETWEEN first_day AND last_day GROUP BY 1, 2"""
)
def a12_sketches_of_ranges(spark, d):
    """Distinct pairs of any range of days from stored sketches of single days, within 2 % of the exact count."""
    p = pitches(spark, d).withColumn("pair", F.col("pitcher") * 1_000_000 + F.col("batter"))
    days = sinks.stored(sketches.daily(p, "game_date", "pair"), "sketches")
    at = days.select("game_date")
    ranges = at.select(F.col("game_date").alias("first_day"), F.explode(F.array(*[F.date_add("game_date", n) for n in (0, 6, 20)])).alias("last_day")).join(at.select(F.col("game_date").alias("last_day")), "last_day").select("first_day", "last_day")
    about = sketches.over_ranges(days, ranges, "game_date", "first_day", "last_day")
    within = ranges.withColumn("game_date", F.explode(F.sequence("first_day", "last_day")))
    exact = within.join(p.select("game_date", "pair").distinct(), "game_date").groupBy("first_day", "last_day").agg(F.count_distinct("pair").alias("exact"))
    return exact.join(about, ["first_day", "last_day"]).select("first_day", "last_day", "exact", (F.abs(F.col("about") - F.col("exact")) <= 0.02 * F.col("exact")).alias("close"))


# --- M31 ---------------------------------------------------------------------------------
def _sides(r):
    """Both sides of a report: (report, venue, team, opponent); the home side's ground is the venue."""
    return r.select("report", F.col("home").alias("venue"), F.explode(F.array(F.struct(F.col("home").alias("team"), F.col("away").alias("opponent")), F.struct(F.col("away").alias("team"), F.col("home").alias("opponent")))).alias("x")).select("report", "venue", "x.*")


def _batting(p, *by):
    """Plate appearances and hitting value of batters by more keys."""
    return p.groupBy((F.col("batter") % 10).alias("team"), "batter", *by).agg(F.count(F.lit(1)).alias("pa"), F.round(F.sum(weights()) / (1000.0 * F.count(F.lit(1))) - 0.4, 3).alias("woba"))


def _best(rows, section: str, most: int):
    place = F.row_number().over(W.partitionBy("report", "team").orderBy(F.desc("woba"), "batter"))
    return rows.withColumn("place", place).where(F.col("place") <= most).select("report", F.lit(section).alias("section"), "team", F.col("place").cast("long").alias("place"), F.col("batter").alias("subject"), F.col("woba").alias("value"))


def sections(spark, d):
    """(report, section, team, place, subject, value): batters against the other team, its first arm and at the venue, hot and cold ones, meetings by season, news."""
    p, r = pitches(spark, d).where("batter IS NOT NULL"), rivals(spark, d)
    sides = _sides(r)
    parts = [_best(sides.join(_batting(p, (F.col("pitcher") % 10).alias("opponent")).where("pa >= 8"), ["team", "opponent"]), "vs_team", 5)]
    arms = p.groupBy((F.col("pitcher") % 10).alias("opponent"), "pitcher").agg(F.count(F.lit(1)).alias("n"))
    arms = arms.withColumn("rn", F.row_number().over(W.partitionBy("opponent").orderBy(F.desc("n"), "pitcher"))).where("rn = 1").select("opponent", "pitcher")
    parts.append(_best(sides.join(arms, "opponent").join(_batting(p, "pitcher").where("pa >= 3"), ["team", "pitcher"]), "vs_pitcher", 5))
    parts.append(_best(sides.join(_batting(p, (F.col("game_pk") % 10).alias("venue")).where("pa >= 5"), ["team", "venue"]), "venue", 5))
    last = p.agg(F.date_sub(F.max("game_date"), 14).alias("since"))  # one row
    late = _batting(p.join(F.broadcast(last)).where(F.col("game_date") > F.col("since"))).select("batter", F.col("woba").alias("of_late"), F.col("pa").alias("late_pa")).where("late_pa >= 5")
    form = _batting(p).join(late, "batter").withColumn("delta", F.round(F.col("of_late") - F.col("woba"), 3))
    ends = dedup.both_ends(form, ["team"], "delta", "batter", 3, 0.015, -0.015)
    ranked = ends.withColumn("place", F.row_number().over(W.partitionBy("team", "end").orderBy(F.abs("delta").desc(), "batter")))
    parts.append(sides.join(ranked, "team").select("report", F.col("end").alias("section"), "team", F.col("place").cast("long").alias("place"), F.col("batter").alias("subject"), F.col("delta").alias("value")))
    t = reshape.to_team_grain(games(spark, d)).where("is_home AND team_id % 10 <> opponent_id % 10")
    a, b = F.col("team_id") % 10, F.col("opponent_id") % 10
    yearly = t.groupBy((100 * F.least(a, b) + F.greatest(a, b)).alias("report"), F.least(a, b).alias("team"), "season").agg(F.sum(F.when(a < b, F.col("won")).otherwise(1 - F.col("won"))).cast("double").alias("value"))
    parts.append(yearly.select("report", F.lit("h2h_yearly").alias("section"), "team", F.row_number().over(W.partitionBy("report").orderBy(F.desc("season"))).cast("long").alias("place"), F.col("season").alias("subject"), "value"))
    words = table(spark, d, "nation").where("n_nationkey < 10").select(F.col("n_nationkey").cast("long").alias("team"), F.lower(F.substring("n_name", 1, 3)).alias("word"))
    docs = table(spark, d, "documents").select("doc_id", F.lower("text").alias("text"))
    hits = terms.met(docs, words, "doc_id", "text", "word").join(words, "word")
    newest = hits.withColumn("place", F.row_number().over(W.partitionBy("team").orderBy(F.desc("doc_id")))).where("place <= 4")
    parts.append(sides.join(newest, "team").select("report", F.lit("news").alias("section"), "team", F.col("place").cast("long").alias("place"), F.col("doc_id").alias("subject"), F.lit(None).cast("double").alias("value")))
    out = parts[0]
    for q in parts[1:]:
        out = out.unionByName(q)
    return out


def _best_sql(section: str, key: str, least: int, join: str, extra: str = "") -> str:
    own = "batter % 10 AS team, batter, " + key
    return f"""SELECT report, '{section}' AS section, team, place, batter AS subject, woba AS value FROM (SELECT side.report, b.*, row_number() OVER (PARTITION BY report, b.team ORDER BY woba DESC, batter) AS place FROM side {extra} JOIN
 (SELECT {own}, count(*) AS pa, round(sum({CASES}) / (1000.0 * count(*))::DOUBLE - 0.4, 3) AS woba FROM p WHERE batter IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) >= {least}) b ON b.team = side.team AND {join}) WHERE place <= 5"""


@register(
    f"""WITH {T}, {P}, {RIVALS}, side AS (SELECT report, home AS venue, home AS team, away AS opponent FROM r UNION ALL SELECT report, home, away, home FROM r),
 arm AS (SELECT pitcher % 10 AS opponent, pitcher FROM p WHERE batter IS NOT NULL GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY pitcher % 10 ORDER BY count(*) DESC, pitcher) = 1),
 allb AS (SELECT batter % 10 AS team, batter, round(sum({CASES}) / (1000.0 * count(*))::DOUBLE - 0.4, 3) AS woba FROM p WHERE batter IS NOT NULL GROUP BY 1, 2), lateb AS (SELECT batter, round(sum({CASES}) / (1000.0 * count(*))::DOUBLE - 0.4, 3) AS of_late FROM p WHERE batter IS NOT NULL AND game_date > (SELECT max(game_date) - 14 FROM p WHERE batter IS NOT NULL) GROUP BY 1 HAVING count(*) >= 5),
 f AS (SELECT team, batter, round(of_late - woba, 3) AS delta FROM allb JOIN lateb USING (batter)), fr AS (SELECT *, row_number() OVER (PARTITION BY team ORDER BY delta DESC, batter) AS u, row_number() OVER (PARTITION BY team ORDER BY delta, batter) AS v FROM f),
 fe AS (SELECT team, batter, delta, CASE WHEN u <= 3 AND delta >= 0.015 THEN 'hot' WHEN v <= 3 AND delta <= -0.015 THEN 'cold' END AS ends FROM fr), fp AS (SELECT *, row_number() OVER (PARTITION BY team, ends ORDER BY abs(delta) DESC, batter) AS place FROM fe WHERE ends IS NOT NULL),
 y AS (SELECT 100 * least(team_id % 10, opponent_id % 10) + greatest(team_id % 10, opponent_id % 10) AS report, least(team_id % 10, opponent_id % 10) AS team, season, sum(CASE WHEN team_id % 10 < opponent_id % 10 THEN won ELSE 1 - won END)::DOUBLE AS value FROM t WHERE is_home AND team_id % 10 <> opponent_id % 10 GROUP BY 1, 2, 3),
 n AS (SELECT n_nationkey AS team, doc_id FROM documents JOIN nation ON n_nationkey < 10 AND contains(lower(text), lower(substr(n_name, 1, 3))) QUALIFY row_number() OVER (PARTITION BY n_nationkey ORDER BY doc_id DESC) <= 4),
 al AS ({_best_sql("vs_team", "pitcher % 10 AS opponent", 8, "b.opponent = side.opponent")} UNION ALL {_best_sql("vs_pitcher", "pitcher", 3, "b.pitcher = arm.pitcher", "JOIN arm ON arm.opponent = side.opponent")} UNION ALL {_best_sql("venue", "game_pk % 10 AS venue", 5, "b.venue = side.venue")}
 UNION ALL SELECT report, ends, side.team, place, batter, delta FROM side JOIN fp ON fp.team = side.team UNION ALL SELECT report, 'h2h_yearly', team, row_number() OVER (PARTITION BY report ORDER BY season DESC), season, value FROM y
 UNION ALL SELECT report, 'news', side.team, row_number() OVER (PARTITION BY report, side.team ORDER BY doc_id DESC), doc_id, NULL FROM side JOIN n ON n.team = side.team)
 SELECT report::BIGINT AS report, section, team::BIGINT AS team, place::BIGINT AS place, subject::BIGINT AS subject, value::DOUBLE AS value FROM al"""
)
def m31_report_sections(spark, d):
    return sections(spark, d)


@register()
def m31_reports(spark, d):
    """Each report as one document of its sections, facts and watch list. A section is bounded, so a report is a short list."""
    found, r = sections(spark, d), rivals(spark, d)
    parts = [nested.section(found.where(F.col("section") == s), "report", s, ["team", "place", "subject", "value"], ["team", "place"]) for s in ("vs_team", "vs_pitcher", "venue", "hot", "cold", "h2h_yearly", "news")]
    parts.append(nested.section(n25_report_facts(spark, d), "report", "facts", ["fact_no", "text"], ["fact_no"]))
    parts.append(nested.section(n26_watch_list(spark, d), "report", "watch_list", ["fact_no", "text"], ["fact_no"]))
    return nested.assemble(r.select("report", "home", "away"), "report", parts, "document")


# --- P6, P8 --------------------------------------------------------------------------------
@register("SELECT o_orderkey, o_totalprice::DOUBLE AS o_totalprice, (o_totalprice > 100000)::INT AS big, substr(o_orderpriority, 1, 1)::DOUBLE AS priority FROM orders")
def p6_p8_numeric_features(spark, d):
    """Of a table with flags and texts the columns that a model can take: a flag as a number, a text of digits as a double, a text of letters not at all; two lists of them as one."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"), (F.col("o_totalprice") > 100000).alias("big"), F.substring("o_orderpriority", 1, 1).alias("priority"), "o_orderstatus")
    found = selection.numeric(o)
    return found.select(selection.feature_union(["o_orderkey", "big"], ["o_totalprice", "big", "priority", "o_orderstatus"], known=found.columns))
