"""Registered queries of unions, repairs, fills, role joins, sinks and quality reports."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formbook.functions import features as X
from formbook.functions import scalars as S
from formbook.operators import dedup, quality, upkeep
from formbook.operators import windows as win
from formbook.plans.catalog import ALL_T, MONTHS, G, P, T, games, pitches, r6, register, table, team_order, team_rows
from formbook.sources import sinks, versions
from formbook.sources.tables import between_dates, restricted

TODAY = "DATE '1998-12-31'"
SCORES = "game_pk long, game_date date, home_score long, away_score long"


def two_sources(spark, d):
    """Historical games, and the season's feed, whose columns come as text and which repeats a year of them."""
    g = games(spark, d)
    feed = g.where("season >= 1997").select("game_pk", F.col("game_date").cast("string").alias("game_date"), (F.col("home_score") + 1).cast("string").alias("home_score"), F.col("away_score").cast("string").alias("away_score"))
    return upkeep.union_aligned([g.where("season <= 1997"), feed], SCORES)


BOTH = f"WITH {G}, u AS (SELECT game_pk, game_date, home_score, away_score, 0 AS source_no FROM g WHERE season <= 1997 UNION ALL SELECT game_pk, game_date, home_score + 1, away_score, 1 FROM g WHERE season >= 1997)"


@register(f"{BOTH} SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY game_pk ORDER BY source_no DESC) = 1")
def u3_l2_union_keep_last(spark, d):
    return upkeep.keep_last(two_sources(spark, d), ["game_pk"])


@register(f"{BOTH} SELECT count(DISTINCT game_date)::BIGINT AS distinct_dates, min(game_date) AS earliest, max(game_date) AS latest, count(*)::BIGINT AS total, (SELECT count(*) FROM (SELECT game_pk FROM u GROUP BY 1 HAVING count(*) > 1))::BIGINT AS duplicates FROM u")
def k14_union_coverage(spark, d):
    return quality.union_coverage(two_sources(spark, d), "game_date", ["game_pk"])


@register(
    """SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS l_shipdate, l_partkey, l_suppkey, l_quantity FROM lineitem
 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate::DATE DESC, l_partkey, l_suppkey, l_quantity) = 1"""
)
def l3_duplicate_repair(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("l_shipdate"), "l_partkey", "l_suppkey", "l_quantity")
    return upkeep.repair_duplicates(rows, ["l_orderkey", "l_linenumber"], "l_shipdate")


@register(
    f"""WITH {G}, a AS (SELECT game_pk, home_score AS starter_id FROM g WHERE game_pk % 3 = 0), b AS (SELECT game_pk, away_score + 100 AS starter_id, venue_id AS park FROM g WHERE game_pk % 2 = 0)
 SELECT g.game_pk, coalesce(a.starter_id, b.starter_id, g.home_team_id) AS starter_id, b.park AS park FROM g LEFT JOIN a USING (game_pk) LEFT JOIN b USING (game_pk)"""
)
def j2_j10_n30_coalesced_sources(spark, d):
    """Lineup before prediction before the game's own value, column by column; every game stays."""
    g = games(spark, d)
    lineup = g.where("game_pk % 3 = 0").select("game_pk", F.col("home_score").alias("starter_id"))
    predicted = g.where("game_pk % 2 = 0").select("game_pk", (F.col("away_score") + 100).alias("starter_id"), F.col("venue_id").alias("park"))
    return upkeep.coalesced(g.select("game_pk", F.col("home_team_id").alias("starter_id")), [lineup, predicted], "game_pk")


@register(
    f"""WITH {G}, x AS (SELECT game_pk, CASE WHEN game_pk % 5 <> 0 THEN home_score / 2.0::DOUBLE END AS form, CASE WHEN game_pk % 7 <> 0 THEN away_score * 1.0::DOUBLE END AS runs, CASE WHEN game_pk % 3 <> 0 THEN venue_id * 1.5::DOUBLE END AS park FROM g)
 SELECT game_pk, coalesce(form, 0.5) AS form, coalesce(runs, (SELECT median(runs) FROM x)) AS runs, coalesce(park, (SELECT median(park) FROM x)) AS park FROM x"""
)
def n29_default_fill(spark, d):
    g = games(spark, d)
    gap = lambda k, c: F.when(F.col("game_pk") % k != 0, c)
    x = g.select("game_pk", gap(5, F.col("home_score") / 2.0).alias("form"), gap(7, F.col("away_score").cast("double")).alias("runs"), gap(3, F.col("venue_id") * 1.5).alias("park"))
    return upkeep.filled(x, {"form": 0.5}, ["runs", "park"])


@register(
    f"""WITH {G} SELECT 'rows_orders' AS check_name, 'warning' AS severity, (SELECT count(*) FROM orders)::BIGINT AS actual, (SELECT count(*) FROM orders) > 0 AS passed UNION ALL SELECT 'rows_events', 'warning', (SELECT count(*) FROM events)::BIGINT, (SELECT count(*) FROM events) > 0
 UNION ALL SELECT 'rows_late', 'warning', (SELECT count(*) FROM g WHERE season > 2100)::BIGINT, FALSE UNION ALL SELECT 'games_fresh', 'warning', date_diff('day', max(game_date), {TODAY})::BIGINT, date_diff('day', max(game_date), {TODAY}) <= 1 FROM g
 UNION ALL SELECT 'games_recent', 'error', date_diff('day', max(game_date), {TODAY})::BIGINT, date_diff('day', max(game_date), {TODAY}) <= 365 FROM g
 UNION ALL SELECT 'columns_orders', 'error', (2 - count(*))::BIGINT, count(*) = 2 FROM information_schema.columns WHERE table_name = 'orders' AND column_name IN ('o_orderkey', 'o_synced_at')
 UNION ALL SELECT 'surplus_l_orderkey_l_linenumber', 'error', (count(*) - count(DISTINCT (l_orderkey, l_linenumber)))::BIGINT, count(*) = count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
 UNION ALL SELECT 'innings_over_25', 'warning', count(*) FILTER (l_linenumber > 25)::BIGINT, count(*) FILTER (l_linenumber > 25) = 0 FROM lineitem"""
)
def k1_k3_k7_k11_k13_table_report(spark, d):
    orders, lines, g = table(spark, d, "orders"), table(spark, d, "lineitem"), games(spark, d)
    today = F.lit("1998-12-31").cast("date")
    return quality.report([
        quality.row_counts({"orders": orders, "events": table(spark, d, "events"), "late": g.where("season > 2100")}), quality.freshness(g, "game_date", today, 1, "games_fresh"), quality.freshness(g, "game_date", today, 365, "games_recent", "error"),
        quality.required_columns(orders, ["o_orderkey", "o_synced_at"], "orders"), quality.surplus(lines, ["l_orderkey", "l_linenumber"]), quality.measure(lines, {"innings_over_25": (F.count_if(F.col("l_linenumber") > 25), "warning")}),
    ])


@register(f"WITH {G} SELECT season, count(*)::BIGINT AS records FROM g GROUP BY 1")
def k7_records_per_year(spark, d):
    return games(spark, d).groupBy("season").agg(F.count(F.lit(1)).alias("records"))


# --- sinks --------------------------------------------------------------------
@register(
    f"""WITH {G}, o AS (SELECT game_pk, season % 3 AS part, home_score AS v FROM g WHERE game_pk % 2 = 0), n AS (SELECT game_pk, (season + 1) % 3 AS part, 99 AS v FROM g WHERE game_pk % 6 = 0)
 SELECT game_pk, part::BIGINT AS part, v::BIGINT AS v FROM o WHERE game_pk NOT IN (SELECT game_pk FROM n) UNION ALL SELECT game_pk, part, v FROM n"""
)
def s16_s17_upsert(spark, d):
    """Every third row moves to another partition and changes; then the same upsert again, which changes nothing. Each is one version of the table."""
    g, path = games(spark, d), sinks.shared_folder(spark, "s17")
    versions.create(g.where("game_pk % 2 = 0").select("game_pk", (F.col("season") % 3).alias("part"), F.col("home_score").cast("long").alias("v")), path, "part", ["game_pk"])
    new = g.where("game_pk % 6 = 0").select("game_pk", ((F.col("season") + 1) % 3).alias("part"), F.lit(99).cast("long").alias("v"))
    for _ in range(2):
        versions.upsert(new, path)
    return versions.read(spark, path).select("game_pk", F.col("part").cast("long").alias("part"), "v")


@register(f"WITH {G} SELECT game_pk, game_date, home_score FROM g WHERE game_date >= DATE '1996-06-01' AND game_date < DATE '1996-09-01' AND venue_id IN (SELECT venue_id FROM g GROUP BY 1 HAVING count(*) % 2 = 0)")
def s11_s12_bounded_scan(spark, d):
    g = games(spark, d)
    return restricted(between_dates(g, "game_date", "1996-06-01", "1996-09-01"), g.groupBy("venue_id").count().where("count % 2 = 0"), "venue_id").select("game_pk", "game_date", "home_score")


@register(
    f"""WITH {T}, days AS (SELECT unnest(generate_series(DATE '1996-03-01', DATE '1996-03-31', INTERVAL 1 DAY))::DATE AS day), x AS (SELECT team_id, game_date, avg(runs) AS runs FROM t GROUP BY 1, 2)
 SELECT day, count(*)::BIGINT AS teams, round(avg(runs), 6) AS runs FROM days JOIN x ON x.game_date = (SELECT max(y.game_date) FROM x y WHERE y.team_id = x.team_id AND y.game_date < day) GROUP BY 1"""
)
def s22_backfill_days(spark, d):
    """State of all teams for every day of a range in one job: each value holds until the team's next game."""
    days = team_rows(spark, d).groupBy("team_id", "game_date").agg(F.avg("runs").alias("runs"))
    after = F.lead("game_date").over(W.partitionBy("team_id").orderBy("game_date"))
    first, last = F.lit("1996-03-01").cast("date"), F.lit("1996-03-31").cast("date")
    held = days.withColumn("low", F.greatest(F.date_add("game_date", 1), first)).withColumn("high", F.least(F.coalesce(after, last), last)).where("low <= high")
    return held.withColumn("day", F.explode(F.sequence("low", "high"))).groupBy("day").agg(F.count(F.lit(1)).alias("teams"), r6(F.avg("runs"), "runs"))


# --- predicates and set operations ---------------------------------------------
@register(f"WITH {G} SELECT * EXCLUDE (venue_id, status_code) FROM g WHERE home_team_id = 7 OR away_team_id = 7")
def p2_p4_one_team(spark, d):
    return games(spark, d).where((F.col("home_team_id") == 7) | (F.col("away_team_id") == 7)).drop("venue_id", "status_code")


@register("SELECT source, count(*)::BIGINT AS n FROM documents WHERE lower(text) LIKE '%license%' OR lower(text) LIKE '%copyright%' OR lower(text) LIKE '%data%' GROUP BY 1")
def p3_keyword_filter(spark, d):
    low = F.lower("text")
    return table(spark, d, "documents").where(low.contains("license") | low.contains("copyright") | low.contains("data")).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@register("WITH k AS (SELECT n_nationkey, lower(substr(n_name, 1, 3)) AS word FROM nation) SELECT n_nationkey, word, count(*)::BIGINT AS articles FROM documents JOIN k ON contains(lower(text), word) GROUP BY 1, 2")
def j8_keyword_join(spark, d):
    """Texts against a keyword table: one scan of the texts, each told its words at once; the list of keywords is a table of 25 rows."""
    words = table(spark, d, "nation").select(F.array_agg(F.struct("n_nationkey", F.lower(F.substring("n_name", 1, 3)).alias("word"))).alias("words"))
    met = table(spark, d, "documents").select(F.lower("text").alias("low")).join(F.broadcast(words))  # one row
    return met.select(F.explode(F.filter("words", lambda w: F.col("low").contains(w["word"]))).alias("w")).groupBy("w.n_nationkey", "w.word").agg(F.count(F.lit(1)).alias("articles"))


@register(f"WITH {P}, b AS (SELECT batter, [k IN ('walk', 'single') FOR k IN list(events)] AS xs FROM p WHERE batter IS NOT NULL GROUP BY 1), e AS (SELECT batter, unnest(xs) AS x FROM b) SELECT batter, count(*)::BIGINT AS n, sum(x::INT)::BIGINT AS reached FROM e GROUP BY 1")
def u8_unnest_repeated(spark, d):
    b = pitches(spark, d).where("batter IS NOT NULL").groupBy("batter", "game_date").agg(F.collect_list("events").alias("xs"))  # a batter's day
    return b.select("batter", F.explode("xs").alias("x")).groupBy("batter").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("x").isin("walk", "single")).alias("reached"))


@register(f"WITH {P}, s AS (SELECT pitcher, batter, round(avg(release_speed), 6) AS v FROM p GROUP BY 1, 2) SELECT pitcher, batter, v, row_number() OVER (PARTITION BY pitcher ORDER BY abs(v - 50) DESC, batter NULLS LAST)::BIGINT AS place FROM s QUALIFY place <= 5")
def l5_l8_furthest_from_mean(spark, d):
    s = pitches(spark, d).groupBy("pitcher", "batter").agg(r6(F.avg("release_speed"), "v"))
    return dedup.top_k(s, ["pitcher"], [F.abs(F.col("v") - 50).desc(), F.asc_nulls_last("batter")], 5, "place").withColumn("place", F.col("place").cast("long"))


@register(
    """WITH s AS (SELECT p_brand, 100.0 * avg((p_size > 25)::INT) AS a, CASE WHEN p_brand NOT LIKE '%1' THEN 100.0 * avg((p_retailprice > 1000)::INT) END AS e, CASE WHEN p_brand NOT LIKE '%2' THEN 100.0 * avg((p_size < 10)::INT) END AS c FROM part GROUP BY 1)
 SELECT p_brand, round(0.40 * coalesce(a, 50) + 0.35 * coalesce(e, 50) + 0.25 * coalesce(c, 50), 6) AS composite FROM s"""
)
def l9_composite_ranking(spark, d):
    share = lambda c: 100.0 * F.avg(c.cast("int"))
    s = table(spark, d, "part").groupBy("p_brand").agg(share(F.col("p_size") > 25).alias("anticipation"), share(F.col("p_retailprice") > 1000).alias("execution"), share(F.col("p_size") < 10).alias("deterrence"))
    s = s.withColumns({"execution": F.when(~F.col("p_brand").endswith("1"), F.col("execution")), "deterrence": F.when(~F.col("p_brand").endswith("2"), F.col("deterrence"))})
    score = sum((w * F.coalesce(F.col(c), F.lit(50.0)) for c, w in X.RANKING_WEIGHTS.items()), F.lit(0.0))
    return s.select("p_brand", r6(score, "composite")).orderBy(F.desc("composite"), "p_brand")


# --- joins --------------------------------------------------------------------
@register(
    f"""WITH {T}, s AS (SELECT team_id, season, avg(runs) AS r FROM t GROUP BY 1, 2) SELECT g.game_pk, round(h.r, 6) AS home_runs, round(a.r, 6) AS away_runs, round(h.r - a.r, 6) AS difference
 FROM g JOIN s h ON h.team_id = g.home_team_id AND h.season = g.season JOIN s a ON a.team_id = g.away_team_id AND a.season = g.season"""
)
def j3_both_roles(spark, d):
    s = team_rows(spark, d).groupBy("team_id", "season").agg(F.avg("runs").alias("r"))
    role = lambda side: s.select(F.col("team_id").alias(f"{side}_team_id"), "season", F.col("r").alias(f"{side}_r"))
    met = games(spark, d).join(role("home"), ["home_team_id", "season"]).join(role("away"), ["away_team_id", "season"])
    return met.select("game_pk", r6(F.col("home_r"), "home_runs"), r6(F.col("away_r"), "away_runs"), r6(F.col("home_r") - F.col("away_r"), "difference"))


@register(f"WITH {T} SELECT x.game_pk, x.team_id, y.team_id AS other_team, y.runs AS other_runs FROM t x JOIN t y ON x.game_pk = y.game_pk AND x.team_id <> y.team_id")
def j4_other_team(spark, d):
    t = team_rows(spark, d).select("game_pk", "team_id", "runs")
    x, y = t.alias("x"), t.alias("y")
    met = x.join(y, (F.col("x.game_pk") == F.col("y.game_pk")) & (F.col("x.team_id") != F.col("y.team_id")))
    return met.select("x.game_pk", "x.team_id", F.col("y.team_id").alias("other_team"), F.col("y.runs").alias("other_runs"))


@register(
    f"""WITH {P}, r AS (SELECT batter, pitcher % 10 AS team_id FROM p WHERE batter IS NOT NULL AND batter % 4 <> 0 QUALIFY row_number() OVER (PARTITION BY batter ORDER BY game_date DESC, pitch_id DESC) = 1),
 s AS (SELECT batter, count(*)::BIGINT AS pa FROM p WHERE batter IS NOT NULL GROUP BY 1) SELECT batter, team_id, pa FROM s JOIN r USING (batter)"""
)
def j16_current_roster(spark, d):
    """The team of a player's latest snapshot; players of no roster (every fourth stands for a pitcher) go."""
    p = pitches(spark, d).where("batter IS NOT NULL")
    roster = dedup.latest_per_key(p.where("batter % 4 <> 0"), ["batter"], [F.desc("game_date"), F.desc("pitch_id")]).select("batter", (F.col("pitcher") % 10).alias("team_id"))
    return p.groupBy("batter").agg(F.count(F.lit(1)).alias("pa")).join(roster, "batter").select("batter", "team_id", "pa")


@register("WITH m AS (SELECT upper(substr(n_name, 1, 3)) AS code, min(n_nationkey)::BIGINT AS id FROM nation GROUP BY 1), s AS (SELECT s_suppkey, upper(substr(n_name, 1, 3)) AS code FROM supplier JOIN nation ON s_nationkey = n_nationkey) SELECT s_suppkey, code, id FROM s LEFT JOIN m USING (code)")
def j18_code_map(spark, d):
    n = table(spark, d, "nation").withColumn("code", F.upper(F.substring("n_name", 1, 3)))
    s = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "code")
    return s.join(n.groupBy("code").agg(F.min("n_nationkey").cast("long").alias("id")), "code", "left").select("s_suppkey", "code", "id")


@register(
    f"""WITH {P}, v AS (SELECT pitcher, game_date, sum(release_speed) AS s, count(*) AS n FROM p GROUP BY 1, 2), h AS (SELECT pitcher, game_date, sum(s) OVER w / sum(n) OVER w AS velo FROM v WINDOW w AS (PARTITION BY pitcher ORDER BY game_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 c AS (SELECT game_date, game_pk, inning_topbot, pitcher FROM p GROUP BY 1, 2, 3, 4 QUALIFY row_number() OVER (PARTITION BY game_date, game_pk, inning_topbot ORDER BY count(*) DESC, pitcher) = 1), x AS (SELECT c.*, velo FROM c LEFT JOIN h USING (pitcher, game_date))
 SELECT game_date, game_pk, max(pitcher) FILTER (inning_topbot = 'Top') AS home_starter, max(pitcher) FILTER (inning_topbot = 'Bot') AS away_starter, round(max(velo) FILTER (inning_topbot = 'Top') - max(velo) FILTER (inning_topbot = 'Bot'), 6) AS velo_difference FROM x GROUP BY 1, 2"""
)
def j20_starters_before(spark, d):
    """Top pitcher of each side by pitches, with his speed over earlier days alone, both sides in one row."""
    p = pitches(spark, d)
    before = win.before(W.partitionBy("pitcher").orderBy("game_date"))
    v = p.groupBy("pitcher", "game_date").agg(F.sum("release_speed").alias("s"), F.count(F.lit(1)).alias("n")).select("pitcher", "game_date", (F.sum("s").over(before) / F.sum("n").over(before)).alias("velo"))
    c = p.groupBy("game_date", "game_pk", "inning_topbot", "pitcher").agg(F.count(F.lit(1)).alias("n"))
    x = dedup.latest_per_key(c, ["game_date", "game_pk", "inning_topbot"], [F.desc("n"), F.asc("pitcher")]).join(v, ["pitcher", "game_date"], "left")
    of = lambda side, col: F.max(F.when(F.col("inning_topbot") == side, F.col(col)))
    return x.groupBy("game_date", "game_pk").agg(of("Top", "pitcher").alias("home_starter"), of("Bot", "pitcher").alias("away_starter"), r6(of("Top", "velo") - of("Bot", "velo"), "velo_difference"))


@register(
    f"""WITH {G}, dim AS (SELECT n_nationkey AS team_id, n_name AS name FROM nation), weather AS (SELECT game_date, min(home_score) AS wind FROM g WHERE day(game_date) % 2 = 0 GROUP BY 1)
 SELECT game_pk, h.name AS home_name, a.name AS away_name, s_name AS stadium, wind FROM g JOIN dim h ON h.team_id = home_team_id JOIN dim a ON a.team_id = away_team_id JOIN supplier ON s_suppkey = venue_id + 1 LEFT JOIN weather USING (game_date)"""
)
def j17_j21_star_with_weather(spark, d):
    """One dimension in two roles, a stadium, and weather where it is known; games of teams outside the dimension go, as inner joins have it."""
    dim = table(spark, d, "nation")
    role = lambda side: dim.select(F.col("n_nationkey").cast("long").alias(f"{side}_team_id"), F.col("n_name").alias(f"{side}_name"))
    g = games(spark, d)
    weather = g.where(F.dayofmonth("game_date") % 2 == 0).groupBy("game_date").agg(F.min("home_score").alias("wind"))
    stadium = table(spark, d, "supplier").select((F.col("s_suppkey") - 1).alias("venue_id"), F.col("s_name").alias("stadium"))
    return g.join(role("home"), "home_team_id").join(role("away"), "away_team_id").join(stadium, "venue_id").join(weather, "game_date", "left").select("game_pk", "home_name", "away_name", "stadium", "wind")


# --- dimensions ----------------------------------------------------------------
@register(
    f"""WITH {G}, {MONTHS}, o AS (SELECT team_id, grade FROM m QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY snapshot_date) = 1), n AS (SELECT team_id, grade FROM m WHERE team_id % 2 = 0 QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY snapshot_date DESC) = 1)
 SELECT team_id, coalesce(n.grade, o.grade) AS grade FROM o LEFT JOIN n USING (team_id)"""
)
def z7_type_1(spark, d):
    m = months(spark, d)
    old = dedup.latest_per_key(m, ["team_id"], [F.asc("snapshot_date")]).select("team_id", "grade")
    return upkeep.overwritten(old, dedup.latest_per_key(m.where("team_id % 2 = 0"), ["team_id"], [F.desc("snapshot_date")]).select("team_id", "grade"), "team_id")


def months(spark, d):
    return games(spark, d).groupBy(F.col("home_team_id").alias("team_id"), F.trunc("game_date", "month").alias("snapshot_date")).agg((F.sum("home_score") % 3).alias("grade"))


@register(
    f"""WITH {G}, {MONTHS}, o AS (SELECT team_id, grade, snapshot_date FROM m QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY snapshot_date) = 1), n AS (SELECT team_id, grade AS g2 FROM m QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY snapshot_date DESC) = 1),
 j AS (SELECT * FROM o JOIN n USING (team_id)) SELECT team_id, grade, snapshot_date AS valid_from, CASE WHEN grade <> g2 THEN DATE '1998-12-30' END AS valid_to, grade = g2 AS is_current FROM j UNION ALL SELECT team_id, g2, DATE '1998-12-31', NULL, TRUE FROM j WHERE grade <> g2"""
)
def z7_type_2_close_and_insert(spark, d):
    m = months(spark, d)
    old = dedup.latest_per_key(m, ["team_id"], [F.asc("snapshot_date")]).select("team_id", "grade", F.col("snapshot_date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
    return upkeep.versioned(old, dedup.latest_per_key(m, ["team_id"], [F.desc("snapshot_date")]).select("team_id", "grade"), "team_id", ["grade"], F.lit("1998-12-31").cast("date"))


@register(
    f"""WITH {G}, {MONTHS}, l AS (SELECT *, lag(grade) OVER (PARTITION BY team_id ORDER BY snapshot_date) AS was FROM m), c AS (SELECT * FROM l WHERE was IS NULL OR was <> grade)
 SELECT team_id, grade, was AS previous_grade, snapshot_date AS changed_on FROM c QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY snapshot_date DESC) = 1"""
)
def z7_type_3(spark, d):
    return upkeep.with_previous(months(spark, d), "team_id", "snapshot_date", "grade")


@register(
    f"""WITH {G} SELECT DISTINCT game_date AS day, year(game_date)::INT AS year, monthname(game_date) AS month_name, dayname(game_date) AS day_name, (isodow(game_date) >= 6) AS is_weekend, month(game_date) <= 4 AS is_early, month(game_date) >= 9 AS is_late FROM g"""
)
def m34_n20_dim_dates(spark, d):
    x = F.col("day")
    days = games(spark, d).select(F.col("game_date").alias("day")).distinct()
    return days.select("day", F.year(x).alias("year"), F.date_format(x, "MMMM").alias("month_name"), F.date_format(x, "EEEE").alias("day_name"), (F.weekday(x) >= 5).alias("is_weekend"), (F.month(x) <= 4).alias("is_early"), (F.month(x) >= 9).alias("is_late"))


@register(f"WITH {G} SELECT game_pk, home_score + away_score AS total, abs(home_score - away_score) AS margin, CASE WHEN home_score > away_score THEN home_team_id WHEN away_score > home_score THEN away_team_id END AS winner FROM g")
def m34_fact_games(spark, d):
    h, a = F.col("home_score"), F.col("away_score")
    return games(spark, d).select("game_pk", (h + a).alias("total"), F.abs(h - a).alias("margin"), F.when(h > a, F.col("home_team_id")).when(a > h, F.col("away_team_id")).alias("winner"))


# --- windows that were partial ---------------------------------------------------
@register(
    f"""WITH {G}, m AS (SELECT *, least(home_team_id, away_team_id) AS a, greatest(home_team_id, away_team_id) AS b, CASE WHEN home_score > away_score THEN home_team_id WHEN home_score < away_score THEN away_team_id END AS winner FROM g)
 SELECT game_pk, count(*) OVER s::BIGINT AS met_season, coalesce(sum((winner = a)::INT) OVER s, 0)::BIGINT AS won_season, count(*) OVER y::BIGINT AS met_3_years, coalesce(sum((winner = a)::INT) OVER y, 0)::BIGINT AS won_3_years, round(avg((winner = a)::INT) OVER l, 6) AS rate_57 FROM m
 WINDOW s AS (PARTITION BY a, b, season ORDER BY game_date, game_pk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), y AS (PARTITION BY a, b ORDER BY game_date RANGE BETWEEN INTERVAL 1095 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), l AS (PARTITION BY a, b ORDER BY game_date, game_pk ROWS BETWEEN 57 PRECEDING AND 1 PRECEDING)"""
)
def w21_head_to_head_spans(spark, d):
    h, a = F.col("home_score"), F.col("away_score")
    m = games(spark, d).withColumns({"a": F.least("home_team_id", "away_team_id"), "b": F.greatest("home_team_id", "away_team_id"), "winner": F.when(h > a, F.col("home_team_id")).when(h < a, F.col("away_team_id"))})
    won = (F.col("winner") == F.col("a")).cast("int")
    season, last = win.before(W.partitionBy("a", "b", "season").orderBy("game_date", "game_pk")), win.before(W.partitionBy("a", "b").orderBy("game_date", "game_pk"), 57)
    years = W.partitionBy("a", "b").orderBy(F.unix_date("game_date")).rangeBetween(-1095, -1)
    total = lambda w: F.coalesce(F.sum(won).over(w), F.lit(0)).cast("long")
    return m.select("game_pk", F.count(F.lit(1)).over(season).alias("met_season"), total(season).alias("won_season"), F.count(F.lit(1)).over(years).alias("met_3_years"), total(years).alias("won_3_years"), r6(F.avg(won).over(last), "rate_57"))


@register(
    f"""WITH {P}, s AS (SELECT pitcher, game_date, avg(release_speed) AS velo FROM p GROUP BY 1, 2), m AS (SELECT *, max(game_date) OVER (PARTITION BY pitcher) AS last FROM s), r AS (SELECT *, row_number() OVER (PARTITION BY pitcher ORDER BY game_date DESC) AS rn FROM m WHERE game_date > last - 30)
 SELECT pitcher, round(avg(velo) FILTER (rn <= 2) - avg(velo) FILTER (rn > 2), 6) AS absolute, round((avg(velo) FILTER (rn <= 2) - avg(velo) FILTER (rn > 2)) / avg(velo) FILTER (rn > 2), 6) AS relative FROM r GROUP BY 1"""
)
def w18_velocity_trend_30_days(spark, d):
    s = pitches(spark, d).groupBy("pitcher", "game_date").agg(F.avg("release_speed").alias("velo"))
    s = s.withColumn("last", F.max("game_date").over(W.partitionBy("pitcher"))).where(F.col("game_date") > F.date_sub("last", 30))
    r = s.withColumn("rn", F.row_number().over(W.partitionBy("pitcher").orderBy(F.desc("game_date"))))
    new, rest = F.avg(F.when(F.col("rn") <= 2, F.col("velo"))), F.avg(F.when(F.col("rn") > 2, F.col("velo")))
    return r.groupBy("pitcher").agg(r6(new - rest, "absolute"), r6((new - rest) / rest, "relative"))


@register(f"WITH {P} SELECT pitcher, " + ", ".join(f"round(avg((events = '{e}')::INT), 6) AS {e}" for e in ("walk", "single", "strikeout", "field_out", "home_run")) + " FROM p GROUP BY 1")
def a16_mix(spark, d):
    kinds = ("walk", "single", "strikeout", "field_out", "home_run")
    return pitches(spark, d).groupBy("pitcher").agg(*[r6(F.avg((F.col("events") == e).cast("int")), e) for e in kinds])


@register(f"WITH {T}, o AS (SELECT *, lag(game_date) OVER ({ALL_T}) AS last FROM t) SELECT team_id, min(date_diff('day', last, game_date))::BIGINT AS least_gap, max(date_diff('day', last, game_date))::BIGINT AS most_gap FROM o GROUP BY 1")
def a27_gaps(spark, d):
    gap = F.datediff("game_date", F.lag("game_date").over(team_order()))
    return team_rows(spark, d).withColumn("gap", gap).groupBy("team_id").agg(F.min("gap").cast("long").alias("least_gap"), F.max("gap").cast("long").alias("most_gap"))


@register(
    """WITH x AS (SELECT toxic::BIGINT AS y, (doc_id * 37 % 100 >= 50)::BIGINT AS f FROM labels), c AS (SELECT sum(y * f) AS tp, sum((1 - y) * f) AS fp, sum(y * (1 - f)) AS fn, sum((1 - y) * (1 - f)) AS tn FROM x)
 SELECT tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn, tn::BIGINT AS tn, round(tp / nullif(tp + fp, 0), 6)::DOUBLE AS precision, round(tp / nullif(tp + fn, 0), 6)::DOUBLE AS recall FROM c"""
)
def m23_confusion(spark, d):
    x = table(spark, d, "labels").select(F.col("toxic").cast("long").alias("y"), (F.col("doc_id") * 37 % 100 >= 50).cast("long").alias("f"))
    y, f = F.col("y"), F.col("f")
    c = x.agg(F.sum(y * f).alias("tp"), F.sum((1 - y) * f).alias("fp"), F.sum(y * (1 - f)).alias("fn"), F.sum((1 - y) * (1 - f)).alias("tn"))
    return c.select("*", r6(S.ratio(F.col("tp"), F.col("tp") + F.col("fp")), "precision"), r6(S.ratio(F.col("tp"), F.col("tp") + F.col("fn")), "recall"))
