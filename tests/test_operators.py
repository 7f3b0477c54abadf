"""Operators against hand-made rows, plain loops and DuckDB."""

import datetime as dt
import os

import duckdb
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formbook.functions import scalars
from formbook.operators import asof, dedup, elo, quality, reshape, windows
from formbook.plans import catalog
from formbook.sources import sinks, tables

SF = "/root/testdata/sf0.001"
GAMES = "game_pk long, game_date date, season long, home_team_id long, away_team_id long, home_score long, away_score long"


def day(n):
    return dt.date(2024, 4, 1) + dt.timedelta(n)


def some_games(spark, n=60):
    rows = [(i, day(i // 3), 2023 + i // 40, i % 5, (i + 1 + i % 4) % 5, i * 7 % 11, i * 5 % 11) for i in range(n)]
    return rows, spark.createDataFrame(rows, GAMES)


@pytest.mark.parametrize("name", ["form_table", "w4_w5_consistency_slope", "w19_time_range_mean", "a4_a5_lineup_rates", "a18_grouping_sets", "j5_j6_as_of", "m23_metrics"])
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("orders", "events", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    con.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in con.description]
    got = catalog.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    plain = lambda rows: sorted((tuple(round(v, 5) if isinstance(v, float) else v for v in r) for r in rows), key=str)
    assert plain(got.select(names).collect()) == plain(con.fetchall())


def test_elo_is_a_plain_loop(spark):
    rows, frame = some_games(spark)
    rating, season, want = {}, None, {}
    for pk, _, s, h, a, hs, as_ in sorted(rows, key=lambda r: (r[1], r[0])):
        if season not in (None, s):
            rating = {t: 1500 + 0.6 * (r - 1500) for t, r in rating.items()}
        season = s
        x, y = rating.get(h, 1500.0), rating.get(a, 1500.0)
        p = 1 / (1 + 10 ** ((y - x - 80) / 400))
        want[pk] = (x, y, p)
        rating[h], rating[a] = x + 15 * ((hs > as_) - p), y - 15 * ((hs > as_) - p)
    for r in elo.replay(frame.repartition(5)).collect():
        assert (r.home_elo, r.away_elo, r.home_probability) == pytest.approx(want[r.game_pk])


def test_features_do_not_leak(spark):
    rows, frame = some_games(spark)
    edited = frame.withColumn("home_score", F.when(F.col("game_pk") >= 45, 99).otherwise(F.col("home_score")))
    order = W.partitionBy("team_id").orderBy("game_date", "game_pk")

    def features(g):
        t = reshape.to_team_grain(g).withColumn("m", windows.rolling("runs", order, 5)).withColumn("e", windows.ewm("won", order))
        t = windows.streaks(t, "won", ["team_id"], ["game_date", "game_pk"])
        return {(r.game_pk, r.team_id): (r.m, r.e, r.streak) for r in t.where("game_pk <= 45").collect()}

    assert features(frame) == features(edited.repartition(3))


def test_form_plan_is_lean(spark):
    plan = catalog.form_table(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange hashpartitioning") <= 2


def test_as_of_and_scd2(spark):
    left = spark.createDataFrame([(1, "a", day(5)), (2, "a", day(2)), (3, "b", day(9))], "id int, k string, d date")
    right = spark.createDataFrame([("a", day(2), 10), ("a", day(5), 20), ("c", day(0), 1)], "k string, s date, v int")
    got = lambda strict: {r.id: r.v for r in asof.as_of(left, right, ["k"], "d", "s", ["v"], strict).collect()}
    assert got(False) == {1: 20, 2: 10, 3: None} and got(True) == {1: 10, 2: None, 3: None}
    snaps = spark.createDataFrame([("x", day(i), v) for i, v in enumerate([1, 1, 2, 2, 1])], "k string, d date, v int")
    versions = sorted((r.valid_from, r.valid_to, r.v, r.is_current) for r in asof.scd2(snaps, "k", "d", ["v"]).collect())
    assert versions == [(day(0), day(1), 1, False), (day(2), day(3), 2, False), (day(4), None, 1, True)]


def test_upsert_twice_is_once(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite_partitions(spark.createDataFrame([(1, "p", 1.0), (2, "p", 2.0), (3, "q", 3.0)], "k int, part string, v double"), path, "part")
    new = spark.createDataFrame([(2, "p", 9.0), (4, "q", 4.0)], "k int, part string, v double")
    for _ in range(2):
        sinks.upsert(new, path, ["k"], "part")
        assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [(1, 1.0), (2, 9.0), (3, 3.0), (4, 4.0)]


def test_scalars(spark):
    one = spark.range(1).select(
        scalars.innings(F.lit("123.1")).alias("i"), scalars.pythagorean(F.lit(0), F.lit(0)).alias("p"), scalars.confidence_tier(F.lit(0.3)).alias("t"),
        scalars.weighted_present([(F.lit(None).cast("double"), 0.5), (F.lit(0.03), 0.5)], 0.06).alias("w"), scalars.shrunken(F.lit(0.4), F.lit(3), 0.32).alias("s"),
    ).first()
    assert one.i == pytest.approx(123 + 1 / 3) and one.p == 0.5 and one.t == "high" and one.w == pytest.approx(0.5) and one.s is None


def test_schedule_and_boxscore(spark):
    body = '{"dates":[{"games":[{"gamePk":1,"gameDate":"2026-04-01T23:05:00Z","status":{"abstractGameState":"Final"},"teams":{"home":{"team":{"id":3}},"away":{"team":{"id":4}}}},{"gamePk":2,"status":{"abstractGameState":"Preview"},"teams":{"home":{"team":{"id":5}}}}]}]}'
    raw = spark.createDataFrame([(body,), (None,)], "body string")
    assert [r.game_pk for r in tables.schedule_games(raw).collect()] == [2]
    assert sorted(r.game_pk for r in tables.schedule_games(raw, include_final=True).collect()) == [1, 2]
    box = '{"game_pk":7,"players":{"ID1":{"person":{"id":1,"fullName":"A B"},"battingOrder":"100"},"ID2":{"person":{"id":2},"battingOrder":"301"},"ID3":{"person":{"id":3},"probable":true},"ID4":{"person":{"id":4}}}}'
    got = sorted((r.player_id, r.batting_order, r.is_starter, r.is_probable_pitcher) for r in tables.boxscore_lineups(spark.createDataFrame([(box,)], "body string")).collect())
    assert got == [(1, 1, True, False), (2, 3, False, False), (3, None, False, True)]


def test_quality_exit_codes(spark):
    _, frame = some_games(spark, 6)
    check = lambda limit, severity: quality.measure(frame, {"high": (F.count_if(F.col("home_score") > limit), severity)})
    assert [quality.exit_code(check(*x)) for x in ((99, "error"), (1, "warning"), (1, "error"))] == [0, 2, 1]


def test_latest_and_empty(spark):
    _, frame = some_games(spark)
    latest = dedup.latest_per_key(frame, ["home_team_id"], [F.desc("game_date"), F.desc("game_pk")]).collect()
    assert sorted(r.game_pk for r in latest) == [55, 56, 57, 58, 59]
    assert reshape.to_team_grain(frame.limit(0)).count() == elo.replay(frame.limit(0)).count() == 0


def test_entry_without_training_data():
    import __spark_entry__ as entry

    assert set(catalog.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    if not os.path.exists(os.path.join(os.path.dirname(entry.__file__), "corpus_pipeline.py")):
        assert not any(n.startswith("op") for n in entry.queries())
