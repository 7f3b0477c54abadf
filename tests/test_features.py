"""Feature tables, splits, lineups, ratings, models, feeds and streams against plain loops, hand-made rows and DuckDB."""

import datetime as dt
import json
import os

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from formbook.operators import elo, lineup, models, splits
from formbook.plans import catalog
from formbook.sources import feeds
from formbook.streaming import pitches as live

SF = "/root/testdata/sf0.001"
GAMES = "game_pk long, game_date date, season long, home_team_id long, away_team_id long, home_score long, away_score long"


def day(n):
    return dt.date(2024, 4, 1) + dt.timedelta(n)


def plain(rows):
    return sorted((tuple(str(round(v, 5) + 0.0) if isinstance(v, float) else str(v) for v in r) for r in rows))


@pytest.mark.parametrize(
    "name",
    ["a20_roster_average", "a29_recent_form", "w20_week_load", "w20_closer_rest", "m8_pitcher_at_venue", "m13_m14_ordered_folds", "m18_m19_blend_weights", "m28_availability", "m30_m31_report", "m36_best_confident", "z6_carry_forward", "t1_stream_dedup", "t3_sliding_week", "t4_appearances", "t6_stream_upsert", "t7_stream_static"],
)
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("orders", "events", "labels", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    con.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in con.description]
    got = catalog.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert plain(got.select(names).collect()) == plain(con.fetchall())


def test_approximate_distinct_is_near(spark):
    for r in catalog.queries()["a12_approximate_distinct"](spark, SF).collect():
        assert abs(r.about - r.exact) <= max(2, 0.1 * r.exact)


def test_state_of_ratings_is_the_replay(spark):
    rows = [(i, day(i), 2023 + i // 30, i % 5, (i + 1 + i % 4) % 5, i * 7 % 11, i * 5 % 11) for i in range(60)]
    g = spark.createDataFrame(rows, GAMES)
    whole = {r.team_id: r.rating for r in elo.ratings_after(g).collect()}
    first = elo.ratings_after(g.where("season = 2023"))
    then = {r.team_id: (r.rating, r.games) for r in elo.ratings_after(g.where("season = 2024"), elo.seed(first)).collect()}
    assert {t: r for t, (r, _) in then.items()} == pytest.approx(whole) and sum(n for _, n in then.values()) == 60
    assert elo.ratings_after(g.limit(0), first).count() == 5


def test_live_ratings_are_the_replay_with_late_games_in_place(spark, tmp_path):
    rows = [(i, day(i // 3), 2023 + i // 40, i % 5, (i + 1 + i % 4) % 5, i * 7 % 11, i * 5 % 11) for i in range(60)]
    path, late = str(tmp_path / "games"), [(99, day(1), 2023, 1, 2, 3, 4)]
    for part in (rows[:30], rows[30:], late):
        spark.createDataFrame(part, GAMES).coalesce(1).write.mode("append").parquet(path)
    found = live.drain(live.live_ratings(live.source(spark, path, files_per_trigger=1)))
    flat = lambda rated: {(r.game_pk, c): r[c] for r in rated for c in ("home_elo", "away_elo")}
    flatly = lambda games: flat(elo.replay(spark.createDataFrame(games, GAMES)).collect())
    assert flat(live.last_revisions(found).collect()) == pytest.approx(flatly(rows + late))
    assert flat(live.last_revisions(found.where("revision <= 2")).collect()) == pytest.approx(flatly(rows))


def test_lineup_projection(spark):
    kind = "team_id int, game_date date, game_pk int, player_id int, batting_order int, target_date date"
    usual = [(1, day(d), d, slot * 10, slot, day(5)) for d in (3, 4) for slot in range(1, 10) if (d, slot) != (4, 9)]
    extra = [(1, day(4), 4, 10, 9, day(5)), (1, day(-40), 1, 77, 1, day(5)), (1, day(5), 9, 88, 1, day(5)), (1, day(4), 4, None, 2, day(5)), (2, day(4), 5, 10, 1, day(5))]
    got = lineup.project(spark.createDataFrame(usual + extra, kind), ["team_id"]).collect()
    assert sorted((r.batting_order, r.player_id) for r in got) == [(s, s * 10) for s in range(1, 10)]
    assert lineup.project(spark.createDataFrame([], kind), ["team_id"]).count() == 0
    games = spark.createDataFrame([(1,), (2,)], "game_pk int")
    known = spark.createDataFrame([(1, s) for s in range(1, 9)] + [(2, 1), (2, None)], "game_pk int, batting_order int")
    assert [r.game_pk for r in lineup.only_unknown(games, known, ["game_pk"]).collect()] == [2]
    recent = spark.createDataFrame([(1, p) for p in range(9)] + [(2, p) for p in range(9)], "team_id int, player_id int")
    current = spark.createDataFrame([(1, p) for p in range(6)] + [(2, 0)], "team_id int, player_id int")
    kept = lineup.current_candidates(recent, current, ["team_id"])
    assert {r.team_id: r["count"] for r in kept.groupBy("team_id").count().collect()} == {1: 6, 2: 9}


def test_numbered_with_ties_and_nulls(spark):
    df = spark.createDataFrame([(3, day(1)), (1, day(1)), (2, None), (4, day(0))], "id int, d date")
    assert [r.id for r in splits.numbered(df, "d", "id").orderBy("i").collect()] == [2, 4, 1, 3]
    found = {r.feature: (r.coverage, r.missing) for r in splits.availability(df, ["d", "none"]).collect()}
    assert found == {"d": (0.75, False), "none": (0.0, True)}


@pytest.fixture(scope="module")
def outcomes(spark):
    rows = [(i, 2020 + i // 100, float(i * 7919 % 101), None if i % 17 == 0 else float(i * 31 % 13), int((i * 7919 % 101) > 50)) for i in range(500)]
    return spark.createDataFrame(rows, "game_pk long, season long, good double, noise double, home_won int").repartition(2).cache()


def test_models_learn_from_the_past_alone(spark, outcomes):
    unseen = models.walk_forward(outcomes, ["good", "noise"]).select("game_pk", "season", "home_won", "p")
    assert {r.season for r in unseen.select("season").distinct().collect()} == {2023, 2024}
    assert models.metrics(unseen).first().accuracy > 0.9
    edited = outcomes.withColumn("home_won", F.when(F.col("season") == 2024, 1 - F.col("home_won")).otherwise(F.col("home_won")))
    p = lambda df: {r.game_pk: round(r.p, 9) for r in models.walk_forward(df, ["good"]).collect()}
    assert p(outcomes) == p(edited)


def test_ablation_selection_calibration(spark, outcomes):
    lost = {r.without: r.delta for r in models.ablation(outcomes, {"a": ["good"], "b": ["noise"]}, least=4).collect()}
    assert lost["a"] > 0.2 > abs(lost["b"])
    model = models.fit(outcomes, ["noise", "good"], "forest", numTrees=5)
    assert models.select_features(model, ["noise", "good"], share=0.5, least=1) == ["good"]
    scored = models.score(models.fit(outcomes, ["good"]), outcomes, ["good"]).select("game_pk", "season", "home_won", "p")
    name, chosen = models.choose_calibration(scored.where("season < 2023"), scored.where("season >= 2023"))
    after = models.calibrated(name, chosen, scored)
    assert models.metrics(after, "calibrated").first().brier <= models.metrics(scored).first().brier


def test_stack(spark, outcomes):
    base, fitted, meta = models.stacked(outcomes, ["good", "noise"], kinds=("logistic", "forest"), least=4)
    assert base.count() == 100
    assert models.metrics(models.stack_score(fitted, meta, outcomes, ["good", "noise"])).first().accuracy > 0.9


def test_feeds(spark):
    one = lambda x, **more: spark.createDataFrame([(json.dumps(x), *more.values()), (None, *more.values())], ["body", *more])
    record = {"team": {"id": 1, "name": "A"}, "wins": 3, "winningPercentage": ".600", "gamesBack": "-", "records": {"splitRecords": [{"type": "home", "wins": 2, "losses": 1}]}}
    s = feeds.standings(one({"records": [{"division": {"id": 9}, "league": {"id": 8}, "teamRecords": [record, {"team": {"id": 2}}]}]})).orderBy("team_id").collect()
    assert [(r.team_id, r.wins, r.win_percentage, r.games_back, r.home_wins, r.away_wins, r.last_ten) for r in s] == [(1, 3, 0.6, 0.0, 2, 0, "2-1"), (2, 0, 0.0, 0.0, 0, 0, "0-0")]
    stat = feeds.team_stats(one({"stats": [{"splits": [{"team": {"id": 1, "name": "A"}, "stat": {"gamesPlayed": 5, "strikeOuts": 7, "avg": ".250"}}]}]}, stat_type="batting")).first()
    assert (stat.games_played, stat.strikeouts, stat.batting_avg, stat.era) == (5, 7.0, 0.25, None)
    assert feeds.rosters(one({"roster": [{"person": {"id": 4, "fullName": "P"}, "position": {"code": "1"}}]}, team_id=3)).first()[:3] == (3, 4, "P")
    assert [r.player_id for r in feeds.transactions(one({"transactions": [{"id": 1, "person": {"id": 5}}, {"id": 2}]})).collect()] == [5]
    assert feeds.teams(one({"teams": [{"id": 6, "name": "T"}]})).first().team_id == 6
    primary = spark.createDataFrame([(1, 11, 1), (2, 12, None)], "game_pk long, player_id long, batting_order int")
    raw = spark.createDataFrame([(1, '{"lineup":[5]}'), (2, '{"lineup":[7,8]}')], "game_pk long, body string")
    got = sorted((r.game_pk, r.player_id, r.batting_order) for r in feeds.lineups_with_fallback(primary, raw).collect())
    assert got == [(1, 11, 1), (2, 7, 1), (2, 8, 2)]


def test_replays_of_many_files_are_whole(spark, tmp_path, monkeypatch):
    """Tables cut into more files than a trigger takes, the newest rows landed first."""
    con = duckdb.connect()
    for name, ts in (("events", "ts"), ("orders", "o_orderdate")):
        rows = spark.read.parquet(f"{SF}/{name}.parquet").orderBy(F.desc(ts)).toArrow()
        (tmp_path / f"{name}.parquet").mkdir()
        for i in range(6):
            path = tmp_path / f"{name}.parquet" / f"part-{i}.parquet"
            pq.write_table(rows.slice(i * -(-len(rows) // 6), -(-len(rows) // 6)), path, version="2.6")
            os.utime(path, (1_700_000_000 + 60 * i,) * 2)
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    monkeypatch.setattr(live.source, "__defaults__", (2,))
    for name in ("t1_stream_dedup", "t4_appearances", "t6_stream_upsert"):
        con.execute(catalog.oracle_sql()[name])
        names = [c[0] for c in con.description]
        assert plain(catalog.queries()[name](spark, str(tmp_path)).select(names).collect()) == plain(con.fetchall()), name
    rated = catalog.queries()["t5_live_ratings"](spark, str(tmp_path)).collect()
    assert all(r.accepted for r in rated)
    assert plain(r[:3] for r in rated) == plain(catalog.queries()["z1_elo_replay"](spark, SF).select("game_pk", "home_elo", "away_elo").collect())


def test_replay_holds_no_whole_pool(spark):
    """A pool larger than an Arrow batch: sorted by Spark, taken batch by batch, equal to a loop over it."""
    rows = [(i * 37 % 500, day(i * 37 % 500 // 3), 2023 + i * 37 % 500 // 200, i % 5, (i + 1 + i % 4) % 5, i * 7 % 11, i * 5 % 11, "ab"[i % 2]) for i in range(500)]
    g = spark.createDataFrame(rows, GAMES + ", pool string")
    want, last = {}, {}
    for p in "ab":
        loop, played = elo.Ratings(), {}
        for pk, _, s, h, a, x, y, _ in sorted((r for r in rows if r[7] == p), key=lambda r: (r[1], r[0])):
            want[pk] = loop.play(s, h, a, float(x > y))
            played[h], played[a] = played.get(h, 0) + (s == 2025), played.get(a, 0) + (s == 2025)
        last |= {(p, t): (r, played[t]) for t, r in loop.rating.items()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        replayed, after = elo.replay(g, pool="pool"), elo.ratings_after(g.where("season = 2025"), elo.seed(elo.ratings_after(g.where("season < 2025"), pool="pool")), pool="pool")
        assert {r.game_pk: (r.home_elo, r.away_elo, r.home_probability) for r in replayed.collect()} == want
        assert {(r.pool, r.team_id): (r.rating, r.games) for r in after.collect()} == {k: pytest.approx(v) for k, v in last.items()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for frame in (replayed, after):
        assert "GroupsInPandas" not in frame._jdf.queryExecution().executedPlan().toString()


def test_a_pool_of_many_stretches_comes_out_in_one_batch():
    """Twenty stretches of two games each: a frame for each of them took most of the time."""
    import pandas as pd

    from formbook.streaming import pitches as live

    class State(dict):
        def exists(self):
            return bool(self)

        def get(self, *key):
            return self["v"]

        def update(self, value):
            self["v"] = value

        def containsKey(self, key):  # noqa: N802
            return key in self

        def getValue(self, key):  # noqa: N802
            return self[key]

        def updateValue(self, key, value):  # noqa: N802
            self[key] = value

    class Handle:
        def getMapState(self, *_):  # noqa: N802
            return State()

        def getValueState(self, *_):  # noqa: N802
            return State()

    games = [(60 * i, i, 1 + i // 6, i % 3, 3 + i % 2, float(i % 2)) for i in range(40)]
    processor, ratings = live.LateRatings(None), live.elo.Ratings()
    processor.init(Handle())
    late = [g for g in games if g[1] == 5]
    frames = [list(processor.handleInputRows(("p",), iter([pd.DataFrame(rows, columns=live.GAMES)]), None)) for rows in ([g for g in games if g[1] != 5], late)]
    assert [len(f) for f in frames] == [1, 1]
    want = {g[1]: ratings.play(*g[2:])[:2] for g in games}
    last = {r.game_pk: (r.home_elo, r.away_elo) for f in (*frames[0], *frames[1]) for r in f.itertuples()}
    assert last == want
