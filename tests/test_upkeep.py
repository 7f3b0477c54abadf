"""Sinks, readers, medians, unions, dimension versions, rating grids and lineups on small tables."""

import json
import random
import statistics

import pytest
from pyspark.sql import functions as F

from formbook.operators import elo, lineup, quality, ranks, upkeep
from formbook.sources import sinks, tables


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_moves_keys_and_empties_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "p"), (2, "q")], "k long, part string").withColumn("v", F.lit(0.0)).write.partitionBy("part").parquet(path)
    new = spark.createDataFrame([(1, 9.0, "q")], "k long, v double, part string")
    for _ in range(2):  # a rerun changes nothing
        sinks.upsert(new, path, ["k"], "part")
        assert rows_of(spark.read.parquet(path).select("k", "part", "v")) == [(1, "q", 9.0), (2, "q", 0.0)]
    assert not list(tmp_path.glob("t.stage*")) and not (tmp_path / "t" / "part=p").exists()


def test_other_sinks(spark, tmp_path):
    frame = spark.createDataFrame([(1, "2024-04-01", 2), (2, "2024-04-02", 3)], "k long, day string, v int")
    path = str(tmp_path / "days")
    for _ in range(2):
        sinks.delete_dates_insert(frame, path, "day")
    sinks.delete_dates_insert(frame.where("k = 2").withColumn("v", F.lit(7)), path, "day")
    assert rows_of(spark.read.parquet(path).select("k", "v")) == [(1, 2), (2, 7)]
    for _ in range(2):
        sinks.append(frame.drop("v").withColumn("extra", F.lit(1)), str(tmp_path / "a"), "v double, k long")
    assert rows_of(spark.read.parquet(str(tmp_path / "a")).select("k")) == [(1,), (1,), (2,), (2,)]
    sinks.truncate_and_load(frame, str(tmp_path / "l"))
    sinks.truncate_and_load(spark.read.parquet(str(tmp_path / "l")).where("k = 1"), str(tmp_path / "l"))
    assert spark.read.parquet(str(tmp_path / "l")).count() == 1
    sinks.ndjson(frame, str(tmp_path / "j"))
    assert rows_of(spark.read.json(str(tmp_path / "j")).select("k", "v")) == [(1, 2), (2, 3)]
    for _ in range(2):
        sinks.create_table_as(frame, "ctas_days", str(tmp_path / "c"), ["day"], ["k"])
    assert spark.table("ctas_days").count() == 2
    spark.sql("DROP TABLE ctas_days")
    assert rows_of(sinks.clean_nan(spark.createDataFrame([(float("nan"),), (1.0,)], "x double")).where("x IS NULL").select(F.lit(1))) == [(1,)]
    assert sinks.align(frame.drop("v"), frame).columns == ["k", "day", "v"]


def test_readers(spark, tmp_path):
    (tmp_path / "r.csv").write_text("game_pk,status_code,game_type\n1,F,R\n2,F,S\n3,P,R\n")
    assert rows_of(tables.read_results_csv(spark, str(tmp_path / "r.csv"), "game_pk long, status_code string, game_type string").select("game_pk")) == [(1,)]
    (tmp_path / "p.csv").write_text("pitcher,junk,events\n5,x,walk\n")
    assert tables.read_pitch_csv(spark, str(tmp_path / "p.csv"), ["events", "pitcher", "spin"]).columns == ["events", "pitcher"]
    for folder, year in (("a", 2023), ("b", 2023), ("b", 2024)):
        spark.createDataFrame([(folder,)], "src string").write.parquet(str(tmp_path / folder / f"g_{year}.parquet"))
    got = tables.read_years(spark, [str(tmp_path / "a"), str(tmp_path / "b")], "g_{year}.parquet", [2022, 2023, 2024])
    assert rows_of(got.select("src", "season")) == [("a", 2023), ("b", 2024)]
    with pytest.raises(FileNotFoundError):
        tables.read_years(spark, [str(tmp_path)], "g_{year}.parquet", [1999])
    side = lambda team, starter: {"score": 3, "team": {"id": team}, "probablePitcher": {"id": starter}}
    game = lambda pk, state: {"gamePk": pk, "officialDate": "2024-05-01", "seriesGameNumber": 2, "gamesInSeries": 3, "status": {"detailedState": state}, "teams": {"home": side("7", "x1"), "away": side("8", "90")}}
    raw = spark.createDataFrame([(json.dumps({"dates": [{"games": [game("10", "Final"), game("11", "Preview")]}]}),), (None,), ("{",)], "body string")
    found = tables.season_results(raw).collect()
    assert [(r.game_pk, r.home_team_id, r.home_starter_id, r.away_starter_id, r.series_game_number) for r in found] == [(10, 7, None, 90, 2)]
    typed = tables.typed_landing(spark.createDataFrame([('{"a": {"b": "4"}, "d": "2024-01-02"}',), ('{"a": {"b": "x"}}',)], "body string"), {"b": ("$.a.b", "int"), "d": ("$.d", "date")})
    assert [(r.b, str(r.d)) for r in typed.collect()] == [(4, "2024-01-02"), (None, "None")]


def test_medians_are_exact(spark):
    rng = random.Random(2)
    rows = [(rng.gauss(0, 1e6) if i % 7 else None, float(rng.randrange(4)), None, 5.0) for i in range(5000)] + [(1e300, -1e300, None, 5.0)]
    got = upkeep.medians(spark.createDataFrame(rows, "a double, b double, c double, d double"), ["a", "b", "c", "d"])
    for i, c in enumerate("abcd"):
        want = [r[i] for r in rows if r[i] is not None]
        assert got[c] == (pytest.approx(statistics.median(want)) if want else None)
    odd = upkeep.medians(spark.createDataFrame([(x,) for x in (3.0, 1.0, 2.0)], "x double"), ["x"])
    assert odd == {"x": 2.0}
    filled = upkeep.filled(spark.createDataFrame([(None, None), (2.0, 4.0), (4.0, None)], "f double, m double"), {"f": 0.5}, ["m"])
    assert rows_of(filled) == [(0.5, 4.0), (2.0, 4.0), (4.0, 4.0)]


def test_ranges_of_ranks(spark):
    values = random.Random(3).sample(range(10**6), 4000)
    frame = spark.createDataFrame([(float(v), v % 5 + 1) for v in values], "v double, n int")
    total, want = 0, {}
    for v in sorted(values):
        want[v] = total
        total += v % 5 + 1
    assert {int(r.v): r.ahead for r in ranks.ahead(frame, "v", "n").collect()} == want


def test_unions_and_sources(spark):
    old = spark.createDataFrame([(1, 5), (2, 6)], "k long, v int")
    new = spark.createDataFrame([("2", "7", "x"), ("3", "bad", "y")], "k string, v string, extra string")
    union = upkeep.union_aligned([old, new], "k long, v long, w string")
    assert rows_of(upkeep.keep_last(union, ["k"]).select("k", "v")) == [(1, 5), (2, 7), (3, None)]
    base = spark.createDataFrame([(1, 10, None), (2, None, None), (None, 4, 4)], "k long, a int, b int")
    first, second = spark.createDataFrame([(1, None, 3)], "k long, a int, b int"), spark.createDataFrame([(1, 8), (2, 9)], "k long, a int")
    assert {(r.k, r.a, r.b) for r in upkeep.coalesced(base, [first, second], "k").collect()} == {(1, 8, 3), (2, 9, None), (None, 4, 4)}


def test_freshness_and_rows(spark):
    none = spark.createDataFrame([], "day date")
    today = F.lit("2024-05-03").cast("date")
    report = quality.report([quality.row_counts({"none": none}), quality.freshness(none, "day", today, 1, "fresh"), quality.required_columns(none, ["day", "k"], "none")])
    assert {r.check_name: (r.actual, r.passed) for r in report.collect()} == {"rows_none": (0, False), "fresh": (None, False), "columns_none": (1, False)}
    assert quality.exit_code(report) == 1 and quality.exit_code(report.where("severity = 'warning'")) == 2 and quality.exit_code(report.where("passed")) == 0


def test_dimension_versions(spark):
    dim = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k long, x string").select("k", "x", F.lit("2020-01-01").cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
    new = spark.createDataFrame([(1, "a"), (2, "b"), (4, None)], "k long, x string")
    day = F.lit("2021-01-01").cast("date")
    once = upkeep.versioned(dim, new, "k", ["x"], day)
    got = sorted((r.k, r.x or "", str(r.valid_from), str(r.valid_to), r.is_current) for r in once.collect())
    assert got == [(1, "a", "2020-01-01", "None", True), (2, "", "2020-01-01", "2020-12-31", False), (2, "b", "2021-01-01", "None", True), (3, "c", "2020-01-01", "None", True), (4, "", "2021-01-01", "None", True)]
    assert upkeep.versioned(once, new, "k", ["x"], day).count() == once.count()  # nothing changed


def test_grid_is_the_replay_of_each_configuration(spark):
    rng = random.Random(5)
    rows = [(i, f"{2020 + i // 100}-04-{1 + i % 28:02d}", 2020 + i // 100, i % 3, 10 * (i % 3) + rng.randrange(5), 10 * (i % 3) + 5 + rng.randrange(4), rng.randrange(9), rng.randrange(9)) for i in range(300)]
    g = spark.createDataFrame(rows, "game_pk long, day string, season long, pool long, home_team_id long, away_team_id long, home_score int, away_score int").withColumn("game_date", F.to_date("day"))
    configs = [("x", 15.0, 80.0, 0.4), ("y", 25.0, 40.0, 0.25)]
    got = {r.config: r for r in elo.grid(g, configs, "pool").collect()}
    won = {r[0]: float(r[6] > r[7]) for r in rows}
    for c in configs:
        ran = elo.replay(g, spark.createDataFrame([c], "config string, k double, bonus double, regression double"), "pool").collect()
        assert got[c[0]].n == len(ran) == 300
        assert got[c[0]].brier == pytest.approx(sum((r.home_probability - won[r.game_pk]) ** 2 for r in ran) / 300)
        assert got[c[0]].accuracy == pytest.approx(sum((r.home_probability >= 0.5) == (won[r.game_pk] > 0.5) for r in ran) / 300)


def test_projected_lineup_has_a_pitcher_and_is_not_confirmed(spark):
    recent = spark.createDataFrame([(1, "2024-04-01", 100, 10 + i, i, "2024-04-02") for i in range(1, 10)], "team_id long, d string, game_pk long, player_id long, batting_order int, t string")
    recent = recent.select("team_id", F.to_date("d").alias("game_date"), "game_pk", "player_id", "batting_order", F.to_date("t").alias("target_date"))
    probable = spark.createDataFrame([(1, 900), (2, 901)], "team_id long, player_id long")
    got = lineup.with_pitchers(lineup.project(recent, ["team_id"]), probable, ["team_id"]).orderBy(F.asc_nulls_last("batting_order")).collect()
    assert [r.batting_order for r in got] == [*range(1, 10), None] and got[-1].player_id == 900 and not any(r.lineup_confirmed for r in got)
