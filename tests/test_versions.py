"""Versioned tables, materialised views, per-day backfill, late ratings."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from formbook.operators import elo, views
from formbook.sources import versions
from formbook.streaming import pitches as live

ROWS = "k long, month int, v long"


def rows_of(df):
    return sorted(tuple(r) for r in df.select("k", "month", "v").collect())


def test_upsert_moves_keys_in_one_version(spark, tmp_path):
    path = f"{tmp_path}/t"
    versions.create(spark.createDataFrame([(i, i % 4, i) for i in range(40)] + [(100, None, 5)], ROWS), path, "month", ["k"])
    new = spark.createDataFrame([(3, 1, 99), (7, None, 98), (200, 9, 1)], ROWS)
    for _ in range(2):
        versions.upsert(new, path)
    want = {i: (i, i % 4, i) for i in range(40)} | {100: (100, None, 5), 3: (3, 1, 99), 7: (7, None, 98), 200: (200, 9, 1)}
    assert rows_of(versions.read(spark, path).fillna(-1, ["month"])) == sorted((k, -1 if m is None else m, v) for k, m, v in want.values())
    assert rows_of(versions.read(spark, path, 0).where("k < 40")) == [(i, i % 4, i) for i in range(40)]
    assert versions.numbers(spark, path) == [0, 1, 2]


def test_untouched_partitions_keep_their_files(spark, tmp_path):
    path = f"{tmp_path}/t"
    versions.create(spark.createDataFrame([(i, i // 10, i) for i in range(100)], ROWS), path, "month", ["k"])
    before = versions.version(spark, path).entries
    assert len(versions._may_hold(spark.createDataFrame([(23, 2, 0)], ROWS), versions.version(spark, path), ["k"])) == 1
    after = versions.upsert(spark.createDataFrame([(23, 5, 0)], ROWS), path).entries
    assert {k for k in before if before[k] != after[k]} == {"=2", "=5"}
    assert versions.changed(spark, path, 0) == ["2", "5"]


def test_a_reader_sees_one_version_when_a_writer_stops(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    versions.create(spark.createDataFrame([(1, 1, 1), (2, 2, 2)], ROWS), path, "month", ["k"])
    real = versions._put_new

    def stop(*args):
        raise KeyboardInterrupt

    new = spark.createDataFrame([(1, 2, 5)], ROWS)
    for write in (lambda: versions.upsert(new, path), lambda: versions.truncate_and_load(new, path), lambda: versions.overwrite_partitions(new, path)):
        monkeypatch.setattr(versions, "_put_new", stop)
        with pytest.raises(KeyboardInterrupt):  # all rows are written, the switch is not made
            write()
        assert rows_of(versions.read(spark, path)) == [(1, 1, 1), (2, 2, 2)]
        monkeypatch.setattr(versions, "_put_new", real)
    versions.upsert(new, path)
    assert rows_of(versions.read(spark, path)) == [(1, 2, 5), (2, 2, 2)]
    assert versions.vacuum(spark, path, keep=1) >= 3
    assert rows_of(versions.read(spark, path)) == [(1, 2, 5), (2, 2, 2)] and versions.numbers(spark, path) == [1]


def test_two_writers_conflict(spark, tmp_path):
    path = f"{tmp_path}/t"
    v = versions.create(spark.createDataFrame([(1, 1, 1)], ROWS), path, "month", ["k"])
    v.number = 1
    versions.commit(spark, path, v)
    with pytest.raises(versions.Conflict):
        versions.commit(spark, path, v)
    with pytest.raises(versions.Conflict):
        versions.create(spark.createDataFrame([(1, 1, 1)], ROWS), path, "month", ["k"])


def test_load_from_itself_empty_and_new_columns(spark, tmp_path):
    path = f"{tmp_path}/t"
    versions.create(spark.createDataFrame([], ROWS), path, "month", ["k"])
    assert versions.read(spark, path).count() == 0
    versions.upsert(spark.createDataFrame([(1, 1, 1), (2, 1, 2)], ROWS), path)
    versions.truncate_and_load(versions.read(spark, path).where("k = 2"), path)
    versions.overwrite_partitions(spark.createDataFrame([(5, 3, 1, "x")], ROWS + ", w string"), path)
    assert sorted((r.k, r.w) for r in versions.read(spark, path).collect()) == [(2, None), (5, "x")]
    versions.overwrite_partitions(versions.read(spark, path).limit(0), path, also_emptied=["1"])
    assert [r.k for r in versions.read(spark, path).collect()] == [5]


def test_drain_upsert_keeps_a_table_that_is_there(spark, tmp_path):
    path = f"{tmp_path}/t"
    for n, rows in enumerate(([(1, 5, 1), (2, 5, 2)], [(3, 5, 3), (2, 6, 9)])):
        spark.createDataFrame(rows, ROWS).write.parquet(f"{tmp_path}/in{n}")
        live.drain_upsert(live.source(spark, f"{tmp_path}/in{n}"), ["k"], "month", path)
    assert rows_of(versions.read(spark, path)) == [(1, 5, 1), (2, 6, 9), (3, 5, 3)]


def build(df):
    return df.groupBy("month", (F.col("k") % 3).alias("team")).agg(F.sum("v").alias("total"), F.count(F.lit(1)).alias("n"))


def test_view_refresh_equals_rebuild_and_reads_touched_partitions(spark, tmp_path):
    source, path = f"{tmp_path}/s", f"{tmp_path}/v"
    versions.create(spark.createDataFrame([(i, i // 10, i) for i in range(100)], ROWS), source, "month", ["k"])
    view = views.View(source, path, build, "month")
    assert view.refresh(spark) == []
    versions.upsert(spark.createDataFrame([(23, 5, 7), (150, 12, 1), (61, 6, 0)], ROWS), source)
    stale = view.stale(spark)
    assert sorted(stale) == ["12", "2", "5", "6"]
    touched = {f"{source}/{e.folder}" for e in versions.version(spark, source).entries.values() if e.value in stale}
    read = {f.rpartition("/")[0].removeprefix("file://").removeprefix("file:") for f in view.fresh(spark, stale).inputFiles()}
    assert read == touched and len(versions.version(spark, source).entries) == 11
    kept = versions.version(spark, path).entries["=3"]
    assert sorted(view.refresh(spark)) == ["12", "2", "5", "6"] and view.refresh(spark) == []
    assert versions.version(spark, path).entries["=3"] == kept
    want = sorted(map(tuple, build(versions.read(spark, source)).collect()))
    assert sorted(map(tuple, view.read(spark).select("month", "team", "total", "n").collect())) == want
    # A partition that loses its last row goes from the view too.
    versions.upsert(spark.createDataFrame([(150, 3, 1)], ROWS), source)
    view.refresh(spark)
    assert view.read(spark).where("month = 12").count() == 0
    view.rebuild(spark)
    assert sorted(map(tuple, view.read(spark).select("month", "team", "total", "n").collect())) == sorted(map(tuple, build(versions.read(spark, source)).collect()))


def test_view_over_neighbouring_partitions(spark, tmp_path):
    """A carry-over: a month's total and that of the month before."""
    source, path = f"{tmp_path}/s", f"{tmp_path}/v"

    def carried(df):
        per = df.groupBy("month").agg(F.sum("v").alias("v"))
        return per.join(per.select((F.col("month") + 1).cast("int").alias("month"), F.col("v").alias("was")), "month", "left")

    versions.create(spark.createDataFrame([(i, i // 10, i) for i in range(60)], ROWS), source, "month", ["k"])
    view = views.View(source, path, carried, "month", feeds=lambda v: [v, str(int(v) + 1)], needs=lambda v: [v, str(int(v) - 1)])
    view.refresh(spark)
    versions.upsert(spark.createDataFrame([(25, 2, 1000)], ROWS), source)
    assert sorted(view.refresh(spark)) == ["2", "3"]
    assert sorted(map(tuple, view.read(spark).select("month", "v", "was").fillna(0).collect())) == sorted(map(tuple, carried(versions.read(spark, source)).select("month", "v", "was").fillna(0).collect()))


def test_stream_feeds_a_view(spark, tmp_path):
    source, path = f"{tmp_path}/s", f"{tmp_path}/v"
    versions.create(spark.createDataFrame([(1, 1, 1)], ROWS), source, "month", ["k"])
    view = views.View(source, path, build, "month")
    view.refresh(spark)
    for n in range(3):
        spark.createDataFrame([(10 + n, 1 + n, 5), (1, n, 2)], ROWS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = live.source(spark, f"{tmp_path}/in", files_per_trigger=1)
    stream.writeStream.option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).foreachBatch(views.follow(view, ["k"])).start().awaitTermination()
    assert sorted(map(tuple, view.read(spark).select("month", "team", "total", "n").collect())) == sorted(map(tuple, build(versions.read(spark, source)).collect()))
    assert versions.read(spark, source).count() == 4


GAME = "game_pk long, game_date date, season long, home_team_id long, away_team_id long, home_score long, away_score long, league long"


def season_games(seed, n):
    rng = random.Random(seed)
    first = pd.Timestamp("2021-03-01")
    out = []
    for i in range(n):
        day = first + pd.Timedelta(days=rng.randrange(700))
        home, away = rng.sample(range(8), 2)
        league = i % 2
        out.append((i, day.date(), day.year, home + 10 * league, away + 10 * league, rng.randrange(9), rng.randrange(9), league))
    return out


def test_late_games_equal_the_batch_replay(spark, tmp_path):
    games = season_games(3, 300)
    random.Random(5).shuffle(games)
    for i in range(0, 300, 60):
        spark.createDataFrame(games[i : i + 60], GAME).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    rated = live.drain(live.live_ratings(live.source(spark, f"{tmp_path}/in", files_per_trigger=1), "league")).cache()
    want = {r.game_pk: (r.home_elo, r.away_elo) for r in elo.replay(spark.createDataFrame(games, GAME), pool="league").collect()}
    got = live.last_revisions(rated).collect()
    assert len(got) == 300 and all(r.accepted for r in got) and max(r.revision for r in got) > 1
    assert all(abs(r.home_elo - want[r.game_pk][0]) < 1e-9 and abs(r.away_elo - want[r.game_pk][1]) < 1e-9 for r in got)


def test_games_beyond_the_kept_days_are_told(spark, tmp_path):
    games = sorted(season_games(4, 120), key=lambda g: g[1])
    for part in (games[20:100], [*games[100:], games[0], games[95]]):
        spark.createDataFrame(part, GAME).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    got = live.drain(live.live_ratings(live.source(spark, f"{tmp_path}/in", files_per_trigger=1), "league", keep=120)).collect()
    told = {r.game_pk for r in got if not r.accepted}
    assert told == {games[0][0]} and all(r.home_elo is None for r in got if not r.accepted)
