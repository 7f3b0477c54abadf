"""Backfill outcomes, layouts, models side by side, rules, terms, sketches, medians with odd values."""

import math
import random
import statistics
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from formbook.operators import backfill, models, rules, sketches, terms, upkeep
from formbook.plans import reports
from formbook.sources import sinks, versions

SF = "/root/testdata/sf0.001"


def test_a_broken_day_is_an_error_row(spark, tmp_path):
    days = [date(2024, 4, d) for d in range(1, 31)]
    folder = tmp_path / "in"
    folder.mkdir()
    for d in days:
        (folder / f"{d}.json").write_text('{"k": 1, "v": "x"}\n' if d.day == 13 else f'{{"k": {d.day}, "v": 2}}\n')

    def build(spark, day):
        if day.day == 20:
            raise FileNotFoundError("not landed")
        return spark.read.schema("k long, v string").json(f"{folder}/{day}.json").select("k", F.col("v").cast("int").alias("v"))

    job = backfill.Backfill(f"{tmp_path}/t", "day", build)
    out = {r.day: r for r in job.run(spark, days).collect()}
    assert len(out) == 30 and {d.day for d, r in out.items() if r.status == "error"} == {13, 20}
    assert "not landed" in out[days[19]].error and out[days[12]].rows == 0 and out[days[0]].rows == 1
    assert versions.read(spark, job.path).count() == 28
    again = job.run(spark, [days[0], days[12]])  # a day that is run again replaces itself; one that breaks again leaves what was there
    assert job.failed(again) == [days[12]] and versions.read(spark, job.path).count() == 28
    (folder / f"{days[12]}.json").write_text('{"k": 13, "v": 5}\n')
    assert job.failed(job.run(spark, [days[12]])) == [] and versions.read(spark, job.path).count() == 29


def test_checked_days(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), ("b", 3), ("c", -1)], "day string, v int").withColumn("day", F.expr("date_add(DATE '2024-01-01', ascii(day))"))
    good, outcome = backfill.checked(rows, "day", {"known": F.col("v").isNotNull(), "positive": F.col("v") > 0})
    assert sorted(r.v for r in good.collect()) == [1, 2]
    assert sorted((r.status, r.rows, r.error or "") for r in outcome.collect()) == [("error", 0, "known: 1; positive: 1"), ("error", 0, "positive: 1"), ("ok", 2, "")]
    assert backfill.checked(rows, "day", {})[1].where("status = 'ok'").count() == 3


def test_bucketed_tables_join_without_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        games, lines = reports.bucketed(spark, SF)
        joined = games.join(lines, "game_pk")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == reports.table(spark, SF, "lineitem").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ranges_of_keys_prune_folders(spark, tmp_path):
    frame = spark.range(100).withColumnRenamed("id", "k").unionByName(spark.createDataFrame([(None,), (-5,), (500,)], "k long"))
    sinks.bucketed_table(frame, "ranged_test", f"{tmp_path}/r", "k", 2, bounds=(0, 100, 25))
    t = spark.table("ranged_test")
    assert {(r.key_range, r.n) for r in t.groupBy("key_range").agg(F.count(F.lit(1)).alias("n")).collect()} == {(0, 25), (25, 25), (50, 25), (75, 25), (None, 3)}
    assert "PartitionFilters: [isnotnull" in t.where("key_range = 50")._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE ranged_test")


def outcomes(spark, n=900, leak=None):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((i, 2018 + i * 5 // n, int(a * b + 0.3 * rng.gauss(0, 1) > 0), a, b if i % 9 else None))
    return sinks.stored(spark.createDataFrame(rows, "game_pk long, season long, home_won int, a double, b double"))


def test_kinds_of_models_and_the_perceptron(spark):
    df = outcomes(spark)
    before, last = df.where("season < 2022"), df.where("season = 2022")
    loss = {k: models.metrics(models.score(models.fit(before, ["a", "b"], k), last, ["a", "b"])).first().log_loss for k in models.KINDS}
    assert set(loss) == {"logistic", "forest", "boosted", "perceptron"}
    assert loss["perceptron"] < 0.6 < loss["logistic"]  # a product of two features is beyond a linear model
    changed = df.withColumn("home_won", F.when(F.col("season") == 2022, 1 - F.col("home_won")).otherwise(F.col("home_won")))
    both = [models.score(models.fit(d.where("season < 2022"), ["a", "b"], "perceptron", maxIter=20), last, ["a", "b"]).orderBy("game_pk").select("p").collect() for d in (df, changed)]
    assert both[0] == both[1]


def counted(monkeypatch, owner):
    """The list to which every fit of ``owner`` adds its own."""
    made, fit = [], owner.fit
    monkeypatch.setattr(owner, "fit", lambda self, *a, **k: made.append(self) or fit(self, *a, **k))
    return made


def test_kinds_share_medians(spark, monkeypatch):
    """the kinds of models are the same as one by one; before, each took medians and variances of all rows for itself."""
    df = models.training_table(outcomes(spark, 300))
    wanted = [("logistic", {}), ("boosted", {"maxIter": 3})]
    alone = [models.score(models.fit(df, ["a", "b"], k, **p), df, ["a", "b"]).orderBy("game_pk").collect() for k, p in wanted]
    made = counted(monkeypatch, models.Imputer)
    together = models.fit_each(df, ["a", "b"], wanted, side_by_side=2)
    assert len(made) == 1
    assert [models.score(m, df, ["a", "b"]).orderBy("game_pk").collect() for m in together] == alone


def test_only_the_chosen_calibration_is_fitted_again(spark, monkeypatch):
    """two calibrators to choose from and the better one on all rows; before, both were fitted on all rows."""
    df = outcomes(spark, 300).select("season", "home_won", (1 / (1 + F.exp(-F.col("a")))).alias("p"))
    made = counted(monkeypatch, models.IsotonicRegression), counted(monkeypatch, models.LogisticRegression)
    name, _ = models.choose_calibration(df.where("season < 2021"), df.where("season >= 2021"))
    assert [len(m) for m in made] == ([2, 1] if name == "isotonic" else [1, 2])


def test_sets_of_parameters_share_medians(spark, monkeypatch):
    """one fit of medians for each fold; before, one for each fold and set of parameters."""
    made = counted(monkeypatch, models.Imputer)
    assert models.search(outcomes(spark, 300), ["a", "b"], "logistic", [{"regParam": r} for r in (0.01, 0.1, 1.0)], least=3).count() == 3
    assert len(made) == 2


def test_search_is_the_serial_one_and_sees_no_later_season(spark):
    df = outcomes(spark, 300)
    grid = [{"regParam": 0.001}, {"regParam": 5.0}, {"regParam": 0.1}]
    began = time.time()
    serial = {str(g): models.metrics(models.walk_forward(df, ["a", "b"], "logistic", **g)).first().log_loss for g in grid}
    alone = time.time() - began
    began = time.time()
    found = models.search(df, ["a", "b"], "logistic", grid).collect()
    together = time.time() - began
    assert {r.params: r.log_loss for r in found} == pytest.approx(serial) and [r.log_loss for r in found] == sorted(r.log_loss for r in found)
    assert together < 1.5 * alone
    changed = df.withColumn("home_won", F.when(F.col("season") == 2022, None).otherwise(F.col("home_won")))
    early = models.search(changed, ["a", "b"], "logistic", grid[:1]).first()
    want = models.metrics(models.walk_forward(df.where("season < 2022"), ["a", "b"], "logistic", **grid[0])).first()
    assert early.n == want.n and early.log_loss == pytest.approx(want.log_loss)
    with pytest.raises(ValueError):
        models.search(df.where("season < 2020"), ["a", "b"], "logistic", grid)


def test_rules_ladders_and_both_caps(spark):
    batters = [("r", "x", i, f"p{i}", 0.5 - i / 1000, 20, i) for i in range(6)] + [("r", "y", 10 + i, f"q{i}", 0.1, 20, 9 * (i == 0)) for i in range(5)] + [("s", "x", 1, "z", None, 50, None)]
    frame = spark.createDataFrame(batters, "report string, opponent string, n long, player string, woba double, pa long, hr long")
    found = rules.facts(frame, rules.BATTERS, ["report", "opponent", "n"])
    assert {r.place for r in found.where("report = 'r' AND opponent = 'x'").collect()} == {10}
    assert {(r.n, r.place) for r in found.where("opponent = 'y'").collect()} == {(10, 12), (11, 13), (12, 13), (13, 13), (14, 13)} and found.where("report = 's'").count() == 0
    free = spark.createDataFrame([("r", None, 90 + i, 1, "k", "t") for i in range(4)], "report string, opponent string, n long, place int, kind string, text string")
    taken = rules.capped(found.unionByName(free), ["report"], ["opponent"], [F.col("n")], 3, 8).collect()
    assert [r.n for r in sorted(taken, key=lambda r: r.fact_no)] == [0, 1, 2, 10, 11, 12, 90, 91]


def test_terms_against_contains(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 6))) for _ in range(10_000)]
    texts = [(i, "".join(rng.choice("abcde ") for _ in range(rng.randrange(0, 40)))) for i in range(60)] + [(100, None), (101, "")]
    frame, keys = spark.createDataFrame(texts, "doc long, t string"), spark.createDataFrame([(w,) for w in words] + [(None,), ("",)], "w string")
    want = {(i, w) for i, t in texts for w in set(words) if t and w in t}
    for most in (200_000, 300):
        got = [(r.doc, r.word) for r in terms.met(frame, keys, "doc", "t", "w", most).collect()]
        assert len(got) == len(want) and set(got) == want
    assert terms.met(frame, keys.limit(0), "doc", "t", "w").count() == 0


def test_sketches_of_ranges(spark):
    rows = [(d, (d * 3000 + i) % 20_000) for d in range(10) for i in range(6000)]
    frame = spark.createDataFrame(rows, "d int, v long").select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")).alias("day"), "v")
    days = sinks.stored(sketches.daily(frame, "day", "v"))
    ranges = days.select(F.col("day").alias("a")).crossJoin(days.select(F.col("day").alias("b"))).where("a <= b")
    for r in sketches.over_ranges(days, ranges, "day", "a", "b").collect():
        exact = len({v for d, v in rows if r.a.day - 1 <= d <= r.b.day - 1})
        assert abs(r.about - exact) <= 0.02 * exact


def test_medians_with_nan_and_infinities(spark):
    inf, nan = math.inf, math.nan
    cases = [[1.0, 2.0, 3.0, 4.0, 5.0, nan], [1.0, 2.0, 3.0, 4.0, inf], [-inf, 1.0, inf], [-inf, inf], [inf, inf, 1.0], [nan], [1.7e308, -1.7e308, 5.0, 1.6e308], [5e-324, 1e-323, 1.5e-323, 2e-323], [1.0, 1.0 + 2**-52, 1.0 + 2**-51], [-inf, -inf, 3.0, 4.0], [-inf, 2.0]]
    for values in cases:
        real = sorted(v for v in values if not math.isnan(v))
        want = statistics.median(real) if real else None
        got = upkeep.medians(spark.createDataFrame([(v,) for v in values], "x double"), ["x"])["x"]
        assert got == want or want is not None and math.isnan(want) and got is None, (values, got, want)
    many = [random.Random(3).gauss(0, 1) for _ in range(20_001)]
    assert upkeep.medians(spark.createDataFrame([(v,) for v in many] + [(nan,), (None,)], "x double"), ["x"])["x"] == statistics.median(many)


@pytest.mark.parametrize("name", ["m9_m10_full_table", "m10_rated_row", "m3_rating_features", "m2_n6_n7_season_table"])
def test_game_tables_read_earlier_games_alone(spark, tmp_path, name):
    from formbook.plans import catalog

    orders = spark.read.parquet(f"{SF}/orders.parquet")
    later = F.col("o_orderdate") >= "1996-06-01"
    orders.withColumn("o_totalprice", F.when(later, F.col("o_totalprice") * 3 + 7).otherwise(F.col("o_totalprice"))).write.parquet(f"{tmp_path}/orders.parquet")
    for t in ("part", "nation", "customer", "supplier"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    early = orders.where(~later).select(F.col("o_orderkey").alias("game_pk"))
    both = [sorted(map(str, catalog.queries()[name](spark, d).join(early, "game_pk", "left_semi").collect())) for d in (SF, str(tmp_path))]
    assert both[0] == both[1], [x for x in zip(*both, strict=True) if x[0] != x[1]][:2]
    assert len(both[0]) > 100


def test_series_and_starters(spark):
    from formbook.plans import rows

    day = lambda d: f"2024-04-{d:02d}"
    g = spark.createDataFrame([(1, day(1), 1, 2, 5, 3), (2, day(2), 1, 2, 1, 3), (3, day(3), 1, 2, 4, 0), (4, day(20), 1, 2, 1, 0), (5, day(4), 2, 1, 1, 0)], "game_pk long, d string, home_team_id long, away_team_id long, home_score int, away_score int")
    g = g.withColumns({"game_date": F.to_date("d"), "season": F.lit(2024)})
    assert {r.game_pk: (r.series_game, r.series_home_wins) for r in rows.series(g).collect()} == {1: (1, 0), 2: (2, 1), 3: (3, 1), 4: (1, 0), 5: (1, 0)}
    known = spark.createDataFrame([(10, 80.0, 60.0), (11, None, 20.0)], "pitcher long, xera double, k_pct double")
    pairs = spark.createDataFrame([(1, 10, 11), (2, 10, 99), (3, None, None)], "game_pk long, home_starter long, away_starter long")
    got = {r.game_pk: r for r in rows.starter_quality(pairs, known).collect()}
    assert got[1].sp_quality_composite_diff == pytest.approx(0.35 * 30 + 0.25 * 40) and got[1].sp_both_known == 1
    assert got[2].sp_quality_composite_diff == pytest.approx(0.35 * 30 + 0.25 * 10) and (got[2].home_sp_known, got[2].away_sp_known) == (1, 0)
    assert got[3].sp_quality_composite_diff == 0.0


def test_pitcher_scores_against_plain_sums(spark):
    """M29: posterior and arm rate by hand; the score lies between the ends of the scaled values."""
    from formbook.plans import catalog
    from formbook.sources.tables import pitches

    outs = {}
    for r in pitches(spark, SF).select("pitcher", "events").collect():
        n, k = outs.get(r.pitcher, (0, 0))
        outs[r.pitcher] = (n + 1, k + (r.events in ("strikeout", "field_out")))
    got = {r.pitcher: r for r in catalog.queries()["m29_pitcher_scores"](spark, SF).collect()}
    assert set(got) <= set(outs) and len(got) > 10
    order = sorted(got, key=lambda p: got[p].posterior)
    rates = [outs[p][1] / outs[p][0] for p in order]
    assert all(0 <= r.score <= 100 for r in got.values()) and statistics.correlation(range(len(order)), rates) > 0.8
    assert abs(sum(r.residual * outs[p][0] for p, r in got.items()) / sum(outs[p][0] for p in got)) < 0.5


def test_numeric_selection_and_union_of_features(spark):
    from formbook.operators import selection

    rows = [(1, True, "2.5", "x", "1", None), (2, None, "bad", "y", "2", None), (3, False, "4", "1", "z", None)]
    df = spark.createDataFrame(rows, "k long, flag boolean, t string, name string, mixed string, none string").withColumn("money", F.col("k").cast("decimal(10,2)"))
    got = selection.numeric(df, keep=["name"])
    assert got.dtypes == [("k", "bigint"), ("flag", "int"), ("t", "double"), ("name", "string"), ("mixed", "double"), ("money", "double")]
    assert sorted((r.k, r.flag, r.t, r.mixed) for r in got.collect()) == [(1, 1, 2.5, 1.0), (2, None, None, 2.0), (3, 0, 4.0, None)]
    assert selection.numeric(df.limit(0)).columns == ["k", "flag", "money"]
    assert selection.feature_union(["a", "b"], ["b", "c", "a"], ["d"], known=["d", "a", "b"]) == ["a", "b", "d"]


def test_careers_are_of_days_before_and_reach_back(spark):
    """A batter in a lineup who did not face the starter that day still has what he did against him before; nothing of the day itself counts."""
    from formbook.operators import matchups

    events = [(i, 1 + d, "2024-01-%02d" % (1 + d), b, pit, e, half) for i, (d, b, pit, e, half) in enumerate([(0, 7, 50, "home_run", "Top"), (0, 7, 50, "walk", "Top"), (0, 9, 60, "single", "Bot"), (5, 7, 51, "single", "Top"), (5, 8, 50, "single", "Top"), (5, 8, 50, "field_out", "Top"), (5, 9, 60, "strikeout", "Bot")])]
    p = spark.createDataFrame([(i, g, d, b, pit, e, half, "R", "L", 1, 90.0) for i, g, d, b, pit, e, half in events], "pitch_id long, game_pk long, d string, batter long, pitcher long, events string, inning_topbot string, p_throws string, stand string, inning int, release_speed double").withColumn("game_date", F.to_date("d"))
    value = F.expr("CASE events WHEN 'walk' THEN 690 WHEN 'single' THEN 880 WHEN 'home_run' THEN 2031 ELSE 0 END").cast("long")
    got = {r.game_pk: r for r in matchups.table(p, value, least=1, least_pair=1).collect()}
    assert got[1].away_lineup_woba_vs_hand is None and got[1].home_starter_woba_allowed == 0.32
    assert got[6].home_starter_id == 50 and got[6].away_h2h_pa_total == 2 and got[6].away_h2h_woba == pytest.approx((2.031 + 0.69) / 2)
    assert got[6].home_h2h_woba == pytest.approx(0.88) and got[6].home_starter_woba_allowed == pytest.approx((2.031 + 0.69) / 2) and got[6].away_starter_k_pct == 0.0


@pytest.mark.parametrize("name, column", [("m5_matchup_table", "home_lineup_woba_vs_hand"), ("m7_matchup_row", "home_starter_woba_30d"), ("m6_arsenal_table", "home_venue_lift")])
def test_matchup_tables_read_earlier_days_alone(spark, tmp_path, name, column):
    from formbook.plans import catalog

    events = spark.read.parquet(f"{SF}/events.parquet")
    later = F.to_date("ts") >= "2024-01-15"
    # Later days have other outcomes; their lineups and starters are those of the day itself, so only earlier days are compared.
    events.withColumn("event_type", F.when(later, F.lit("purchase")).otherwise(F.col("event_type"))).write.parquet(f"{tmp_path}/events.parquet")
    both = [{(r.game_date, r.game_pk): r for r in catalog.queries()[name](spark, d).collect()} for d in (SF, str(tmp_path))]
    early = [k for k in both[0] if str(k[0]) < "2024-01-15"]
    assert len(early) > 20 and all(both[0][k] == both[1][k] for k in early)
    on_the_day = [k for k in both[0] if str(k[0]) == "2024-01-15"]
    assert all(both[0][k][column] == both[1][k][column] for k in on_the_day)


def test_bullpen_load(spark):
    from formbook.operators import matchups

    rows = [(d, pit, inn) for d, pit, inn, n in [(1, 10, 9, 3), (1, 20, 2, 2), (3, 20, 9, 5), (8, 10, 3, 1), (9, 10, 3, 1)] for _ in range(n)]
    p = spark.createDataFrame([("2024-01-%02d" % d, pit, inn, 1) for d, pit, inn in rows], "d string, pitcher long, inning int, game_pk long").withColumn("game_date", F.to_date("d"))
    got = {r.game_date.day: r for r in matchups.bullpen(p, F.lit(0)).collect()}
    assert (got[1].pitches, got[1].closer) == (0, None) and (got[3].pitches, got[3].closer, got[3].closer_rest) == (5, 10, 2)
    assert got[3].fatigue == pytest.approx(5 * 6 / 7) and (got[8].pitches, got[8].closer, got[8].closer_rest) == (10, 20, 5)
    assert got[9].pitches == 6 and got[9].fatigue == pytest.approx((5 * 2 + 1 * 7) / 7)
