"""Registered queries of the streaming operators: the given tables replayed as streams, each beside the SQL of its batch answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from formbook.plans.catalog import P, r6, register
from formbook.sources import sinks
from formbook.sources.tables import as_leagues, as_pitches, table
from formbook.streaming import pitches as live


def feed(spark, d):
    events = live.source(spark, f"{d}/events.parquet", files_per_trigger=None)  # a replay: no row of the table is late
    return as_pitches(events.withColumn("ts", F.col("ts").cast("timestamp")))  # watermarks need an instant


def closed_feed(spark, d):
    """The feed with a last event of nobody (pitcher -1), late enough for the watermark to pass every window before it."""
    events, path = table(spark, d, "events"), sinks.shared_folder(spark, "closing")
    end = events.agg(F.max("ts").alias("ts")).select(*[(F.lit(-1).cast(t) if c == "user_id" else (F.col("ts") + F.expr("INTERVAL 40 DAYS")).cast(t) if c == "ts" else F.lit(None).cast(t)).alias(c) for c, t in events.dtypes])
    end.write.parquet(path)
    marker = as_pitches(live.source(spark, path, files_per_trigger=None).withColumn("ts", F.col("ts").cast("timestamp")))
    return feed(spark, d).unionByName(marker)


@register(f"WITH {P} SELECT pitch_id, pitcher, game_pk, events FROM p")
def t1_stream_dedup(spark, d):
    """Every event arrives twice and leaves once."""
    twice = feed(spark, d).unionByName(feed(spark, d))
    return live.drain(live.ingest(twice, ["pitch_id"])).select("pitch_id", "pitcher", "game_pk", "events")


@register(f"WITH {P} SELECT game_date AS day, pitcher, count(*)::BIGINT AS n, round(avg(release_speed), 6) AS velo FROM p GROUP BY 1, 2")
def t2_daily_rollup(spark, d):
    return live.drain(live.rollup(closed_feed(spark, d), ["pitcher"], "1 day")).where("pitcher >= 0").select(F.to_date("start").alias("day"), "pitcher", "n", r6(F.col("velo"), "velo"))


@register(f"WITH {P} SELECT (game_date - k::INT)::DATE AS day, pitcher, count(*)::BIGINT AS n, round(avg(release_speed), 6) AS velo FROM p, generate_series(0, 6) AS s(k) GROUP BY 1, 2")
def t3_sliding_week(spark, d):
    return live.drain(live.rollup(closed_feed(spark, d), ["pitcher"], "7 days", "1 day")).where("pitcher >= 0").select(F.to_date("start").alias("day"), "pitcher", "n", r6(F.col("velo"), "velo"))


@register(
    f"""WITH {P}, a AS (SELECT *, coalesce((ts - lag(ts) OVER (PARTITION BY pitcher ORDER BY ts) > INTERVAL 30 MINUTES)::INT, 1) AS new FROM p), s AS (SELECT *, sum(new) OVER (PARTITION BY pitcher ORDER BY ts) AS sess FROM a)
 SELECT pitcher, epoch_us(min(ts))::BIGINT AS start_us, epoch_us(max(ts) + INTERVAL 30 MINUTES)::BIGINT AS end_us, count(*)::BIGINT AS n FROM s GROUP BY pitcher, sess"""
)
def t4_appearances(spark, d):
    return live.drain(live.appearances(closed_feed(spark, d), ["pitcher"])).where("pitcher >= 0").select("pitcher", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n")


@register()
def t5_live_ratings(spark, d):
    """Every third day's games come in a second trigger, after all others; the last revision of a game is that of a replay in order."""
    orders, path = table(spark, d, "orders"), sinks.shared_folder(spark, "late-feed")
    late = F.dayofyear("o_orderdate") % 3 == 0
    landed = orders.withColumn("landed", F.when(late, "2").otherwise("1"))
    for n in ("1", "2"):  # files are taken in the order in which they landed
        landed.where(F.col("landed") == n).drop("landed").coalesce(1).write.mode("append").parquet(path)
    rated = live.drain(live.live_ratings(as_leagues(live.source(spark, path, files_per_trigger=1)), "league"))
    return live.last_revisions(rated).select("game_pk", r6(F.col("home_elo"), "home_elo"), r6(F.col("away_elo"), "away_elo"), "accepted")


@register(f"WITH {P} SELECT pitcher, game_date, count(*)::BIGINT AS n, (year(game_date) * 100 + month(game_date))::INT AS month FROM p GROUP BY 1, 2, 4")
def t6_stream_upsert(spark, d):
    counts = feed(spark, d).withWatermark("ts", "2 days").groupBy("pitcher", "game_date").agg(F.count(F.lit(1)).alias("n")).withColumn("month", F.year("game_date") * 100 + F.month("game_date"))
    return live.drain_upsert(counts, ["pitcher", "game_date"], "month")


@register(f"WITH {P} SELECT pitch_id, events, n_name FROM p LEFT JOIN nation ON pitcher % 25 = n_nationkey")
def t7_stream_static(spark, d):
    nation = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("country"), "n_name")
    return live.drain(live.enrich(feed(spark, d).withColumn("country", F.col("pitcher") % 25), nation, ["country"])).select("pitch_id", "events", "n_name")
