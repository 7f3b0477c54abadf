"""Structured Streaming over the pitch and game feeds.

Every function takes a streaming frame and returns one; they run on batches as well where Spark allows it.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from formbook.operators import elo
from formbook.operators.dedup import latest_per_key
from formbook.sources import sinks, versions

EVENT_KEY = ["game_pk", "pitcher", "batter", "game_date", "events"]


def source(spark: SparkSession, path: str, files_per_trigger: int | None = 1000) -> DataFrame:
    """A landed Parquet folder (or file) as a stream; what a trigger takes is bounded.

    With None one trigger takes all files: files come in the order they landed, so a replay of a table over
    several triggers would take the older events of later files for late ones.
    """
    # written as a pattern, since a stream takes a path without one for a folder
    pattern = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(pattern)


def ingest(stream: DataFrame, keys: list[str] = EVENT_KEY, late: str = "2 days") -> DataFrame:
    """Repeated events go while their key is within ``late`` of the stream's time; the state is dropped after it."""
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def rollup(stream: DataFrame, by: list[str], length: str, slide: str | None = None, late: str = "2 days") -> DataFrame:
    """Counts and mean speed per tumbling (or, with ``slide``, sliding) window of event time."""
    w = F.window("ts", length, slide) if slide else F.window("ts", length)
    out = stream.withWatermark("ts", late).groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"), F.avg("release_speed").alias("velo"))
    return out.select(F.col("w.start").alias("start"), *by, "n", "velo")


def appearances(stream: DataFrame, by: list[str], gap: str = "30 minutes", late: str = "2 days") -> DataFrame:
    """An appearance: a pitcher's events with gaps under ``gap``; ``end`` is the last event plus the gap."""
    out = stream.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")


def enrich(stream: DataFrame, dimension: DataFrame, keys: list[str]) -> DataFrame:
    """Events with a static dimension; Spark broadcasts it when its measured size allows."""
    return stream.join(dimension, keys, "left")


RATED = "pool string, game_pk long, home_elo double, away_elo double, accepted boolean, revision long"
#: Days that a stretch of the calendar covers: its games and the ratings at its start are one entry of a pool's state.
STRETCH = 120
GAMES = ["day", "game_pk", "season", "home_team_id", "away_team_id", "result"]


def _rated(rows: list[tuple]) -> pd.DataFrame:
    columns = ["pool", "game_pk", "home_elo", "away_elo", "accepted", "revision"]
    return pd.DataFrame(rows, columns=columns).astype({"game_pk": "Int64", "home_elo": "float64", "away_elo": "float64"})


class LateRatings(StatefulProcessor):
    """A pool's state: for each stretch of days its games and the ratings before its first.

    A trigger's games go to their stretches; from the first stretch that got any, ratings are taken from its start and played to the end
    again, so a late game changes what comes after it and nothing before. Memory holds one stretch and a batch of rows that come out, for many stretches have a few games only. Stretches that lie more than
    ``keep`` days behind the pool's last day are let go with their games, and games of theirs come out as not accepted; a timer does so for a pool
    that gets no more games, once the watermark is that far.
    """

    def __init__(self, keep: int | None):
        self.keep = keep

    def init(self, handle) -> None:
        self.handle = handle
        self.stretches = handle.getMapState("stretches", "stretch long", "games string, ratings string")
        self.ends = handle.getValueState("ends", "first long, last long, revision long")

    def _let_go(self, upto: int) -> int | None:
        """Forget stretches before ``upto``, but for the newest; the first that stays."""
        known = sorted(k[0] for k in self.stretches.keys())
        for k in known[:-1]:
            if k < upto:
                self.stretches.removeKey((k,))
        return next((k for k in known if k >= upto), known[-1] if known else None)

    def handleInputRows(self, key, rows, timers):  # noqa: N802
        first, last, revision = self.ends.get() if self.ends.exists() else (None, None, 0)
        fresh: dict[int, list] = {}
        for part in rows:
            if part[[c for c in GAMES if c != "game_pk"]].isna().any(axis=None):
                raise ValueError("a game without a date, season or team cannot be rated")
            for day, game, season, home, away, result in zip(*[part[c].tolist() for c in GAMES], strict=True):
                fresh.setdefault(int(day) // STRETCH, []).append((int(day), None if pd.isna(game) else int(game), int(season), int(home), int(away), float(result)))
        late = [k for k in fresh if first is not None and k < first]
        for k in late:
            yield _rated([(key[0], g[1], None, None, False, revision) for g in fresh.pop(k)])
        if not fresh:
            return
        begin, revision = min(fresh), revision + 1
        known = sorted({*fresh, *(k[0] for k in self.stretches.keys())})
        earlier = [k for k in known if k < begin]
        ratings, out = None, []
        for stretch in ([earlier[-1]] if earlier else []) + [k for k in known if k >= begin]:
            stored = self.stretches.getValue((stretch,)) if self.stretches.containsKey((stretch,)) else None
            games = sorted([*(json.loads(stored[0]) if stored else []), *fresh.get(stretch, [])], key=lambda g: (g[0], g[1] is None, g[1] or 0))
            if ratings is None:  # the ratings before the stretch from which games are played again
                kept = json.loads(stored[1]) if stored and earlier else {"ratings": {}, "season": None}
                ratings = elo.Ratings(rating={int(t): r for t, r in kept["ratings"].items()}, season=kept["season"])
            before = json.dumps({"ratings": {str(t): x for t, x in ratings.rating.items()}, "season": ratings.season})
            for day, game, season, home, away, result in games:
                x, y, _ = ratings.play(season, home, away, result)
                if stretch >= begin:
                    out.append((key[0], game, x, y, True, revision))
                last = max(day, last) if last is not None else day
            self.stretches.updateValue((stretch,), (json.dumps(games), before))
            if len(out) >= elo.BATCH:
                yield _rated(out)
                out = []
        if out:
            yield _rated(out)
        if self.keep is not None:
            first = self._let_go((last - self.keep) // STRETCH)
            for t in self.handle.listTimers():
                self.handle.deleteTimer(t)
            self.handle.registerTimer((last + self.keep + 1) * 86_400_000)
        self.ends.update((first, last, revision))

    def handleExpiredTimer(self, key, timers, expired):  # noqa: N802
        first, last, revision = self.ends.get()
        self.ends.update((self._let_go(last // STRETCH), last, revision))
        return iter([])

    def close(self) -> None:
        pass


def live_ratings(stream: DataFrame, pool: str | None = None, keep: int | None = None) -> DataFrame:
    """Pre-game ratings with keyed state: (pool, game_pk, home_elo, away_elo, accepted, revision).

    A late game is put in its place and all games after it come out again under a higher revision, so the highest revision of a game is
    the one of a replay in batch (``last_revisions``). With ``keep`` the state is bounded by so many days; games dated before come out with
    ``accepted`` false and null ratings.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = elo.results(stream, pool)
    mode = "None"
    if keep is not None:
        rows = rows.withColumn("at", F.timestamp_seconds(F.col("day").cast("long") * 86_400)).withWatermark("at", "0 seconds")
        mode = "EventTime"
    return rows.groupBy("pool").transformWithStateInPandas(LateRatings(keep), RATED, "append", mode)


def last_revisions(rated: DataFrame) -> DataFrame:
    """Of each game of a pool the row of its highest revision."""
    return latest_per_key(rated, ["pool", "game_pk"], [F.desc("revision"), F.asc("home_elo")])


def drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over all that has landed and return what it wrote; mode complete keeps the last whole answer."""
    spark, home = stream.sparkSession, sinks.shared_folder(stream.sparkSession, "stream")
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{home}/state").trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").option("path", f"{home}/out").start()
    else:
        query = writer.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{home}/out")).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{home}/out")


def drain_upsert(stream: DataFrame, keys: list[str], by: str, path: str | None = None) -> DataFrame:
    """Changed rows of each trigger replace those of their keys in a versioned table, a new one or one that is there; a trigger that runs twice changes nothing."""
    spark, home = stream.sparkSession, sinks.shared_folder(stream.sparkSession, "stream")
    path = path or f"{home}/table"

    def apply(batch: DataFrame, _: int) -> None:
        if versions.exists(batch.sparkSession, path):
            versions.upsert(batch, path, keys)
        else:
            versions.create(batch, path, by, keys)

    stream.writeStream.outputMode("update").option("checkpointLocation", f"{home}/state").trigger(availableNow=True).foreachBatch(apply).start().awaitTermination()
    return versions.read(spark, path)
