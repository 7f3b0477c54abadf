"""The sports schema over the given tables, and readers for landed files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per game, from ``orders``."""
    return as_games(table(spark, sf_dir, "orders"))


def leagues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The games in leagues of thirty teams whose teams never meet those of another."""
    return as_leagues(table(spark, sf_dir, "orders"))


def as_leagues(orders: DataFrame) -> DataFrame:
    return as_games(orders, F.expr("o_custkey div 30").alias("league"))


def as_games(orders: DataFrame, *more: Column) -> DataFrame:
    key, cust, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    return orders.select(
        key.alias("game_pk"), F.to_date("o_orderdate").alias("game_date"), F.year("o_orderdate").cast("long").alias("season"),
        (cust % 30).alias("home_team_id"), ((cust + 1 + key % 29) % 30).alias("away_team_id"),
        (F.floor(price) % 11).alias("home_score"), (F.floor(price / 11) % 11).alias("away_score"),
        (cust % 30).alias("venue_id"), F.col("o_orderstatus").alias("status_code"), *more,
    )


def pitches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per pitch, from ``events``."""
    return as_pitches(table(spark, sf_dir, "events"))


def as_pitches(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    user = F.col("user_id")
    event = F.create_map(*[F.lit(x) for kv in {"purchase": "home_run", "signup": "single", "click": "walk", "error": "strikeout", "view": "field_out"}.items() for x in kv])
    return events.select(
        F.col("event_id").alias("pitch_id"), (user % 50).alias("pitcher"), k.alias("batter"), F.to_date("ts").alias("game_date"), "ts",
        event[F.col("event_type")].alias("events"), F.col("value").alias("release_speed"),
        F.when(user % 3 == 0, "L").otherwise("R").alias("p_throws"), F.when(k % 2 == 0, "L").otherwise("R").alias("stand"),
        (1 + F.col("event_id") % 9).alias("inning"), F.when(F.col("event_id") % 2 == 0, "Top").otherwise("Bot").alias("inning_topbot"),
        (F.dayofmonth("ts") * 10 + user % 10).cast("long").alias("game_pk"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("game_pk"), F.col("toxic").cast("long").alias("y"), ((F.col("doc_id") * 37 % 100) / 100.0).alias("p"))


def read_years(spark: SparkSession, directories: list[str], pattern: str, years: list[int], year_col: str = "season") -> DataFrame:
    """Per-year Parquet files: for each year the first directory that has its file wins; the year is added where it is missing."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for year in years:
        for d in directories:
            path = f"{d}/{pattern.format(year=year)}"
            if hadoop.Path(path).getFileSystem(conf).exists(hadoop.Path(path)):
                df = spark.read.parquet(path)
                found.append(df if year_col in df.columns else df.withColumn(year_col, F.lit(year)))
                break
    if not found:
        raise FileNotFoundError(f"none of {years} under {directories}")
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def read_results_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Finished regular-season games of a CSV file."""
    return spark.read.csv(path, header=True, schema=schema).where("status_code = 'F' AND game_type = 'R'")


def known_columns(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.select([c for c in keep if c in df.columns])


SCHEDULE = (
    "dates array<struct<games: array<struct<gamePk: bigint, gameDate: string, status: struct<abstractGameState: string>,"
    "teams: struct<home: struct<score: int, team: struct<id: bigint, name: string>>, away: struct<score: int, team: struct<id: bigint, name: string>>>, venue: struct<id: bigint, name: string>>>>>"
)


def schedule_games(raw: DataFrame, json_col: str = "body", include_final: bool = False) -> DataFrame:
    """Schedule payloads to one row per game; finished games only on demand."""
    game = raw.select(F.explode_outer(F.from_json(json_col, SCHEDULE)["dates"]).alias("d")).select(F.explode("d.games").alias("g"))
    out = game.select(
        F.col("g.gamePk").alias("game_pk"), F.to_timestamp("g.gameDate").alias("game_ts"), F.col("g.status.abstractGameState").alias("status"), F.col("g.teams.home.team.id").alias("home_team_id"),
        F.col("g.teams.away.team.id").alias("away_team_id"), F.col("g.teams.home.score").alias("home_score"), F.col("g.teams.away.score").alias("away_score"), F.col("g.venue.name").alias("venue_name"),
    )
    return out if include_final else out.where(~F.col("status").eqNullSafe("Final"))


BOXSCORE = "game_pk bigint, players map<string, struct<person: struct<id: bigint, fullName: string>, battingOrder: string, status: string, probable: boolean>>"


def boxscore_lineups(raw: DataFrame, json_col: str = "body") -> DataFrame:
    """Boxscores keyed by player: batting orders 100..900 to slots 1..9; starters have whole hundreds."""
    box = raw.select(F.from_json(json_col, BOXSCORE).alias("b")).select("b.game_pk", F.explode(F.map_entries("b.players")).alias("p"))
    order = F.col("p.value.battingOrder").try_cast("int")
    return box.select(
        "game_pk", F.col("p.value.person.id").alias("player_id"), F.col("p.value.person.fullName").alias("player_name"), F.floor(order / 100).cast("int").alias("batting_order"),
        F.coalesce(order % 100 == 0, F.lit(False)).alias("is_starter"), F.coalesce("p.value.probable", F.lit(False)).alias("is_probable_pitcher"),
    ).where("batting_order IS NOT NULL OR is_probable_pitcher")


def read_pitch_csv(spark: SparkSession, path: str, keep: list[str]) -> DataFrame:
    """A pitch feed's CSV files with the known columns alone, as strings."""
    return known_columns(spark.read.csv(path, header=True), keep)


def between_dates(df: DataFrame, date: str, first: str, until: str) -> DataFrame:
    """Rows of [first, until): literals, so that partitions and row groups are pruned."""
    return df.where((F.col(date) >= F.lit(first).cast("date")) & (F.col(date) < F.lit(until).cast("date")))


def restricted(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is listed; the list is a table, of any length."""
    return df.join(keys.select(key).distinct(), key, "left_semi")


RESULTS = (
    "dates array<struct<games: array<struct<gamePk: string, officialDate: string, seriesGameNumber: int, gamesInSeries: int, status: struct<detailedState: string>,"
    "teams: struct<home: struct<score: int, team: struct<id: string>, probablePitcher: struct<id: string>>, away: struct<score: int, team: struct<id: string>, probablePitcher: struct<id: string>>>>>>>"
)


def season_results(raw: DataFrame, json_col: str = "body") -> DataFrame:
    """Finished games of landed schedule payloads, with series context and probable starters; ids that are no numbers are null."""
    g = raw.select(F.explode(F.from_json(json_col, RESULTS)["dates"]).alias("d")).select(F.explode("d.games").alias("g")).where("g.status.detailedState = 'Final'")
    number = lambda c: F.col(c).try_cast("long")
    return g.select(
        number("g.gamePk").alias("game_pk"), F.to_date("g.officialDate").alias("game_date"), number("g.teams.home.team.id").alias("home_team_id"), number("g.teams.away.team.id").alias("away_team_id"),
        F.col("g.teams.home.score").alias("home_score"), F.col("g.teams.away.score").alias("away_score"), number("g.teams.home.probablePitcher.id").alias("home_starter_id"),
        number("g.teams.away.probablePitcher.id").alias("away_starter_id"), F.col("g.seriesGameNumber").alias("series_game_number"), F.col("g.gamesInSeries").alias("games_in_series"),
    )


def typed_landing(raw: DataFrame, fields: dict[str, tuple[str, str]], json_col: str = "body") -> DataFrame:
    """A raw landing table as a typed one. fields: column -> (JSON path, type); what does not parse is null."""
    return raw.select(*[F.get_json_object(json_col, path).try_cast(kind).alias(c) for c, (path, kind) in fields.items()])
