"""Between game grain and team grain, and small reshapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP = ["game_pk", "game_date", "season"]


def to_team_grain(games: DataFrame) -> DataFrame:
    """Two rows per game from one scan; a win needs strictly more runs."""

    def side(own: str, other: str) -> Column:
        return F.struct(
            F.lit(own == "home").alias("is_home"), F.col(f"{own}_team_id").alias("team_id"), F.col(f"{other}_team_id").alias("opponent_id"),
            F.col(f"{own}_score").alias("runs"), F.col(f"{other}_score").alias("runs_allowed"), (F.col(f"{own}_score") > F.col(f"{other}_score")).cast("int").alias("won"),
        )

    return games.select(*KEEP, F.explode(F.array(side("home", "away"), side("away", "home"))).alias("s")).select(*KEEP, "s.*")


def to_game_grain(teams: DataFrame, columns: list[str]) -> DataFrame:
    """Team rows back to home_ and away_ columns in one grouping."""
    picks = [F.max(F.when(F.col("is_home") == home, F.col(c))).alias(f"{side}_{c}") for side, home in (("home", True), ("away", False)) for c in columns]
    return teams.groupBy(*KEEP).agg(*picks)


def one_hot(df: DataFrame, column: str, levels: list, prefix: str) -> DataFrame:
    return df.withColumns({f"{prefix}_{v}": (F.col(column) == v).cast("int") for v in levels})


def bucketize(column: Column, edges: list[float], labels: list[str]) -> Column:
    """Right-closed buckets; the last is open."""
    out = F.lit(None).cast("string")
    for low, high, label in reversed(list(zip(edges, [*edges[1:], float("inf")], labels, strict=True))):
        out = F.when((column > low) & (column <= high), label).otherwise(out)
    return out
