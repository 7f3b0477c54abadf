"""Matchups of lineups and starters from pitches: who started, who batted where, and what each had done on earlier days.

Careers are sums for each key and day, added up over days and met as of the day before a game (``asof``), so nothing of the
game's own day or of later ones is read, and a batter who did not meet a pitcher on a day still has what he did against him before.
Rows of a career are days, never pitches, and each meeting of careers and lineups is one window over one exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formbook.operators import asof, dedup

GAME = ["game_date", "game_pk"]
HALF = [*GAME, "inning_topbot"]
#: Least plate appearances of a career and of a pairing, value of an unknown lineup or starter, and of its strikeouts.
LEAST_CAREER, LEAST_PAIR, NEUTRAL, NEUTRAL_K = 20, 5, 0.320, 0.20
COUNTS = ["pa", "k", "bb", "hr", "num"]


def starters(p: DataFrame) -> DataFrame:
    """(game, half, pitcher, p_throws): most pitches in innings 1 to 3, ties to the smaller id."""
    thrown = p.where("inning <= 3").groupBy(*HALF, "pitcher").agg(F.count(F.lit(1)).alias("n"), F.max("p_throws").alias("p_throws"))
    return dedup.latest_per_key(thrown, HALF, [F.desc("n"), F.asc("pitcher")]).drop("n")


def lineups(p: DataFrame, slots: int = 9) -> DataFrame:
    """(game, half, batter, stand, slot): batters by their first appearance."""
    seen = p.where("batter IS NOT NULL").groupBy(*HALF, "batter").agg(F.min("pitch_id").alias("first_at"), F.min_by("stand", "pitch_id").alias("stand"))
    return dedup.top_k(seen, HALF, [F.asc("first_at"), F.asc("batter")], slots, "slot").drop("first_at")


def days(p: DataFrame, value: Column) -> DataFrame:
    """Sums of plate appearances, strikeouts, walks, home runs and hitting value (in thousandths) by batter, pitcher, hand and day: what all careers add up."""
    is_ = lambda e: F.count_if(F.col("events") == e)
    return p.where("batter IS NOT NULL AND events IS NOT NULL").groupBy("batter", "pitcher", "p_throws", "game_date").agg(F.count(F.lit(1)).alias("pa"), is_("strikeout").alias("k"), is_("walk").alias("bb"), is_("home_run").alias("hr"), F.sum(value).alias("num"))


def career(day: DataFrame, by: list[str], prefix: str) -> DataFrame:
    """Running sums up to and with each day of a key."""
    w = W.partitionBy(*by).orderBy("game_date").rowsBetween(W.unboundedPreceding, 0)
    per = day.groupBy(*by, "game_date").agg(*[F.sum(c).alias(c) for c in COUNTS])
    return per.select(*by, F.col("game_date").alias("day"), *[F.sum(c).over(w).alias(f"{prefix}{c}") for c in COUNTS])


def before(rows: DataFrame, day: DataFrame, by: list[str], prefix: str) -> DataFrame:
    """``rows`` with the sums of their key over the days before theirs; null without any."""
    return asof.as_of(rows, career(day, by, prefix), by, "game_date", "day", [f"{prefix}{c}" for c in COUNTS], strict=True)


def table(p: DataFrame, value: Column, least: int = LEAST_CAREER, least_pair: int = LEAST_PAIR) -> DataFrame:
    """One row for each game with both halves: both lineups against the hand and the person of the starter they face, both starters, and the differences."""
    c, day = F.col, days(p, value)
    faced = lineups(p).join(starters(p), HALF)
    met = before(before(faced, day, ["batter", "p_throws"], "h_"), day, ["batter", "pitcher"], "b_")

    def rate(of: str, prefix: str, ok: Column) -> Column:
        total = F.sum(F.when(ok, c(f"{prefix}{of}")))
        return total / F.nullif(F.sum(F.when(ok, c(f"{prefix}pa"))), F.lit(0)) / (1000.0 if of == "num" else 1.0)

    known, paired = c("h_pa") >= least, c("b_pa") >= least_pair
    side = met.groupBy(*HALF, "pitcher", "p_throws").agg(
        rate("num", "h_", known).alias("lineup_woba_vs_hand"), rate("k", "h_", known).alias("lineup_k_pct_vs_hand"), rate("bb", "h_", known).alias("lineup_bb_pct_vs_hand"),
        rate("num", "h_", known & (c("slot") <= 3)).alias("top3_woba_vs_hand"), rate("num", "h_", known & c("slot").between(4, 7)).alias("middle4_woba_vs_hand"), rate("num", "h_", known & (c("slot") >= 8)).alias("bottom2_woba_vs_hand"),
        F.avg((c("stand") == c("p_throws")).cast("double")).alias("pct_same_hand"), F.sum(F.coalesce("b_pa", F.lit(0))).alias("h2h_pa_total"),
        rate("num", "b_", paired).alias("h2h_woba"), rate("k", "b_", paired).alias("h2h_k_pct"), rate("hr", "b_", paired).alias("h2h_hr_rate"),
    )
    side = before(side, day, ["pitcher"], "s_").withColumns({
        "starter_woba_allowed": F.coalesce(F.when(c("s_pa") >= least, c("s_num") / c("s_pa") / 1000.0), F.lit(NEUTRAL)), "starter_k_pct": F.coalesce(F.when(c("s_pa") >= least, c("s_k") / c("s_pa")), F.lit(NEUTRAL_K)),
    })
    batting = [x for x in side.columns if "_vs_hand" in x or x.startswith("h2h") or x == "pct_same_hand"]
    # The top half: the away side bats against the home side's starter.
    roles = {"Top": ("away", "home"), "Bot": ("home", "away")}
    pick = lambda half, x: F.max(F.when(c("inning_topbot") == half, c(x)))
    columns = [pick(half, x).alias(f"{bat}_{x}") for half, (bat, _) in roles.items() for x in batting]
    columns += [pick(half, x).alias(f"{pitch}_{y}") for half, (_, pitch) in roles.items() for x, y in (("pitcher", "starter_id"), ("p_throws", "starter_hand"), ("starter_woba_allowed", "starter_woba_allowed"), ("starter_k_pct", "starter_k_pct"))]
    wide = side.groupBy(*GAME).agg(F.count_distinct("inning_topbot").alias("halves"), *columns).where("halves = 2").drop("halves")
    return wide.withColumns(differences())


def differences() -> dict[str, Column]:
    """Home against away; an unknown value is the neutral one."""
    of = lambda side, x, d=NEUTRAL: F.coalesce(f"{side}_{x}", F.lit(d))
    lineup = lambda side: of(side, "lineup_woba_vs_hand")
    weighed = lambda side: 3.0 * lineup(side) + 2.0 * F.coalesce(f"{side}_h2h_woba", lineup(side)) + 1.5 * F.coalesce(f"{side}_top3_woba_vs_hand", lineup(side))
    return {
        "lineup_woba_differential": lineup("home") - lineup("away"), "starter_woba_differential": F.col("away_starter_woba_allowed") - F.col("home_starter_woba_allowed"),
        "matchup_advantage_home": (weighed("home") - weighed("away") - 2.0 * F.col("home_starter_woba_allowed") + 2.0 * F.col("away_starter_woba_allowed")) / 15.0 / 0.15,
        "h2h_woba_differential": of("home", "h2h_woba") - of("away", "h2h_woba"), "lineup_k_pct_differential": of("away", "lineup_k_pct_vs_hand", NEUTRAL_K) - of("home", "lineup_k_pct_vs_hand", NEUTRAL_K),
    }


def bullpen(p: DataFrame, team: Column, length: int = 7) -> DataFrame:
    """(team, game_date, pitches, appearances, innings, fatigue, closer, closer_rest): a team's relief load over the ``length`` days before each of its days.

    Relievers throw after the first inning. Fatigue is the load with a weight that falls by a seventh for each day back; the closer is who threw most in the last inning before.
    """
    c = F.col
    used = p.where("inning > 1").withColumn("team", team).groupBy("team", "game_date").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("pitcher").alias("who"), F.count_distinct("game_pk", "inning").alias("inn"), F.sum((c("inning") >= 9).cast("int")).alias("late"))
    back = W.partitionBy("team").orderBy(F.unix_date("game_date")).rangeBetween(-length, -1)
    at = F.unix_date("game_date")
    weighted = F.sum(c("n") * at).over(back) - (at - length - 1) * F.sum("n").over(back)  # sum of n * (length + 1 - days back)
    load = used.select("team", "game_date", *[F.coalesce(F.sum(x).over(back), F.lit(0)).alias(y) for x, y in (("n", "pitches"), ("who", "appearances"), ("inn", "innings"))], (F.coalesce(weighted, F.lit(0)) / float(length)).alias("fatigue"))
    late = p.where("inning >= 9").withColumn("team", team).groupBy("team", "pitcher", "game_date").agg(F.count(F.lit(1)).alias("n"))
    so_far = late.withColumn("total", F.sum("n").over(W.partitionBy("team", "pitcher").orderBy("game_date").rowsBetween(W.unboundedPreceding, 0)))
    # The leader changes on days when somebody threw: the most of a day's totals against the most so far.
    day_best = so_far.groupBy("team", "game_date").agg(F.max(F.struct("total", -c("pitcher"), c("game_date").alias("on"))).alias("top"))
    leader = day_best.withColumn("top", F.max("top").over(W.partitionBy("team").orderBy("game_date").rowsBetween(W.unboundedPreceding, 0)))
    leader = leader.select("team", c("game_date").alias("day"), (-c("top.col2")).alias("closer"), c("top.on").alias("closed_on"))
    met = asof.as_of(load, leader, ["team"], "game_date", "day", ["closer", "closed_on"], strict=True)
    return met.withColumn("closer_rest", F.datediff("game_date", "closed_on")).drop("closed_on")


def at_venue(p: DataFrame, value: Column, venue: Column, least: int = 5) -> DataFrame:
    """(game, half, starter_at_venue_woba, lineup_at_venue_woba): what the starter allowed and the batters hit at the game's venue before; neutral under ``least``."""
    c, here = F.col, p.withColumn("venue", venue)
    per = here.where("batter IS NOT NULL AND events IS NOT NULL").groupBy("batter", "pitcher", "venue", "game_date").agg(F.count(F.lit(1)).alias("pa"), F.sum(value).alias("num"), *[F.lit(0).alias(x) for x in ("k", "bb", "hr")])
    place = here.select(*GAME, "venue").distinct()
    own = before(starters(p).join(place, GAME), per, ["pitcher", "venue"], "v_")
    bats = before(lineups(p).join(place, GAME), per, ["batter", "venue"], "v_").groupBy(*HALF).agg(F.sum("v_num").alias("num"), F.sum("v_pa").alias("pa"))
    rate = lambda num, pa: F.coalesce(F.when(c(pa) >= least, c(num) / c(pa) / 1000.0), F.lit(NEUTRAL))
    return own.select(*HALF, rate("v_num", "v_pa").alias("starter_at_venue_woba")).join(bats.select(*HALF, rate("num", "pa").alias("lineup_at_venue_woba")), HALF, "left").fillna(NEUTRAL, ["lineup_at_venue_woba"])


def recent(p: DataFrame, value: Column, by: str, length: int, fallback: int) -> DataFrame:
    """(by, game_date, velocity, woba, kbb): means over the ``length`` days before each day of a pitcher or batter, of ``fallback`` days where there are none."""
    is_ = lambda e: F.count_if(F.col("events") == e)
    per = p.where(F.col(by).isNotNull()).groupBy(by, "game_date").agg(F.sum("release_speed").alias("s"), F.count("release_speed").alias("n"), F.count("events").alias("pa"), F.sum(value).alias("num"), (is_("strikeout") - is_("walk")).alias("kbb"))
    w = lambda n: W.partitionBy(by).orderBy(F.unix_date("game_date")).rangeBetween(-n, -1)
    ratio = lambda a, b, n: F.sum(a).over(w(n)) / F.nullif(F.sum(b).over(w(n)), F.lit(0))
    either = lambda a, b: F.coalesce(ratio(a, b, length), ratio(a, b, fallback))
    return per.select(by, "game_date", either("s", "n").alias("velocity"), (either("num", "pa") / 1000.0).alias("woba"), either("kbb", "pa").alias("kbb"))


def venue_lift(p: DataFrame, value: Column, venue: Column, least: int = 3) -> DataFrame:
    """(game, half, venue_lift): how much better the lineup hit at the game's venue before than everywhere before, each batter weighed by his plate appearances there."""
    c, here = F.col, p.withColumn("venue", venue)
    none = [F.lit(0).alias(x) for x in ("k", "bb", "hr")]
    per = here.where("batter IS NOT NULL AND events IS NOT NULL").groupBy("batter", "venue", "game_date").agg(F.count(F.lit(1)).alias("pa"), F.sum(value).alias("num"), *none)
    rows = lineups(p).join(here.select(*GAME, "venue").distinct(), GAME)
    met = before(before(rows, per, ["batter", "venue"], "v_"), per, ["batter"], "c_")
    known = c("v_pa") >= least
    lift = (c("v_num") / c("v_pa") - c("c_num") / c("c_pa")) / 1000.0
    return met.groupBy(*HALF).agg((F.sum(F.when(known, lift * c("v_pa"))) / F.sum(F.when(known, c("v_pa")))).alias("venue_lift"))


def sided(rows: DataFrame, columns: list[str], top: str, bottom: str) -> DataFrame:
    """Rows of halves as one row for each game: columns of the top half get the prefix ``top``, those of the bottom half ``bottom``."""
    pick = lambda half, x: F.max(F.when(F.col("inning_topbot") == half, F.col(x)))
    return rows.groupBy(*GAME).agg(*[pick(h, x).alias(f"{side}_{x}") for h, side in (("Top", top), ("Bot", bottom)) for x in columns])


def joined(tables: list[DataFrame]) -> DataFrame:
    """Tables of games beside each other; games of the first stay."""
    return reduce(lambda a, b: a.join(b, GAME, "left"), tables)
