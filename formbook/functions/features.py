"""Derived features of games, teams and pitchers as column expressions; missing inputs have neutral defaults."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from formbook.functions.scalars import clip, elo_probability

#: Weights of the starting pitcher's composite, and of the final ranking.
STARTER_WEIGHTS = {"xera": 0.35, "k_pct": 0.25, "bb_pct": 0.20, "whiff": 0.15, "fbv": 0.05}
RANKING_WEIGHTS = {"anticipation": 0.40, "execution": 0.35, "deterrence": 0.25}


def adjusted_elo(elo: Column, era: Column, league: float = 4.5, scale: float = 40.0, most: float = 60.0) -> Column:
    """Rating moved by the starter's runs below the league's mean, within ``most`` points."""
    return elo + clip((league - F.coalesce(era, F.lit(league))) * scale, -most, most)


def adjusted_home_probability(home: Column, away: Column, bonus: float = 70.0) -> Column:
    return elo_probability(home, away, bonus)


def interactions(c: dict[str, Column]) -> dict[str, Column]:
    """Twelve products and differences of rating, streak, rest, luck and form columns.

    c: probability, expectation_diff, late, home_streak, away_streak, rest_balance, elo_diff, home_luck, away_luck, run_diff, home_7, home_season, away_7, away_season.
    """
    rated = clip(c["elo_diff"] / 400.0, -0.5, 0.5)
    home_late, away_late = c["late"] * clip(c["home_streak"], -5.0, 5.0), c["late"] * clip(c["away_streak"], -5.0, 5.0)
    home_luck, away_luck = clip(c["home_luck"], -0.2, 0.2), clip(c["away_luck"], -0.2, 0.2)
    runs, home_surge, away_surge = clip(c["run_diff"], -10.0, 10.0), c["home_7"] - c["home_season"], c["away_7"] - c["away_season"]
    return {
        "elo_pythag_alignment": clip(c["probability"] - 0.5, -0.5, 0.5) * clip(c["expectation_diff"], -0.5, 0.5),
        "home_late_season_streak": home_late, "away_late_season_streak": away_late, "late_season_streak_diff": home_late - away_late,
        "rest_elo_compound": clip(c["rest_balance"], -1.0, 1.0) * rated,
        "home_regression_pending": home_luck, "away_regression_pending": away_luck, "regression_differential": away_luck - home_luck,
        "run_diff_elo_weighted": runs * rated + runs,
        "home_recent_surge": home_surge, "away_recent_surge": away_surge, "recent_surge_differential": home_surge - away_surge,
    }


def strength(win_10: Column, ema: Column, quality: Column, win_30: Column) -> Column:
    """Composite of recent, weighted, pitching and longer form."""
    return 0.4 * win_10 + 0.3 * ema + 0.2 * quality + 0.1 * win_30


def per_nine(count: Column, innings: Column, default: float) -> Column:
    return F.when(innings > 0, count / innings * 9).otherwise(F.lit(default))


def per_batter(count: Column, faced: Column, default: float) -> Column:
    return F.when(faced > 0, count / faced).otherwise(F.lit(default))


def arsenal_quality(k_minus_bb: Column, xwoba: Column, velocity: Column, mean: float = 93.0, spread: float = 3.0) -> Column:
    """2 x (strikeouts - walks) - xwOBA allowed + a twentieth of the standardised velocity."""
    return 2.0 * k_minus_bb - xwoba + 0.05 * (velocity - mean) / spread


def simple_matchup(lineup: tuple[Column, Column], h2h: tuple[Column, Column], top: tuple[Column, Column], starter: tuple[Column, Column], neutral: float = 0.32) -> Column:
    """(home, away) pairs; head-to-head and top of the order fall back to the whole lineup, then to the neutral value."""

    def side(i: int) -> Column:
        return 3.0 * F.coalesce(lineup[i], F.lit(neutral)) + 2.0 * F.coalesce(h2h[i], lineup[i], F.lit(neutral)) + 1.5 * F.coalesce(top[i], lineup[i], F.lit(neutral))

    starters = 2.0 * (F.coalesce(starter[0], F.lit(neutral)) - F.coalesce(starter[1], F.lit(neutral)))
    return clip((side(0) - side(1) + starters) / 15.0 / 0.15, -1.0, 1.0)


def season_blend(prior: Column, current: Column, played: Column, length: float = 162.0) -> Column:
    """Last season's value gives way to this season's as games are played; one alone stands."""
    w = F.least(played / length, F.lit(1.0))
    return F.coalesce((1 - w) * prior + w * current, current, prior)


def starter_composite(own: dict[str, Column], other: dict[str, Column], default: float = 50.0) -> Column:
    fill = lambda c: F.coalesce(c, F.lit(default))
    return reduce(lambda a, b: a + b, [w * (fill(own[m]) - fill(other[m])) for m, w in STARTER_WEIGHTS.items()])


def park_home_advantage(park: Column, moon: Column) -> Column:
    return park * 0.72 * (1 - 0.05 * moon)


def circadian_offset(instant: Column, zone: Column, best_hour: float = 18.0) -> Column:
    """Hours between the local time of a team's home at the game's own date and the best hour of the day; 0 without a zone."""
    local = F.from_utc_timestamp(instant, zone)
    return F.when(zone.isNull(), F.lit(0.0)).otherwise(F.round(F.hour(local) + F.minute(local) / 60.0 - best_hour, 2))


def divisional(home: Column, away: Column) -> Column:
    return F.coalesce((home == away).cast("int"), F.lit(0))


def interleague(home: Column, away: Column) -> Column:
    """Divisions are named by league and region; the first letter is the league."""
    return F.coalesce((F.substring(home, 1, 1) != F.substring(away, 1, 1)).cast("int"), F.lit(0))


def predicted_winner(p: Column, home: Column, away: Column, threshold: float = 0.5) -> Column:
    return F.when(p >= threshold, home).otherwise(away)


def last_word(name: Column) -> Column:
    return F.element_at(F.split(F.trim(name), r"\s+"), -1)


def hang_time(speed: Column, angle: Column) -> Column:
    return clip(2 * speed * F.sin(F.radians(angle)) / 32.174, 0.5, 8.0)


def catch_baseline(hang: Column) -> Column:
    return 1 / (1 + F.exp(-(hang - 2.0) / 0.5))


def route_deviation(arc: Column, straight: Column) -> Column:
    return arc / (straight + 1e-5)


def first_facts(rules: list[tuple[Column, Column]], most: int) -> Column:
    """Texts of the rules that hold, in the order of the rules, ``most`` of them."""
    return F.slice(F.filter(F.array(*[F.when(c, t) for c, t in rules]), lambda x: x.isNotNull()), 1, most)
