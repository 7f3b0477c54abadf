"""Column expressions: rating, expectation, calendar and rule functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def elo_probability(a: Column, b: Column, bonus: float = 0.0) -> Column:
    return 1 / (1 + F.pow(F.lit(10.0), (b - a - bonus) / 400))


def pythagorean(scored: Column, allowed: Column, exponent: float = 1.83) -> Column:
    """Expected share of wins; one half without runs."""
    s, a = F.pow(scored.cast("double"), F.lit(exponent)), F.pow(allowed.cast("double"), F.lit(exponent))
    return F.when(scored + allowed > 0, s / (s + a)).otherwise(F.lit(0.5))


def ratio(a: Column, b: Column) -> Column:
    """Null where the denominator is zero or null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def shrunken(rate: Column, n: Column, prior: float, strength: float = 50.0, least: int = 5) -> Column:
    """Empirical-Bayes rate; null under ``least`` observations."""
    w = n / (n + strength)
    return F.when(n >= least, w * rate + (1 - w) * prior)


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def innings(text: Column) -> Column:
    """``123.1`` is 123 and one third."""
    whole, part = F.split_part(text, F.lit("."), F.lit(1)).try_cast("double"), F.split_part(text, F.lit("."), F.lit(2)).try_cast("double")
    return whole + F.coalesce(part, F.lit(0.0)) / 3


def moon_illumination(date: Column) -> Column:
    """From the mean synodic month since the new moon of 2000-01-06."""
    phase = F.pmod(F.datediff(date, F.lit("2000-01-06").cast("date")).cast("double"), F.lit(29.53059)) / 29.53059
    return F.pow(F.sin(phase * F.pi()), F.lit(2.0))


def confidence_tier(p: Column, high: float = 0.64, medium: float = 0.57) -> Column:
    best = F.greatest(p, 1 - p)
    return F.when(best >= high, "high").when(best >= medium, "medium").otherwise("low")


def season_stage(played: Column, early: int = 40, middle: int = 120) -> Column:
    return F.when(played < early, "early").when(played < middle, "middle").otherwise("late")


def weighted_present(parts: list[tuple[Column, float]], scale: float = 1.0, limit: float = 1.0) -> Column:
    """Weighted mean of the parts that are not null, scaled and clipped; 0 if none is there."""
    total = sum((F.coalesce(c * w, F.lit(0.0)) for c, w in parts), F.lit(0.0))
    weight = sum((F.when(c.isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for c, w in parts), F.lit(0.0))
    return F.when(weight > 0, clip(total / weight / scale, -limit, limit)).otherwise(F.lit(0.0))


def beta_posterior(hits: Column, n: Column, a: float = 2.0, b: float = 2.0) -> tuple[Column, Column]:
    """Mean and standard deviation of the beta-binomial posterior."""
    x, y = hits + a, n - hits + b
    return x / (x + y), F.sqrt(x * y / (F.pow(x + y, F.lit(2.0)) * (x + y + 1)))
