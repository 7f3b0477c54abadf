"""Registered queries of trained models; SQL cannot express them, tests hold them against plain rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from formbook.functions import scalars as S
from formbook.operators import models
from formbook.plans.catalog import r6, register
from formbook.plans.features import m1_training_set
from formbook.sources.sinks import stored
from formbook.sources.tables import pitches

FEATURES = ["home_form", "home_scored", "home_allowed", "away_form", "away_scored", "away_allowed", "month", "weekday"]


def split(spark, d):
    rows = models.training_table(m1_training_set(spark, d))
    last = max(models.seasons(rows, least=1))
    return rows.where(F.col("season") < last), rows.where(F.col("season") == last)


@register()
def m15_m16_m22_scored_season(spark, d):
    """All games of the last season, scored by a logistic model of the earlier ones."""
    before, target = split(spark, d)
    scored = models.score(models.fit(before, FEATURES), target, FEATURES)
    return scored.select("game_pk", "home_won", r6(F.col("p"), "p"), S.confidence_tier(F.col("p")).alias("tier"))


@register()
def m21_calibrated_season(spark, d):
    """Probabilities of unseen seasons, calibrated on the earlier of them."""
    rows = models.training_table(m1_training_set(spark, d))
    unseen = stored(models.walk_forward(rows, FEATURES).select("game_pk", "season", "home_won", "p"))
    last = max(models.seasons(rows, least=1))
    name, model = models.choose_calibration(unseen.where(F.col("season") < last - 1), unseen.where(F.col("season") == last - 1))
    return models.calibrated(name, model, unseen.where(F.col("season") == last)).select("game_pk", "home_won", r6(F.col("p"), "p"), r6(F.col("calibrated"), "calibrated"), F.lit(name).alias("method"))


@register()
def m29_pitcher_scores(spark, d):
    """Composite of a Beta posterior, the residual of a boosted model and a rate: .40, .35, .25 of their scaled values."""
    p = pitches(spark, d).withColumn("out", F.col("events").isin("strikeout", "field_out").cast("int"))
    mean, _ = S.beta_posterior(F.sum("out"), F.count(F.lit(1)))
    rate = p.groupBy("pitcher").agg(mean.alias("posterior"), (0.3 * F.avg("out")).alias("arm"))
    residual = models.residual_by_key(p.where("batter IS NOT NULL"), ["inning", "batter"], "release_speed", "pitcher")
    both = rate.join(residual.select("pitcher", "residual"), "pitcher")
    ends = both.agg(*[f(c).alias(f"{n}_{c}") for c in ("posterior", "residual", "arm") for n, f in (("lo", F.min), ("hi", F.max))])  # one row
    scaled = lambda c: (F.col(c) - F.col(f"lo_{c}")) / (F.col(f"hi_{c}") - F.col(f"lo_{c}") + 1e-6) * 100
    return both.join(F.broadcast(ends)).select("pitcher", r6(F.col("posterior"), "posterior"), r6(F.col("residual"), "residual"), r6(0.40 * scaled("posterior") + 0.35 * scaled("residual") + 0.25 * scaled("arm"), "score"))
