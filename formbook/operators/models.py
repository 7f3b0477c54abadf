"""Outcome models on Spark ML: assembly, walk-forward evaluation, stacking, calibration, ablation and scoring.

Frames carry the features, ``home_won`` and a season. Every fit sees earlier seasons only. Fits read their
frame many times and wait for the slowest part each time: give a table in even parts (``training_table``), not a long plan.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formbook.sources.sinks import stored

LABEL = "home_won"
#: The estimators by name; external boosters are replaced by Spark's gradient-boosted trees.
KINDS = {
    "logistic": lambda **p: LogisticRegression(labelCol=LABEL, **{"regParam": 0.01} | p),
    "forest": lambda **p: RandomForestClassifier(labelCol=LABEL, **{"numTrees": 40, "maxDepth": 5, "seed": 7} | p),
    "perceptron": lambda **p: MultilayerPerceptronClassifier(labelCol=LABEL, **{"maxIter": 120, "seed": 7} | p),
    "boosted": lambda **p: GBTClassifier(labelCol=LABEL, **{"maxIter": 20, "maxDepth": 3, "seed": 7} | p),
}


def training_table(df: DataFrame, key: str = "game_pk") -> DataFrame:
    """``df`` stored in even parts by ``key``, one for each core."""
    return stored(df.repartition(df.sparkSession.sparkContext.defaultParallelism, key), "training")


def preparation(features: list[str]) -> list[Estimator]:
    """Medians for missing values, one vector, unit variance."""
    filled = [f"{c}__filled" for c in features]
    return [Imputer(strategy="median", inputCols=features, outputCols=filled), VectorAssembler(inputCols=filled, outputCol="_raw"), StandardScaler(inputCol="_raw", outputCol="features", withMean=True)]


def fit_each(train: DataFrame, features: list[str], wanted: list[tuple[str, dict]], hidden: tuple[int, ...] = (16, 8), side_by_side: int = 1) -> list[PipelineModel]:
    """A model of each (kind, parameters); medians and variances, which are the same for all of them, are taken once."""
    rows = as_double(train, features).where(F.col(LABEL).isNotNull())
    ready = Pipeline(stages=preparation(features)).fit(rows)
    vectors = ready.transform(rows)

    def one(own: tuple[str, dict]) -> PipelineModel:
        kind, params = own
        if kind == "perceptron":
            params = {"layers": [len(features), *hidden, 2]} | params
        return PipelineModel([*ready.stages, KINDS[kind](**params).fit(vectors)])

    return at_once(train, one, wanted, side_by_side)


def at_once(df: DataFrame, one, tasks: list, side_by_side: int) -> list:
    """``one`` of each task, ``side_by_side`` at a time."""
    with ThreadPoolExecutor(side_by_side) as pool:
        return list(pool.map(inheritable_thread_target(df.sparkSession)(one), tasks))


def fit(train: DataFrame, features: list[str], kind: str = "logistic", hidden: tuple[int, ...] = (16, 8), **params) -> PipelineModel:
    """``hidden``: units of the perceptron's inner layers; its first layer has the features and its last the two classes."""
    return fit_each(train, features, [(kind, params)], hidden)[0]


def as_double(df: DataFrame, features: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in features})


def score(model: PipelineModel, df: DataFrame, features: list[str], name: str = "p") -> DataFrame:
    """All rows in one pass; the given columns and the probability of a home win."""
    keep = df.columns
    return model.transform(as_double(df, features)).select(*keep, vector_to_array("probability")[1].alias(name))


def seasons(df: DataFrame, season: str = "season", least: int = 3) -> list[int]:
    """Seasons with at least ``least`` earlier ones."""
    return sorted(r[0] for r in df.select(season).distinct().collect())[least:]


def walk_forward(df: DataFrame, features: list[str], kind: str = "logistic", season: str = "season", least: int = 3, name: str = "p", side_by_side: int = 4, **params) -> DataFrame:
    """Out-of-fold probabilities: each season is scored by a model of all earlier ones; ``side_by_side`` of them are fitted at a time."""
    folds = seasons(df, season, least)
    if not folds:
        raise ValueError(f"fewer than {least + 1} seasons")
    fitted = at_once(df, lambda s: fit(df.where(F.col(season) < s), features, kind, **params), folds, side_by_side)
    return reduce(DataFrame.unionByName, [score(m, df.where(F.col(season) == s), features, name) for s, m in zip(folds, fitted, strict=True)])


def metrics(scored: DataFrame, p: str = "p", by: list[str] | None = None) -> DataFrame:
    sure = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col(p)))
    loss = -F.avg(F.when(F.col(LABEL) == 1, F.log(sure)).otherwise(F.log(1 - sure)))
    return scored.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n"), F.avg(((F.col(p) >= 0.5).cast("int") == F.col(LABEL)).cast("int")).alias("accuracy"), F.avg(F.pow(F.col(p) - F.col(LABEL), F.lit(2.0))).alias("brier"), loss.alias("log_loss"))


def stacked(df: DataFrame, features: list[str], key: str = "game_pk", kinds: tuple[str, ...] = ("logistic", "forest"), season: str = "season", least: int = 3) -> tuple[DataFrame, list[PipelineModel], PipelineModel]:
    """Base probabilities of unseen seasons, base models on all seasons, and a meta model fitted on the former alone."""
    unseen = [walk_forward(df, features, k, season, least, f"p_{k}").select(key, f"p_{k}") for k in kinds]
    base = reduce(lambda a, b: a.join(b, key), unseen).join(df.select(key, LABEL), key)
    meta = fit(base, [f"p_{k}" for k in kinds])
    return base, [fit(df, features, k) for k in kinds], meta


def stack_score(models: list[PipelineModel], meta: PipelineModel, df: DataFrame, features: list[str], kinds: tuple[str, ...] = ("logistic", "forest")) -> DataFrame:
    scored = df
    for k, m in zip(kinds, models, strict=True):
        scored = score(m, scored, features, f"p_{k}")
    return score(meta, scored, [f"p_{k}" for k in kinds])


def search(df: DataFrame, features: list[str], kind: str, grid: list[dict], season: str = "season", least: int = 3, side_by_side: int = 4) -> DataFrame:
    """Out-of-fold metrics of every parameter set over all walk-forward folds, best log loss first.

    Folds are fitted ``side_by_side`` at a time over ``df`` (give a stored table); each fit sees seasons before its fold alone. A fold's parameter
    sets share its medians and variances and score it in one pass, which leaves one small table of probabilities.
    """
    folds = seasons(df, season, least)
    if not folds:
        raise ValueError(f"fewer than {least + 1} seasons")

    def one(s: int) -> DataFrame:
        scored = df.where((F.col(season) == s) & F.col(LABEL).isNotNull())
        for g, model in enumerate(fit_each(df.where(F.col(season) < s), features, [(kind, p) for p in grid])):
            scored = score(model, scored, features, f"_p{g}")
        each = F.explode(F.array(*[F.struct(F.lit(g).alias("set"), F.col(f"_p{g}").alias("p")) for g in range(len(grid))]))
        return stored(scored.select(F.col(season).alias("fold"), LABEL, each.alias("own")).select("own.set", "fold", LABEL, "own.p"), "search")

    parts = at_once(df, one, folds, side_by_side)
    names = df.sparkSession.createDataFrame([(g, str(p)) for g, p in enumerate(grid)], "set int, params string")
    every = reduce(DataFrame.unionByName, parts)
    return metrics(every, by=["set"]).join(names, "set").drop("set").orderBy("log_loss", "params")


def ablation(df: DataFrame, groups: dict[str, list[str]], kind: str = "logistic", season: str = "season", least: int = 3) -> DataFrame:
    """Log loss without each group of features, and its difference to that of all of them."""
    every = [c for g in groups.values() for c in g]
    parts = [metrics(walk_forward(df, [c for c in every if c not in g], kind, season, least)).withColumn("without", F.lit(n)) for n, g in groups.items()]
    whole = metrics(walk_forward(df, every, kind, season, least)).select(F.col("log_loss").alias("all"))
    return reduce(DataFrame.unionByName, parts).join(whole).withColumn("delta", F.col("log_loss") - F.col("all"))  # one row of ``whole``


def importances(model: PipelineModel, features: list[str]) -> list[tuple[str, float]]:
    last = model.stages[-1]
    values = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    return sorted(((c, abs(float(v))) for c, v in zip(features, values.toArray(), strict=True)), key=lambda x: (-x[1], x[0]))


def select_features(model: PipelineModel, features: list[str], share: float = 0.55, least: int = 30) -> list[str]:
    """The most important share of the features, and ``least`` at least."""
    ranked = [c for c, _ in importances(model, features)]
    return ranked[: max(round(share * len(ranked)), min(least, len(ranked)))]


def calibrators(train: DataFrame, p: str = "p", names: tuple[str, ...] = ("platt", "isotonic")) -> dict[str, PipelineModel]:
    """Platt scaling (a logistic fit on the probability) and isotonic regression."""
    d = train.withColumn(LABEL, F.col(LABEL).cast("double"))
    last = {"platt": LogisticRegression(labelCol=LABEL), "isotonic": IsotonicRegression(labelCol=LABEL)}
    return {n: Pipeline(stages=[VectorAssembler(inputCols=[p], outputCol="features"), last[n]]).fit(d) for n in names}


def calibrated(name: str, model: PipelineModel, df: DataFrame, p: str = "p") -> DataFrame:
    out = model.transform(df)
    value = vector_to_array("probability")[1] if name == "platt" else F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("prediction")))
    return out.select(*df.columns, value.alias("calibrated"))


def choose_calibration(fit_on: DataFrame, hold_out: DataFrame, p: str = "p") -> tuple[str, PipelineModel]:
    """The calibrator with the smaller Brier score on the hold-out, fitted again on all rows."""
    brier = {n: metrics(calibrated(n, m, hold_out, p), "calibrated").first().brier for n, m in calibrators(fit_on, p).items()}
    best = min(sorted(brier), key=brier.get)
    return best, calibrators(fit_on.unionByName(hold_out), p, (best,))[best]


def residual_by_key(df: DataFrame, features: list[str], label: str, key: str, least: int = 1) -> DataFrame:
    """How far each key is above what a boosted model of the features expects, on average."""
    d = as_double(df, [*features, label]).na.drop(subset=[*features, label])
    model = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), GBTRegressor(labelCol=label, maxIter=20, maxDepth=3, seed=7)]).fit(d)
    return model.transform(d).groupBy(key).agg(F.avg(F.col(label) - F.col("prediction")).alias("residual"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
