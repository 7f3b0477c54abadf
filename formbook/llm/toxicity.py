"""Toxicity by a classifier chain.

Categories are predicted one after another. Each has a linear (logistic) model over a selected
vocabulary and a few shape features of the text; the model of a later category also sees
the probabilities of the earlier ones. So that it learns from probabilities like those it will
meet, these are made *out of fold* in training: each fold's documents are predicted by
a model that has not seen them.

The vocabulary holds words and word beginnings, which carry stems through inflected forms. It is
chosen by a chi-squared score over the sample, counted in Spark; each fold's model has a vocabulary of its own, chosen without
the fold, so that out-of-fold probabilities have seen nothing of the held-out labels.

Scale: training sees at most ``sample`` labelled documents, the first by a hash of their ids (and of their texts, where ids have several); with the
vocabulary (at most ``features``) this bounds the sketch of the sample. The models of a category - one for each fold and one
for all - are fitted side by side, each in a task of its own that reads the sketch; the driver gets weights and out-of-fold probabilities. Scoring is one
map over all documents and their whole texts, without a shuffle.

Edge cases: a null or empty text has no words, trains nothing and is scored by the intercept and shape alone; a document trains the
categories of which it has a label; labels of unknown documents are left out; a doc_id with several labels or texts trains with each, and a row
that repeats id and text once; repeated rows are scored alike; without labels of both kinds a category's probability is its share (0 without any labels);
an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formbook.llm.common import materialize, ship

#: Bounds on what training may hold: labelled documents, vocabulary, folds.
SAMPLE, FEATURES, FOLDS = 20_000, 2_000, 5
#: A word or beginning must be in so many labelled documents to be considered.
LEAST_DOCS = 5
BEGINNINGS = (4, 5, 6)
#: Chi-squared scores below this are taken for chance.
LEAST_SCORE = 25.0
_WORD = re.compile(r"[^\W\d_]+")


def terms(text: str | None) -> set[str]:
    """Distinct lower-case words, and their beginnings marked with ~."""
    words = set(_WORD.findall((text or "").lower()))
    return words | {f"{w[:n]}~" for w in words if len(w) >= 4 for n in BEGINNINGS if len(w) >= n}


def shape(text: str | None) -> list[float]:
    """Shares of capitals, digits, signs and repeated words, and the log of the length."""
    t = text or ""
    n = max(len(t), 1)
    letters = sum(map(len, _WORD.findall(t)))
    words = t.split()
    spaces = sum(map(t.count, " \n\t"))
    digits = sum(map(t.count, "0123456789"))
    capitals = sum(map(t.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return [capitals / n, digits / n, (n - letters - digits - spaces) / n, 1 - len(set(words)) / max(len(words), 1), np.log1p(len(words)) / 10]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Rows:
    """Sparse binary features (term indices per row) with dense columns behind them."""

    def __init__(self, indices: list[np.ndarray], dense: np.ndarray, width: int):
        self.flat = np.concatenate(indices) if indices else np.empty(0, np.int64)
        self.row = np.repeat(np.arange(len(indices)), [len(i) for i in indices])
        self.dense, self.width, self.n = dense, width, len(indices)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.flat], self.n) + self.dense @ w[self.width :]

    def transposed(self, r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.flat, r[self.row], self.width), self.dense.T @ r])


def logistic(x: Rows, y: np.ndarray, use: np.ndarray, columns: np.ndarray | None = None, l2: float = 0.002, rounds: int = 120) -> np.ndarray:
    """Weights of a regularised logistic regression (last: intercept) by accelerated gradients with restarts.

    Columns are scaled to unit length first, so that rare terms move as fast as common ones. ``use``: rows to train on; ``columns``: terms that may have a weight.
    """
    keep = use.astype(float)
    length = np.concatenate([np.bincount(x.flat, keep[x.row], x.width), (x.dense**2 * keep[:, None]).sum(0)])
    scale = 1 / np.sqrt(np.maximum(length, 1e-9))
    scale[length == 0] = 0.0
    if columns is not None:
        scale[: x.width][~columns] = 0.0
    dot, transposed = lambda w: x.dot(scale * w), lambda r: scale * x.transposed(keep * r)
    norm = np.ones(len(scale))
    for _ in range(10):  # largest curvature, by power iteration
        norm = transposed(dot(norm))
        norm /= np.linalg.norm(norm) or 1.0
    step = 1.0 / (0.25 * float(norm @ transposed(dot(norm))) * 1.1 + l2)
    penalty = np.full(len(scale), l2)
    penalty[-1] = 0.0
    w = v = np.zeros(len(scale))
    t = 1.0
    for _ in range(rounds):
        grad = transposed(sigmoid(dot(v)) - y) + penalty * v
        new = v - step * grad
        if grad @ (new - w) > 0:
            t = 1.0
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w, v, t = new, new + (t - 1) / t_new * (new - w), t_new
    return w * scale


@dataclass
class Chain:
    categories: list[str]
    vocabulary: dict[str, int] = field(default_factory=dict)
    weights: list[np.ndarray] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)
    quality: list[dict] = field(default_factory=list)

    def indices(self, text: str | None) -> np.ndarray:
        known = self.vocabulary
        return np.array(sorted(known[t] for t in terms(text) if t in known), np.int64)

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        dense = np.array([[*shape(t), 1.0] for t in texts]).reshape(len(texts), -1)
        indices = [self.indices(t) for t in texts]
        seen = np.empty((len(texts), 0))
        for w in self.weights:
            full = np.hstack([dense[:, :-1], logit(seen), dense[:, -1:]])
            seen = np.hstack([seen, sigmoid(Rows(indices, full, len(self.vocabulary)).dot(w))[:, None]])
        return seen


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p)) / 4


def fitted(sketch: DataFrame, category: int, columns: list[np.ndarray], earlier: dict[int, list[float]], folds: int) -> tuple[np.ndarray, dict[int, float]]:
    """Weights of the model of all rows, and each row's out-of-fold probability. ``earlier``: the probabilities of earlier categories by row."""

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "row"], kind="stable")
        which, ids = int(rows["fit"].iloc[0]), rows["row"].to_numpy()
        y, fold = np.array([v[category] for v in rows["y"]], float), rows["fold"].to_numpy()
        seen = np.array([earlier[i] for i in ids]).reshape(len(ids), -1) if earlier else np.empty((len(ids), 0))
        dense = np.hstack([np.array([list(v) for v in rows["shape"]]), logit(seen), np.ones((len(ids), 1))])
        x = Rows([np.asarray(i, np.int64) for i in rows["indices"]], dense, len(columns[which]))
        w = logistic(x, np.maximum(y, 0), (y >= 0) & (fold != which), columns[which])
        held = fold == which
        return pd.DataFrame({"fit": [which], "weights": [w if which == folds else np.empty(0)], "rows": [ids[held]], "held": [sigmoid(x.dot(w))[held]]})

    every = sketch.withColumn("fit", F.explode(F.sequence(F.lit(0), F.lit(folds))))
    found = every.groupBy("fit").applyInPandas(fit, "fit int, weights array<double>, rows array<long>, held array<double>").collect()  # bounded by sample and vocabulary
    weights = next((np.array(r.weights) for r in found if r.fit == folds), np.empty(0))
    return weights, {i: p for r in found for i, p in zip(r.rows, r.held, strict=True)}


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], *, sample: int = SAMPLE, features: int = FEATURES, seed: int = 23) -> Chain:
    """``categories``: name and truth (a boolean column over ``labels``), in the order of the chain."""
    spark = docs.sparkSession
    ship(spark)
    names = list(categories)
    labelled = [F.col(f"y_{i}").isNotNull() for i in range(len(names))]
    truth = labels.select(F.col("doc_id").alias("_id"), *[c.cast("int").alias(f"y_{i}") for i, c in enumerate(categories.values())]).where(F.col("_id").isNotNull() & reduce(Column.__or__, labelled))
    chosen = truth.withColumn("_order", F.xxhash64("_id", F.lit(seed))).orderBy("_order", "_id", *[f"y_{i}" for i in range(len(names))]).limit(sample)
    chosen = F.broadcast(materialize(chosen, "chosen-labels").limit(sample))  # at most ``sample`` rows
    # Rows that repeat id and text train once; only texts with a label travel, and one of their copies from each task.
    known = docs.select("doc_id", "text").where(F.length(F.trim("text")) > 0).join(chosen, F.col("doc_id") == F.col("_id"), "left_semi")
    once = known.groupBy("doc_id", F.xxhash64("text").alias("key"), F.xxhash64(F.lit(1), "text").alias("check")).agg(F.first("text").alias("text"))
    met = once.join(chosen, F.col("doc_id") == F.col("_id"))
    met = met.select("doc_id", "text", F.pmod("_order", F.lit(FOLDS)).cast("int").alias("fold"), F.array(*[F.coalesce(f"y_{i}", F.lit(-1)) for i in range(len(names))]).alias("y"), F.xxhash64("key", "check", "_order").alias("place"))
    met = materialize(met, "labelled")
    if met.count() > sample:  # an id may have very many texts
        met = materialize(met.orderBy("place", "doc_id").limit(sample).repartition(8, "place"), "labelled-bounded")
    kinds = 2 * len(names)  # for each category: documents with a label, and with a true one

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for text, fold, y in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                adds = [(fold * kinds + 2 * i + k, 1) for i, v in enumerate(y) for k in (0, 1) if v >= k]
                for t in terms(text):
                    c = counts.get(t)
                    if c is None:
                        c = counts[t] = [0] * (FOLDS * kinds)
                    for at, n in adds:
                        c[at] += n
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.list_(pa.int32()))], ["term", "n"])

    per_task = met.select("text", "fold", "y").mapInArrow(counted, "term string, n array<int>")
    totals = per_task.groupBy("term").agg(*[F.sum(F.element_at("n", k + 1)).alias(f"n_{k}") for k in range(FOLDS * kinds)])
    most = reduce(Column.__add__, [F.greatest(*[F.col(f"n_{f * kinds + 2 * i}") for i in range(len(names))]) for f in range(FOLDS)])
    totals = materialize(totals.where(most >= LEAST_DOCS), "term-counts")
    flags = [F.element_at("y", i + 1) >= k for i in range(len(names)) for k in (0, 1)]
    whole = {r.fold: list(r)[1:] for r in met.groupBy("fold").agg(*[F.count_if(c).alias(f"c_{i}") for i, c in enumerate(flags)]).collect()}
    chain = Chain(names)
    if not whole:
        return chain
    chosen_terms = [{r.term for r in _best(totals, whole, kinds, held).limit(features).collect()} for held in range(FOLDS + 1)]  # the last leaves no fold out
    every = sorted(set().union(*chosen_terms))
    chain.vocabulary = {t: i for i, t in enumerate(sorted(chosen_terms[-1]))}
    columns = [np.array([t in c for t in every], bool) for c in chosen_terms]
    sketch = met.mapInArrow(_sketch(Chain(names, {t: i for i, t in enumerate(every)})), "doc_id long, fold int, indices array<int>, shape array<double>, y array<int>")
    sketch = materialize(sketch.withColumn("row", F.monotonically_increasing_id()), "sketch")
    y = {r.row: r.y for r in sketch.select("row", "y").collect()}  # at most ``sample`` rows
    earlier: dict[int, list[float]] = {}
    for i in range(len(names)):
        weights, held = fitted(sketch, i, columns, earlier, FOLDS)
        known = [r for r in held if y[r][i] >= 0]
        p, truths = np.array([held[r] for r in known]), np.array([y[r][i] for r in known])
        # The threshold with the fewest errors out of fold; between equals, the one nearest to one half.
        tries = np.linspace(0.2, 0.8, 61)
        errors = [int(((p >= t) != (truths == 1)).sum()) for t in tries]
        at = min(range(len(tries)), key=lambda j: (errors[j], abs(tries[j] - 0.5)))
        hit = p >= tries[at]
        chain.weights.append(np.concatenate([weights[: len(every)][columns[-1]], weights[len(every) :]]))
        chain.thresholds.append(float(tries[at]))
        chain.quality.append({"recall": float(hit[truths == 1].mean()) if (truths == 1).any() else 1.0, "false_positives": float(hit[truths == 0].mean()) if (truths == 0).any() else 0.0})
        earlier = {r: [*earlier.get(r, []), q] for r, q in held.items()}
    return chain


def _best(totals: DataFrame, whole: dict[int, list[int]], kinds: int, held: int) -> DataFrame:
    """Terms by their best chi-squared score over the categories, counted without the fold ``held``."""
    folds = [f for f in range(FOLDS) if f != held]
    chi = F.lit(0.0)
    for k in range(0, kinds, 2):
        n, pos = (float(sum(whole[f][k + j] for f in folds if f in whole)) for j in (0, 1))
        if 0 < pos < n:
            b, a = (reduce(Column.__add__, [F.col(f"n_{f * kinds + k + j}") for f in folds]).cast("double") for j in (0, 1))
            chi = F.greatest(chi, F.coalesce(n * F.pow(a * n - b * pos, 2) / F.nullif(b * pos * (n - b + 0.5) * (n - pos), F.lit(0.0)), F.lit(0.0)))
    return totals.select("term", chi.alias("chi")).where(F.col("chi") >= LEAST_SCORE).orderBy(F.desc("chi"), "term")


def _sketch(chain: Chain):
    """What training needs of a document: its fold, vocabulary indices, shape and labels."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([chain.indices(t).tolist() for t in texts], pa.list_(pa.int32())), pa.array([shape(t) for t in texts], pa.list_(pa.float64())), batch.column(3)],
                ["doc_id", "fold", "indices", "shape", "y"],
            )

    return of


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """(doc_id, p_<category>..., <last category>) of every row: the last category's verdict is a boolean."""
    ship(docs.sparkSession)
    names = chain.categories

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                p = chain.probabilities(batch.column(1).to_pylist()) if chain.weights else np.zeros((batch.num_rows, len(names)))
                verdict = p[:, -1] >= chain.thresholds[-1] if chain.weights else np.zeros(batch.num_rows, bool)
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in p.T], pa.array(verdict)], ["doc_id", *[f"p_{n}" for n in names], names[-1]])

    ddl = "doc_id long, " + ", ".join(f"p_{n} double" for n in names) + f", {names[-1]} boolean"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(of, ddl)


def without_toxic(docs: DataFrame, chain: Chain) -> DataFrame:
    """The rows of ``docs`` that the chain's last category does not reject, in one pass over the texts."""
    ship(docs.sparkSession)
    at = docs.columns.index("text")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not chain.weights or not batch.num_rows:
                yield batch
                continue
            yield batch.filter(pa.array(chain.probabilities(batch.column(at).to_pylist())[:, -1] < chain.thresholds[-1]))

    return docs.mapInArrow(of, docs.schema)


def label_chain(docs: DataFrame, labels: DataFrame, **how) -> Chain:
    """The chain of the label table: low quality first, whose probability the toxic model sees."""
    return train(docs, labels, {"junk": F.col("quality") == 0, "toxic": F.col("toxic") == 1}, **how)
