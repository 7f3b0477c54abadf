"""Approximate nearest neighbours by learned partitions.

On a bounded sample the neighbour graph is built exactly and cut into balanced parts (nearest means within a
capacity, then moves that bring neighbours together within it). A small
network, whose linear part starts at the parts' means, learns which parts hold a vector's neighbours. It deals every vector of the table to its most
probable part, and routes a query to its several most probable parts, where all vectors are
reranked by exact distance. How many parts a query visits is chosen on sample
vectors kept out of training, so that they find ``aim`` of their true neighbours.

Scale: the model is a few hundred kB whatever the table's size, and is the only thing broadcast. There are as many parts
as leave ``PART_ROWS`` sample rows to each, at most ``parts``. A
part is dealt out in blocks of about ``block`` vectors and ``asked_block`` queries by hashes, so a part (or
a vector) that holds a third of all rows fills more blocks, not a larger one; a query goes to each
block of its parts and brings home at most k rows from each, and a task never holds more than one block of either side.

Edge cases: vectors that are null, empty, zero, of another length than most, or that hold null or
non-finite components take no part, nor do rows with a null id; ties go to the smaller id; repeated
rows are candidates of their own; a query with fewer candidates than k gets them all that it is routed to; a table of fewer than
twice ``PART_ROWS`` rows is one part; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formbook.llm.common import materialize, ship

#: Bounds: rows that the model is fitted on, parts, neighbours in the graph, hidden units.
SAMPLE, PARTS, DEGREE, HIDDEN = 6000, 128, 10, 96
#: Sample rows that a part has at least, on average.
PART_ROWS = 40


def usable(v: Column) -> Column:
    fine = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def neighbour_graph(x: np.ndarray, queries: np.ndarray, degree: int, block: int = 512) -> np.ndarray:
    """Indices of the nearest sample rows of each query row, its own left out."""
    norms = (x * x).sum(1)
    out = np.empty((len(queries), degree), np.int64)
    for i in range(0, len(queries), block):
        q = queries[i : i + block]
        d = norms[None] - 2 * x[q] @ x.T
        d[np.arange(len(q)), q] = np.inf
        out[i : i + block] = np.argpartition(d, degree, axis=1)[:, :degree]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 6, slack: float = 1.1) -> np.ndarray:
    """A part for each row: nearest means within a capacity, refined on the graph within it."""
    rng = np.random.default_rng(5)
    most, least = int(slack * len(x) / parts) + 1, int((2 - slack) * len(x) / parts)
    means = x[rng.choice(len(x), parts, replace=False)]
    for _ in range(15):
        near = (2 * x @ means.T - (means * means).sum(1)).argmax(1)
        size = np.bincount(near, minlength=parts)
        means = np.stack([x[near == j].mean(0) if size[j] else x[rng.integers(len(x))] for j in range(parts)])
    fit = 2 * x @ means.T - (means * means).sum(1)
    order = np.argsort(-fit, axis=1)
    ranked = np.take_along_axis(fit, order[:, :2], 1) if parts > 1 else None
    part, size = np.empty(len(x), np.int64), np.zeros(parts, np.int64)
    for i in np.argsort(ranked[:, 1] - ranked[:, 0], kind="stable"):  # those with the clearest choice first
        part[i] = next(j for j in order[i] if size[j] < most)
        size[part[i]] += 1
    back = [[] for _ in range(len(x))]
    for i, js in enumerate(graph):
        for j in js:
            back[j].append(i)
    near = [np.concatenate([js, np.array(b, np.int64)]) for js, b in zip(graph, back, strict=True)]
    for _ in range(rounds):
        moved = 0
        for i in rng.permutation(len(x)):
            votes = np.bincount(part[near[i]], minlength=parts)
            own = part[i]
            to = int(np.argmax(np.where(size < most, votes, -1)))
            if to != own and votes[to] > votes[own] and size[own] > least:
                part[i] = to
                size[own] -= 1
                size[to] += 1
                moved += 1
        if moved < len(x) // 200:
            break
    return part


@dataclass
class Router:
    """The classifier: a linear and a hidden layer side by side, over standardised vectors."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    w3: np.ndarray
    probes: int
    dims: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2 + z @ self.w3

    def parts(self, x: np.ndarray, n: int) -> np.ndarray:
        return np.argsort(-self.logits(x), axis=1, kind="stable")[:, :n]


def train(x: np.ndarray, parts: int = PARTS, degree: int = DEGREE, aim: float = 0.92, k: int = 10, steps: int = 400) -> Router:
    rng = np.random.default_rng(3)
    dims = x.shape[1]
    mean, scale = x.mean(0), x.std(0) + 1e-9
    parts = max(1, min(parts, len(x) // PART_ROWS))
    graph = neighbour_graph(x, np.arange(len(x)), min(degree, len(x) - 1)) if parts > 1 else None
    part = balanced_parts(x, graph, parts) if parts > 1 else np.zeros(len(x), np.int64)
    params = [rng.normal(size=(dims, HIDDEN)) / np.sqrt(dims), np.zeros(HIDDEN), np.zeros((HIDDEN, parts)), np.zeros(parts), np.zeros((dims, parts))]
    if parts == 1:
        return Router(mean, scale, *params, 1, dims)
    held = rng.permutation(len(x)) < len(x) // 8
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1.0 / (graph.shape[1] + 2))
    target[np.arange(len(x)), part] += 2.0 / (graph.shape[1] + 2)
    z, t = (x - mean) / scale, target
    means = np.stack([z[part == j].mean(0) for j in range(parts)])
    warmth = 10.0 / (z * z).sum(1).mean()  # the linear part starts as the nearest mean
    params[3], params[4] = -warmth * (means * means).sum(1) / 2, warmth * means.T.copy()
    z, t = z[~held], t[~held]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(z), min(len(z), 1024))
        a = z[pick]
        h = np.tanh(a @ params[0] + params[1])
        s = h @ params[2] + params[3] + a @ params[4]
        s = np.exp(s - s.max(1, keepdims=True))
        g = (s / s.sum(1, keepdims=True) - t[pick]) / len(pick)
        gh = g @ params[2].T * (1 - h * h)
        for p, d, u, v in zip(params, (a.T @ gh, gh.sum(0), h.T @ g, g.sum(0), a.T @ g), m1, m2, strict=True):
            u += 0.1 * (d - u)
            v += 0.001 * (d * d - v)
            p -= 0.003 * (u / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    router = Router(mean, scale, *params, parts, dims)
    own = router.parts(x, 1)[:, 0]
    rows = np.flatnonzero(held)
    true = neighbour_graph(x, rows, min(k, len(x) - 1))
    rank = np.argsort(np.argsort(-router.logits(x[rows]), axis=1, kind="stable"), axis=1)
    needed = rank[np.arange(len(rows))[:, None], own[true]]
    router.probes = next((n for n in range(1, parts) if (needed < n).mean() >= aim), parts)
    return router


def _dealt(router: Router, all_parts: bool):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([np.asarray(v, np.float64) for v in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(router.parts(x, router.probes if all_parts else 1).tolist(), pa.list_(pa.int32()))], ["vec_id", "embedding", "parts"])

    return of


def nearest(vectors: DataFrame, query: Column, *, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = SAMPLE, parts: int = PARTS, block: int = 8192, asked_block: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows where ``query`` (over vec_id) holds."""
    ship(vectors.sparkSession)
    slim = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    slim = slim.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    out = "query_id long, vec_id long, score double"
    # The sample: rows by the order of a hash, as many as the bound.
    rows = slim.orderBy(F.xxhash64("vec_id", F.lit(17)), "vec_id").limit(sample).collect()
    if not rows:
        return slim.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sizes = pd.Series([len(r.embedding) for r in rows])
    dims = int(sizes.mode().max())
    router = train(np.array([r.embedding for r in rows if len(r.embedding) == dims]), parts=parts, k=k)
    slim = slim.where(F.size("embedding") == dims)
    dealt = slim.mapInArrow(_dealt(router, False), "vec_id long, embedding array<double>, parts array<int>").select("vec_id", F.col("embedding").cast("array<double>"), F.element_at("parts", 1).alias("part"))
    dealt = materialize(dealt, "dealt")
    blocks = {r.part: -(-r.n // block) for r in dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``parts`` rows
    many = F.coalesce(F.element_at(F.create_map(*[F.lit(int(v)) for kv in blocks.items() for v in kv]), F.col("part")), F.lit(1))
    stored = dealt.withColumn("block", F.pmod(F.xxhash64("vec_id"), many).cast("int"))
    asked = materialize(slim.where(query).mapInArrow(_dealt(router, True), "vec_id long, embedding array<double>, parts array<int>"), "asked")
    asked = asked.withColumn("part", F.explode("parts")).where(F.col("part").isin([int(p) for p in blocks])).select(F.col("vec_id").alias("query_id"), "embedding", "part")
    turns = {r.part: -(-r.n // asked_block) for r in asked.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``parts`` rows
    if not turns:
        return slim.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    times = F.coalesce(F.element_at(F.create_map(*[F.lit(int(v)) for kv in turns.items() for v in kv]), F.col("part")), F.lit(0))
    stored = stored.where(times > 0).withColumn("turn", F.explode(F.sequence(F.lit(0), (times - 1).cast("int"))))
    asked = asked.withColumn("turn", F.pmod(F.xxhash64("query_id"), times).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), (many - 1).cast("int"))))

    def rerank(_, ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(ours) and len(theirs):
            x, ids = np.stack(ours["embedding"].to_numpy()).astype(np.float64), ours["vec_id"].to_numpy()
            for q, v in zip(theirs["query_id"].to_numpy(), theirs["embedding"], strict=True):
                diff = x - np.asarray(v, np.float64)
                score = np.sqrt((diff * diff).sum(1))
                score[ids == q] = np.inf
                best = np.lexsort((ids, score))[:k] if len(ids) <= 4 * k else None
                if best is None:
                    edge = np.partition(score, k - 1)[k - 1]
                    near = np.flatnonzero(score <= edge)
                    best = near[np.lexsort((ids[near], score[near]))[:k]]
                best = best[np.isfinite(score[best])]
                found.append(pd.DataFrame({"query_id": q, "vec_id": ids[best], "score": score[best]}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})

    near = stored.groupBy("part", "block", "turn").cogroup(asked.groupBy("part", "block", "turn")).applyInPandas(rerank, out)
    ranked = near.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
