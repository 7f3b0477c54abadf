"""Mixing sources to target weights by weighted fair queueing.

Each source gets a target (its share of the mix). Documents are shuffled inside
their source and a document's *virtual finish time* is the number of its
source's words up to and including it, divided by the source's target. Serving
documents in the order of their finish times gives every source its share at
any moment, so the mix is the global order by finish time, cut at the budget.
A source that must repeat is queued a second time behind its own first pass.

Scale: the text is read once, to count words. Everything after that works on
slim rows. Running totals never gather a source in one task: rows are dealt to
``ranges`` shuffle ranges per source, totals of ranges are summed first, and
only then is each range scanned on its own. The same is done for the global
cut, over ranges of finish time. Tables that a single task sees hold one row for
each source or range.

Edge cases: a null text has size 0; a null source is a source of its own and
comes last; documents of size 0 take 0 words; repeated rows are separate
documents; an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formbook.llm.common import WORD, materialize, same

#: Shuffle ranges per source and ranges of finish time: 3 hexadecimal digits.
RANGES = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(ranges: DataFrame, weights: list[float], share: float, most_epochs: int) -> DataFrame:
    """One row for each source: its size and its target.

    Water filling: with the sources ordered by how soon they saturate
    (capacity / weight), the first k are held at their capacity and the others
    share what is left by weight; k is the first for which nobody else is above.
    """
    sources = ranges.groupBy("source").agg(F.sum("range_size").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    everything = W.partitionBy()
    by_ratio = W.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)
    return (
        sources.withColumn("weight", weight)
        .withColumn("capacity", F.col("source_size") * F.lit(float(most_epochs)))
        .withColumn("ratio", F.col("capacity") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("level", (F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0.0))) / F.sum("weight").over(after))
        .withColumn("level", F.min_by("level", F.when(F.col("level") <= F.col("ratio"), F.row_number().over(by_ratio))).over(everything))
        .withColumn("target", F.least(F.col("capacity"), F.col("weight") * F.coalesce("level", F.lit(float("inf")))))
        .select("source", "source_size", "target", "budget")
    )


def queue(docs: DataFrame, size: Column, id_col: str, source_col: str, weights: list[float], share: float, most_epochs: int, seed: int) -> DataFrame:
    """Slim rows with each document's place in its source's queue: ``place_end`` words up to it, itself included."""
    shuffled = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")))
    slim = materialize(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"))
        .withColumn("shuffled", shuffled)
        .withColumn("range", F.substring("shuffled", 1, 3)),
        "mix-sizes",
    )
    ranges = slim.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    targets = source_targets(ranges, weights, share, most_epochs)
    r, t = ranges.alias("r"), targets.alias("t")
    ranges = r.join(t, same(F.col("r.source"), F.col("t.source"))).select("r.source", "range", "range_size", "source_size", "target", "budget")
    ahead = F.coalesce(F.sum("range_size").over(W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.withColumn("ahead", ahead).drop("range_size")
    d, r = slim.alias("d"), ranges.alias("r")
    placed = d.join(r, same(F.col("d.source"), F.col("r.source")) & (F.col("d.range") == F.col("r.range"))).select("d.*", "source_size", "target", "budget", "ahead")
    inside = W.partitionBy("source", "range").orderBy("shuffled", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    return placed.withColumn("place_end", F.col("ahead") + F.sum("size").over(inside)).drop("ahead", "range")


def mix(
    docs: DataFrame,
    size: Column | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: list[float] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most_epochs: int = 2,
    split: bool = True,
    seed: int = 11,
) -> DataFrame:
    """Return (doc_id, source, size, source_size, target, taken, finish), in the order of the mix.

    ``split``: a document that reaches past its source's share is cut there, so
    that ``taken`` may be a part of it; else documents are taken whole.
    ``finish``: virtual finish time of a document's first copy.
    """
    queued = materialize(queue(docs, word_count(F.col(text_col)) if size is None else size, id_col, source_col, list(weights), share, most_epochs, seed), "mix-queue")
    # Entries to serve: a copy for each epoch; one that crosses the end of its source's share (finish time 1) is split there.
    end = F.round("target").cast("long")
    copies = F.sequence(F.lit(0), F.lit(most_epochs - 1))
    served = queued.where("size > 0 and target > 0").withColumn("epoch", F.explode(copies)).withColumn("stop", F.col("place_end") + F.col("epoch") * F.col("source_size")).withColumn("start", F.col("stop") - F.col("size"))
    crosses = (F.col("start") < end) & (F.col("stop") > end)
    whole = F.array(F.struct("start", "stop"))
    if split:
        whole = F.when(crosses, F.array(F.struct("start", end.alias("stop")), F.struct(end.alias("start"), "stop"))).otherwise(whole)
    served = served.withColumn("e", F.explode(whole)).select("source", "target", "budget", F.col("e.start").alias("start"), F.col("e.stop").alias("stop"))
    served = served.withColumn("finish", F.col("stop") / F.col("target")).withColumn("words", F.col("stop") - F.col("start"))
    served = served.withColumn("band", F.least(F.floor(F.col("finish") * (RANGES // 2)), F.lit(RANGES)).cast("int"))
    # The cut: bands of finish time are summed, then only the band that holds the budget's last word is looked at.
    bands = served.groupBy("band").agg(F.sum("words").alias("words"), F.max("budget").alias("budget"))
    before = F.coalesce(F.sum("words").over(W.orderBy("band").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    last = bands.withColumn("before", before).where((F.col("before") <= F.col("budget")) & (F.col("before") + F.col("words") > F.col("budget"))).select("band", "before", "budget").first()
    at = None
    if last is not None:
        ordered = W.partitionBy("band").orderBy("finish", F.col("source").asc_nulls_last(), "stop").rowsBetween(W.unboundedPreceding, -1)
        inner = served.where(F.col("band") == last["band"]).withColumn("served", F.lit(last["before"]) + F.coalesce(F.sum("words").over(ordered), F.lit(0)))
        # The first entry past the budget: those ordered before it are served whole, and of itself what is left.
        key = F.struct("finish", F.col("source").isNull(), "source", "stop")
        crossing = inner.where(F.col("served") + F.col("words") > F.col("budget"))
        at = crossing.agg(F.min_by(F.struct("finish", "source", "stop", (F.floor("budget") - F.col("served")).alias("left")), key).alias("cut")).first()["cut"]
    taken = F.lit(0)
    for epoch in range(most_epochs):
        stop = F.col("place_end") + F.lit(epoch) * F.col("source_size")
        start = stop - F.col("size")
        parts = [(start, F.when((start < end) & (stop > end), end).otherwise(stop)), (F.when((start < end) & (stop > end), end).otherwise(stop), stop)] if split else [(start, stop)]
        for a, b in parts:
            part = b - a
            if at is not None:
                key = F.struct((b / F.col("target")).alias("finish"), F.col("source").isNull().alias("no_source"), F.col("source"), b.alias("stop"))
                cut = F.struct(F.lit(at["finish"]).alias("finish"), F.lit(at["source"] is None).alias("no_source"), F.lit(at["source"]).cast("string").alias("source"), F.lit(at["stop"]).alias("stop"))
                part = F.when(key < cut, part).when(key == cut, F.lit(at["left"] if split else 0)).otherwise(F.lit(0))
            taken = taken + F.when(b > a, part).otherwise(F.lit(0))
    out = queued.select(
        "doc_id", "source", "size", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"),
        F.when((F.col("size") > 0) & (F.col("target") > 0), taken).otherwise(F.lit(0)).cast("long").alias("taken"),
        F.coalesce(F.try_divide(F.col("place_end"), F.col("target")), F.lit(0.0)).alias("finish"),
    )
    return out.orderBy("finish", F.col("source").asc_nulls_last(), "doc_id")


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix as documents: each as often as it is taken, whole, with the columns of ``docs``. Rows of equal id and size are taken as often as the one of them that is taken most."""
    id_col = how.get("id_col", "doc_id")
    own = uuid.uuid4().hex  # names that no table has
    key, size, times, words, copy = (f"{c}_{own}" for c in ("id", "size", "times", "words", "copy"))
    taken = mix(docs, split=False, **how).where("taken > 0").groupBy(F.col("doc_id").alias(key), F.col("size").alias(size)).agg(F.max(F.round(F.col("taken") / F.col("size")).cast("int")).alias(times))
    sized = docs.withColumn(words, word_count(F.col(how.get("text_col", "text"))))
    joined = sized.join(taken, same(F.col(id_col), F.col(key)) & (F.col(words) == F.col(size)))
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(docs.columns)
