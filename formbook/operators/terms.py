"""Keywords in texts: an automaton of all keywords reads each text once."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keywords of one automaton. A longer list takes a pass over the texts for each so many.
MOST = 200_000


def met(texts: DataFrame, keywords: DataFrame, key: str, text: str, word: str, most: int = MOST) -> DataFrame:
    """(key, word): each keyword that a text contains, once for each text. Letters count as written; empty and null keywords meet nothing.

    A slice of at most ``most`` keywords goes to the tasks as an automaton, so what is sent has a bound whatever the table of keywords holds; time
    follows the texts' length and what is found, not the number of keywords.
    """
    own = keywords.select(F.col(word).cast("string").alias("word")).where("word <> ''").distinct()
    slices = max(1, -(-own.count() // most))
    parts = None
    slim = texts.select(F.col(key), F.col(text).cast("string").alias("text")).where("text IS NOT NULL")
    sliced = own.withColumn("slice", F.pmod(F.xxhash64("word"), F.lit(slices)))
    for i in range(slices):
        words = [r.word for r in sliced.where(F.col("slice") == i).collect()]  # about ``most``
        found = slim.mapInArrow(_found(texts.sparkSession.sparkContext.broadcast(words)), f"key {texts.schema[key].dataType.simpleString()}, word string")
        parts = found if parts is None else parts.unionByName(found)
    return parts.withColumnRenamed("key", key)


def _found(words):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for w in words.value:
            automaton.add_word(w, w)
        if words.value:
            automaton.make_automaton()
        for batch in batches:
            at, hits = [], []
            for i, t in enumerate(batch.column(1).to_pylist() if words.value else []):
                own = {w for _, w in automaton.iter(t)}
                at += [i] * len(own)
                hits += own
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(hits, pa.string())], ["key", "word"])

    return of
