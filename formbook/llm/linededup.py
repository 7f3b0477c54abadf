"""Line dedup over levelled sorted runs of line hashes.

``LineRuns`` is a small log-structured store. A batch of documents becomes a
*run*: a Parquet table of (key, number of documents, largest document), dealt by a hash
of the key and sorted by it. Runs are kept in levels; as soon as a level
has ``fanout`` runs they are merged into one run of the next level. A new batch
is first anti-joined with the keys that earlier runs have settled (documents are
fed from the largest id down, so a key that has reached ``min_docs`` can neither
change its verdict nor its keeper), then what is left is added as its own run.

Scale: a line is a 16-byte hash in everything that is shuffled before the last
step. Keys are counted with map-side partial sums, so a line that a third of
all documents share costs one row per task. Text is shuffled once, to meet the
verdicts of its document; verdicts of one document are an array of its own lines, and a Python worker looks its lines up in
a set of them, so a document takes time linear in its lines. A run is dealt and sorted by its key when it is written; Spark does not know
of that order when it reads it back, so a merge of runs and the anti-join deal their slim rows again.

Edge cases: a null or empty text is one empty line; a null doc_id is a document
below all others; rows that repeat a doc_id count as documents of their own and
keep or lose lines alike; an empty table gives an empty result; keys shorter
than ``min_chars`` code points are never dropped. Two 64-bit hashes stand for a
key, so different lines do not collide in practice at any size.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from formbook.llm.common import chunks, materialize, same, scratch_path, ship

#: Fixed value: the white space that a key loses at both ends.
BLANK = " \t\n\x0b\x0c\r"
#: The bytes of A-Z in lower case.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Seed of the first hash; that of the second is the first hash of the number 1.
_SEED = 42


def _second_seed() -> int:
    import xxhash

    return xxhash.xxh64_intdigest((1).to_bytes(4, "little"), _SEED)


def _hashes(min_chars: int):
    """The two hashes of a line's key; None where the key is too short to be judged."""
    import xxhash

    second, blank, first = _second_seed(), BLANK.encode(), xxhash.xxh64_intdigest

    def of(line: str) -> tuple[int, int] | None:
        if len(line) < min_chars or len(line.strip(BLANK)) < min_chars:
            return None
        key = line.encode("utf-8", "surrogatepass").strip(blank).translate(_LOWER)
        return first(key, _SEED), first(key, second)

    return of


def _keys(min_chars: int):
    """Of (doc_id, text): (doc_id, a, b) for each distinct key of a row."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hashes(min_chars)
        for whole in batches:
            for batch in chunks(whole, 1, 8_000_000):
                at, a, b = [], [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    own = {k for line in (text or "").split("\n") if (k := hashes(line)) is not None}
                    at += [i] * len(own)
                    a += [k[0] for k in own]
                    b += [k[1] for k in own]
                long = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), long(a), long(b)], ["doc_id", "a", "b"])

    return of


def _kept(min_chars: int, text_at: int, columns: int, names: list[str]):
    """Of ``columns`` columns and the two halves of a row's lost keys: the columns with the lines that stay, lines before, lines that went."""

    def stay(text: str, lost: set, hashes) -> tuple[str, int]:
        lines = text.split("\n")
        kept = [x for x in lines if (k := hashes(x)) is None or k not in lost]
        return "\n".join(kept), len(lines) - len(kept)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hashes(min_chars)
        for whole in batches:
            for batch in chunks(whole, text_at, 8_000_000):
                text, a, b = batch.column(text_at), batch.column(columns), batch.column(columns + 1)
                judged = a.is_valid()
                rows = np.flatnonzero(judged.to_numpy(zero_copy_only=False))
                gone, new = np.zeros(batch.num_rows, np.int64), []
                for i in rows.tolist():
                    lost = set(zip(*(x[i].values.to_numpy().view(np.uint64).tolist() for x in (a, b)), strict=True))
                    shorter, gone[i] = stay(text[i].as_py() or "", lost, hashes)
                    new.append(shorter if gone[i] else text[i].as_py())
                lines = pc.add(pc.fill_null(pc.count_substring(text, "\n"), 0), 1).cast(pa.int64())
                if len(rows):
                    text = pc.replace_with_mask(text, judged, pa.array(new, text.type))
                kept = [text if i == text_at else batch.column(i) for i in range(columns)]
                yield pa.RecordBatch.from_arrays([*kept, lines, pa.array(gone)], names)

    return of


class LineRuns:
    """Levelled sorted runs of (a, b, n_docs, last_doc) under a shared folder."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 2):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[DataFrame]] = [[]]

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def merged(self) -> DataFrame:
        return self._merge(self.runs())

    @staticmethod
    def _merge(runs: list[DataFrame]) -> DataFrame:
        every = reduce(DataFrame.unionByName, runs)
        return every.groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def _write(self, rows: DataFrame, level: int) -> DataFrame:
        path = scratch_path(self.spark, f"lines-level{level}")
        rows.sortWithinPartitions("a", "b").write.parquet(path)  # hash-dealt by key, sorted inside
        return self.spark.read.schema(rows.schema).parquet(path)

    def add(self, batch: DataFrame) -> None:
        """batch: (a, b, doc_id), one row for each document and line; larger doc_ids than in later batches."""
        # Counted before the anti-join, so that a line leaves each task once.
        own = batch.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))
        if runs := self.runs():
            settled = self._merge(runs).where(F.col("n_docs") >= self.min_docs)
            own = own.join(settled, ["a", "b"], "left_anti")
        self.levels[0].append(self._write(own, 0))
        self.compact()

    def compact(self) -> None:
        for level, runs in enumerate(self.levels):
            if len(runs) >= self.fanout:
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self._write(self._merge(runs), level + 1))
                self.levels[level] = []


def drop_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3, batches: int = 4) -> DataFrame:
    """``docs`` with ``text_col`` reduced to the lines that stay, and ``n_lines``, ``n_dropped`` (in place of columns of these names).

    A line whose key is in ``min_docs`` documents or more stays only in the largest of them.
    """
    spark = docs.sparkSession
    ship(spark)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_keys(min_chars), StructType([StructField("doc_id", docs.schema[id_col].dataType), StructField("a", LongType()), StructField("b", LongType())]))
    slim = materialize(slim, "line-keys")
    cuts = slim.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000).alias("cuts")).first()["cuts"] or []
    runs = LineRuns(spark, min_docs)
    edges = [None, *sorted(set(cuts)), None]
    for low, high in reversed(list(zip(edges, edges[1:], strict=False))):
        inside = F.lit(True) if low is None else F.col("doc_id") > low
        if high is not None:
            inside &= F.col("doc_id") <= high
        if low is None:
            inside |= F.col("doc_id").isNull()
        runs.add(slim.where(inside))
    shared = materialize(runs.merged().where((F.col("n_docs") >= min_docs) & F.col("last_doc").isNotNull()), "shared-lines")
    # Both sides are stored tables, so adaptive execution splits the partition of a line that very many documents hold.
    lost = slim.join(shared.select("a", "b", "last_doc"), ["a", "b"]).where(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("last_doc")))
    own = uuid.uuid4().hex  # names that no table has
    lost = lost.groupBy(F.col("doc_id").alias(f"doc_{own}")).agg(F.collect_set(F.struct("a", "b")).alias("lost"))
    lost = lost.select(f"doc_{own}", F.col("lost.a").alias(f"a_{own}"), F.col("lost.b").alias(f"b_{own}"))
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    met = docs.join(lost, same(F.col(id_col), F.col(f"doc_{own}")), "left").select(*columns, f"a_{own}", f"b_{own}")
    schema = StructType([*[docs.schema[c] for c in columns], StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    return met.mapInArrow(_kept(min_chars, columns.index(text_col), len(columns), schema.names), schema)


def line_report(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row."""
    out = drop_lines(docs.select("doc_id", "text"), **how)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
