"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. Stages are written as tables in between, so a lost executor costs tasks of one stage only.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formbook.llm.common import materialize, table
from formbook.llm.linededup import drop_lines
from formbook.llm.minhash import keep_first
from formbook.llm.mixing import mixed_documents
from formbook.llm.packing import pack
from formbook.llm.toxicity import label_chain, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go."""
    return without_toxic(docs, label_chain(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 characters or more that three documents share stay in the last of them alone."""
    aside = {c: f"{c}_{uuid.uuid4().hex}" for c in ("n_lines", "n_dropped") if c in docs.columns}  # columns of the names that come out
    out = drop_lines(docs.withColumnsRenamed(aside))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.drop("n_lines", "n_dropped").withColumnsRenamed({b: a for a, b in aside.items()}).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8."""
    return keep_first(docs, words=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources to their target weights; a document that is taken twice is there twice."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 2048."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), special=True)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: SQL cannot express trained models and tokenizers. tests/llm/test_pipeline.py holds every stage against plain loops over what the one before kept.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
