"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: what the contracts count as white space inside documents.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; where that is unset, a temporary one, and only for a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="formbook-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root}/formbook-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as a table in the shared scratch folder and read it back.

    Unlike an in-memory cache, the files survive the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once for each application."""
    import formbook

    context = spark.sparkContext
    if getattr(context, "_formbook_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(formbook.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="formbook-"), "formbook.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(top)))
    context.addPyFile(path)
    context._formbook_shipped = True


def chunks(batch: pa.RecordBatch, column: int, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``most`` bytes of its text column; a longer text is a slice by itself."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, end - at)
        at = end


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], counts: DataFrame, how: str = "inner", parts: int = 1000) -> DataFrame:
    """Join many rows of a key in ``left`` with its one row in ``right``, however many of the rows share a key.

    ``counts``: (keys, n), how many rows of ``left`` a key has. A key with more than a thousandth (``parts``) of all rows is
    dealt out over as many salts as it has thousandths, and its row of ``right`` is repeated for each. There can be no more than ``parts``
    such keys, so their list is broadcast, and no more than twice ``parts`` rows are added to ``right``.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    hot = counts.where(F.col("n") * parts > total).select(*keys, F.ceil(F.col("n") * parts / max(total, 1)).cast("int").alias("_copies"))
    hot = F.broadcast(materialize(hot, "hot-keys").limit(parts))  # never more than ``parts`` rows
    salted = left.join(hot, keys, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*left.columns), F.col("_copies")), F.lit(0)).cast("int")).drop("_copies")
    copied = right.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1))).drop("_copies")
    return salted.join(copied, [*keys, "_salt"], how).drop("_salt")
