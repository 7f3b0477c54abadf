"""Sinks over plain Parquet folders, for tables that nobody reads meanwhile; ``versions`` has those whose readers see whole states alone."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir; under the warehouse where that is not set, and only for a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/formbook-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """``df`` as a table in the shared folder: for frames that several jobs read, safe from lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def align(df: DataFrame, like: DataFrame) -> DataFrame:
    """Additive schema evolution: columns of ``like`` that are missing come as typed nulls, in its order; new ones follow."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in like.schema if f.name not in df.columns}
    return df.withColumns(missing).select(*like.columns, *[c for c in df.columns if c not in like.columns])


def overwrite_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replace exactly the partitions that ``df`` touches; running it twice changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def upsert(new: DataFrame, path: str, keys: list[str], by: str) -> None:
    """Delete by key, then insert, in the partitions that hold a key of ``new`` or receive its rows.

    The result is staged in the shared folder first, since a table cannot be read and overwritten in one plan. A partition
    that loses all its rows gets none from the dynamic overwrite, so its folder is deleted. Of ``new``, one row for each key is expected.
    """
    spark = new.sparkSession
    new = stored(new, "upsert-new")  # read several times below
    old = spark.read.parquet(path)
    hit = old.join(new.select(keys).distinct(), keys, "left_semi").select(by).distinct()
    touched = stored(hit.union(new.select(by)).distinct(), "upsert-touched")
    kept = old.join(touched, by, "left_semi").join(new.select(keys).distinct(), keys, "left_anti")
    staged = stored(kept.unionByName(new, allowMissingColumns=True), "upsert-rows")
    overwrite_partitions(staged, path, by)
    emptied = touched.join(staged.select(by).distinct(), touched[by].eqNullSafe(staged[by]), "left_anti")
    for row in emptied.toLocalIterator():  # partitions, not rows of the table
        drop_partition(spark, path, by, row[0])


def drop_partition(spark: SparkSession, path: str, by: str, value) -> None:
    """Delete a partition's folder, by Spark's own file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(by, None if value is None else str(value))
    where = hadoop.Path(f"{path.rstrip('/')}/{name}")
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def delete_dates_insert(new: DataFrame, path: str, date: str) -> None:
    """Delete the dates of ``new``, then insert: a date is a partition, so a rerun changes nothing."""
    overwrite_partitions(new, path, date)


def append(new: DataFrame, path: str, schema: str) -> None:
    """Append with an explicit schema: columns are cast and ordered by it, missing ones are null."""
    fields = new.sparkSession.createDataFrame([], schema).schema
    new.select(*[(F.col(f.name).cast(f.dataType) if f.name in new.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields]).write.mode("append").parquet(path)


def truncate_and_load(new: DataFrame, path: str) -> None:
    stored(new, "load").write.mode("overwrite").parquet(path)


def ndjson(df: DataFrame, path: str) -> None:
    """A JSON object a line."""
    df.write.mode("overwrite").json(path)


def create_table_as(df: DataFrame, name: str, path: str, by: list[str], cluster: list[str] | None = None) -> None:
    """CREATE OR REPLACE TABLE AS SELECT, partitioned, and clustered by a sort inside each partition."""
    laid = df.repartition(*by) if by else df
    laid.sortWithinPartitions(*by, *(cluster or [])).write.mode("overwrite").option("path", path).partitionBy(*by).saveAsTable(name)


def bucketed_table(df: DataFrame, name: str, path: str, key: str, buckets: int, bounds: tuple[int, int, int] | None = None) -> None:
    """CREATE OR REPLACE TABLE AS SELECT in ``buckets`` sorted buckets of ``key``: two such tables join on it without an exchange or a sort.

    ``bounds`` (first, end, step) adds integer ranges of the key as partitions (``key_range``, its first value; null outside), so that a range of keys prunes folders.
    """
    writer = df
    if bounds:
        writer = df.withColumn("key_range", range_of(key, *bounds))
    # one task for each bucket writes one file, so that a bucket is sorted as a whole
    laid = writer.repartition(buckets, key)
    out = laid.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key)
    (out.partitionBy("key_range") if bounds else out).saveAsTable(name)


def range_of(key: str, first: int, end: int, step: int):
    """The first key of its range of ``step`` keys, in [first, end); null outside."""
    return F.when((F.col(key) >= first) & (F.col(key) < end), F.col(key) - F.pmod(F.col(key) - first, F.lit(step)))


def clean_nan(df: DataFrame) -> DataFrame:
    """NaN to null in every floating column: null is the only missing value."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c, t in df.dtypes if t in ("double", "float")})
