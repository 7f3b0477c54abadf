"""Tables in versions: immutable data folders, a manifest for each version, and one rename that makes it the current one.

``path/files/<write>/part=<n>`` holds the rows of one partition as one write left them; ``path/versions/<number>.json`` says which of these folders
make up a version, and for each the smallest and largest key. A writer adds folders, then renames its manifest to the next number. That rename
fails where another writer was first (``Conflict``), and nobody sees a version before it: a reader has the old rows or the new ones, also
when the writer dies between the steps. Folders that no recent version names go by ``vacuum``.

Scale: an upsert reads the partitions whose range of keys meets that of the new rows, and rewrites those that really hold one of their keys or receive rows;
all others are carried over by name. A manifest has one entry for each partition, and is all that the driver holds.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from formbook.sources import sinks

PART = "_part"


class Conflict(Exception):
    """Another writer made the next version first."""


@dataclass
class Entry:
    """One partition: its value as text, folder, rows, and the range of the first key as text (None: unknown)."""

    value: str | None
    folder: str
    rows: int
    low: str | None = None
    high: str | None = None


@dataclass
class Version:
    number: int
    by: str
    keys: list[str]
    schema: str
    entries: dict[str, Entry]
    notes: dict


# --- files, by Spark's own file system -----------------------------------------
def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, where = _fs(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _put_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that must not exist: beside its place, then renamed into it."""
    aside = f"{path}.{uuid.uuid4().hex}"
    fs, where = _fs(spark, aside)
    stream = fs.create(where, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        # Without the option to overwrite, a rename onto a file fails.
        context.rename(where, jvm.org.apache.hadoop.fs.Path(path), gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as e:
        fs.delete(where, False)
        if "FileAlreadyExists" in str(e) or fs.exists(jvm.org.apache.hadoop.fs.Path(path)):
            raise Conflict(path) from e
        raise


# --- versions -------------------------------------------------------------------
def numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[:-5]) for n in _names(spark, f"{path}/versions") if n.endswith(".json"))


def exists(spark: SparkSession, path: str) -> bool:
    return bool(numbers(spark, path))


def version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    if number is None:
        if not (known := numbers(spark, path)):
            raise FileNotFoundError(f"no version under {path}")
        number = known[-1]
    raw = json.loads(_read_text(spark, f"{path}/versions/{number:012}.json"))
    return Version(number, raw["by"], raw["keys"], raw["schema"], {k: Entry(**e) for k, e in raw["entries"].items()}, raw["notes"])


def read(spark: SparkSession, path: str, number: int | None = None, only: list[str] | None = None) -> DataFrame:
    """A version's rows, the current one's by default; ``only`` these partitions (their values as text)."""
    return _rows(spark, path, version(spark, path, number), only)


def _rows(spark: SparkSession, path: str, v: Version, only: list[str] | None = None) -> DataFrame:
    schema = StructType.fromJson(json.loads(v.schema))
    folders = [f"{path}/{e.folder}" for k, e in v.entries.items() if only is None or k in only]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _name(value: str | None) -> str:
    return "null" if value is None else f"={value}"


def _value(by: str) -> Column:
    return F.col(by).cast("string")


def _written(df: DataFrame, path: str, by: str, keys: list[str]) -> dict[str, Entry]:
    """Add the folders of ``df``, one for each value of ``by``, and describe them."""
    spark, write = df.sparkSession, uuid.uuid4().hex
    home = f"{path}/files/{write}"
    # Folders are named by a hash of the value: a value may hold any character.
    named = df.withColumn(PART, F.sha1(F.concat(F.lit("="), F.coalesce(_value(by), F.lit(""))))).withColumn(PART, F.when(F.col(by).isNull(), F.lit("null")).otherwise(F.col(PART)))
    named.write.partitionBy(PART).parquet(home)
    key = F.col(keys[0]).cast("string") if keys else F.lit(None).cast("string")
    numeric = bool(keys) and df.schema[keys[0]].dataType.typeName() in ("byte", "short", "integer", "long", "date", "timestamp")
    low, high = (F.min(keys[0]).cast("string"), F.max(keys[0]).cast("string")) if numeric else (F.min(key), F.max(key))
    if not any(n.startswith(PART) for n in _names(spark, home)):
        return {}
    back = spark.read.schema(StructType([*df.schema.fields, StructField(PART, StringType())])).parquet(home)
    per = back.groupBy(PART).agg(F.first(_value(by)).alias("value"), F.count(F.lit(1)).alias("rows"), low.alias("low"), high.alias("high"), F.count_if(F.col(keys[0]).isNull() if keys else F.lit(True)).alias("unknown"))
    entries = {}
    for r in per.collect():  # one row for each partition
        whole = numeric and not r.unknown
        entries[_name(r.value)] = Entry(r.value, f"files/{write}/{PART}={r[PART]}", r.rows, r.low if whole else None, r.high if whole else None)
    return entries


def commit(spark: SparkSession, path: str, v: Version) -> Version:
    """Make ``v`` the current version; ``Conflict`` where its number is taken."""
    raw = asdict(v)
    del raw["number"]
    _put_new(spark, f"{path}/versions/{v.number:012}.json", json.dumps(raw))
    return v


def create(df: DataFrame, path: str, by: str, keys: list[str] | None = None, notes: dict | None = None) -> Version:
    """The first version."""
    return commit(df.sparkSession, path, Version(0, by, keys or [], df.schema.json(), _written(df, path, by, keys or []), notes or {}))


def truncate_and_load(new: DataFrame, path: str, notes: dict | None = None) -> Version:
    """A version of the rows of ``new`` alone; readers have the old one until it is there. ``new`` may be a plan over the table itself."""
    old = version(new.sparkSession, path)
    return commit(new.sparkSession, path, Version(old.number + 1, old.by, old.keys, new.schema.json(), _written(new, path, old.by, old.keys), notes or {}))


def overwrite_partitions(new: DataFrame, path: str, also_emptied: list[str] | None = None, notes: dict | None = None) -> Version:
    """Replace the partitions that ``new`` has rows in, and empty those named; running it twice changes no row."""
    spark = new.sparkSession
    old = version(spark, path)
    like = sinks.align(new, spark.createDataFrame([], StructType.fromJson(json.loads(old.schema))))
    gone = {_name(v) for v in also_emptied or []}
    kept = {k: e for k, e in old.entries.items() if k not in gone}
    return commit(spark, path, Version(old.number + 1, old.by, old.keys, like.schema.json(), kept | _written(like, path, old.by, old.keys), notes or old.notes))


def upsert(new: DataFrame, path: str, keys: list[str] | None = None) -> Version:
    """Delete by key, then insert: a moved key leaves its old partition in the same version. Of ``new``, one row for each key is expected."""
    spark = new.sparkSession
    old = version(spark, path)
    keys = keys or old.keys
    new = sinks.stored(new, "upsert-new")  # read several times below
    may = _may_hold(new, old, keys)
    before = _rows(spark, path, old, may)
    ids = new.select(keys).distinct()
    hit = before.join(ids, keys, "left_semi").select(_value(old.by).alias("v"))
    into = new.select(_value(old.by).alias("v"))
    touched = [r.v for r in hit.union(into).distinct().collect()]  # partitions
    gone = {_name(v) for v in touched}
    kept = _rows(spark, path, old, [k for k in old.entries if k in gone]).join(ids, keys, "left_anti")
    rows = kept.unionByName(new, allowMissingColumns=True)
    entries = {k: e for k, e in old.entries.items() if k not in gone} | _written(rows, path, old.by, old.keys)
    return commit(spark, path, Version(old.number + 1, old.by, old.keys, rows.schema.json(), entries, old.notes))


def _may_hold(new: DataFrame, old: Version, keys: list[str]) -> list[str]:
    """Partitions whose range of the first key meets that of ``new``; all where a range is not known."""
    if not old.keys or keys[0] != old.keys[0] or new.schema[keys[0]].dataType.typeName() not in ("byte", "short", "integer", "long", "date", "timestamp"):
        return list(old.entries)
    ends = new.agg(F.min(keys[0]).cast("string").alias("low"), F.max(keys[0]).cast("string").alias("high")).first()
    if ends.low is None:
        return []
    as_key = (lambda x: int(x)) if new.schema[keys[0]].dataType.typeName() in ("byte", "short", "integer", "long") else (lambda x: x)  # dates order as text
    return [k for k, e in old.entries.items() if e.low is None or not (as_key(e.high) < as_key(ends.low) or as_key(ends.high) < as_key(e.low))]


def changed(spark: SparkSession, path: str, since: int, until: int | None = None) -> list[str | None]:
    """The log of changes: values of partitions that differ between two versions, those that are gone or new among them."""
    a, b = version(spark, path, since), version(spark, path, until)
    where = lambda v, k: v.entries[k].folder if k in v.entries else None
    return [(b.entries.get(k) or a.entries[k]).value for k in sorted({*a.entries, *b.entries}) if where(a, k) != where(b, k)]


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the last ``keep`` manifests, and the partition folders that these do not name; how many folders went. Not beside a running writer."""
    known = numbers(spark, path)
    named = {e.folder for n in known[-keep:] for e in version(spark, path, n).entries.values()}
    for n in known[:-keep]:
        fs, where = _fs(spark, f"{path}/versions/{n:012}.json")
        fs.delete(where, False)
    gone = 0
    for write in _names(spark, f"{path}/files"):
        parts = [n for n in _names(spark, f"{path}/files/{write}") if n.startswith(PART)]
        dead = [n for n in parts if f"files/{write}/{n}" not in named]
        for n in dead if len(dead) < len(parts) else [""]:
            fs, where = _fs(spark, f"{path}/files/{write}/{n}".rstrip("/"))
            fs.delete(where, True)
        gone += len(dead)
    return gone
