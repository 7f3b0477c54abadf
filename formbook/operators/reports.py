"""Nested per-game reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def section(df: DataFrame, key: str, name: str, columns: list[str], order: list[str | Column], most: int | None = None) -> DataFrame:
    """One row per key: an array of structs in ``order``; with ``most`` only the first so many."""
    items = F.array_sort(F.collect_list(F.struct(*order, F.struct(*columns).alias("_item"))))
    out = F.transform(items, lambda x: x["_item"])
    return df.groupBy(key).agg((F.slice(out, 1, most) if most else out).alias(name))


def assemble(spine: DataFrame, key: str, sections: list[DataFrame], name: str = "report") -> DataFrame:
    """Every row of the spine with all its sections as one JSON document; a missing section is an empty list."""
    out, names = spine, []
    for s in sections:
        (found,) = [c for c in s.columns if c != key]
        out = out.join(s, key, "left")
        names.append(F.coalesce(F.col(found), F.array().cast(s.schema[found].dataType)).alias(found))
    return out.select(*spine.columns, F.to_json(F.struct(*spine.columns, *names)).alias(name))
