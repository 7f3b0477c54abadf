"""Columns by their types: what a model can take, and lists of features as one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def numeric(df: DataFrame, keep: list[str] | None = None, least: float = 0.5) -> DataFrame:
    """The columns that are numbers, or can be read as such: booleans as 0 and 1, decimals and texts as doubles (what does not parse is null).

    A text column stays if at least ``least`` of its values that are not null parse: one aggregation over all of them. ``keep``: columns that stay as they are.
    """
    keep = keep or []
    texts = [c for c, t in df.dtypes if t == "string" and c not in keep]
    shares = df.agg(*[(F.count(F.col(c).try_cast("double")) / F.nullif(F.count(c), F.lit(0))).alias(c) for c in texts]).first().asDict() if texts else {}
    out = []
    for c, t in df.dtypes:
        if c in keep or t in NUMBERS:
            out.append(F.col(c))
        elif t == "boolean":
            out.append(F.col(c).cast("int").alias(c))
        elif t.startswith("decimal") or (shares.get(c) or 0.0) >= least:
            out.append(F.col(c).try_cast("double").alias(c))
    return df.select(*out)


def feature_union(*lists: list[str], known: list[str] | None = None) -> list[str]:
    """Names of all lists once, in the order of their first mention; with ``known`` only these."""
    every = list(dict.fromkeys(c for names in lists for c in names))
    return every if known is None else [c for c in every if c in set(known)]
