"""Unions of sources, duplicate repair, fills and versions of dimension rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formbook.operators.dedup import latest_per_key
from formbook.sources.sinks import stored


def union_aligned(parts: list[DataFrame], like: str) -> DataFrame:
    """UNION ALL with every column cast to the types of ``like`` (a DDL schema); what a part lacks is null. ``source_no`` is the part's place."""
    schema = parts[0].sparkSession.createDataFrame([], like).schema
    out = None
    for i, part in enumerate(parts):
        cols = [(F.col(f.name).try_cast(f.dataType) if f.name in part.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema]
        part = part.select(*cols, F.lit(i).alias("source_no"))
        out = part if out is None else out.unionByName(part)
    return out


def keep_last(union: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Of rows with equal keys the one of the last source, then the first in ``order``."""
    return latest_per_key(union, keys, [F.desc("source_no"), *(order or [])])


def repair_duplicates(df: DataFrame, keys: list[str], newest: str) -> DataFrame:
    """One row of each key: the newest, exact ties settled by the other columns."""
    rest = [c for c in df.columns if c not in (*keys, newest)]
    return latest_per_key(df, keys, [F.desc_nulls_last(newest), *[F.asc_nulls_last(c) for c in rest]])


def coalesced(base: DataFrame, sources: list[DataFrame], key: str) -> DataFrame:
    """Every row of ``base``; each other column is the first non-null value over ``sources`` (one row for each key) in order, then the base's own."""
    out = base.select(*[F.col(c).alias(f"_base_{c}" if c != key else c) for c in base.columns])
    for i, s in enumerate(sources):
        out = out.join(s.select(*[F.col(c).alias(f"_{i}_{c}" if c != key else c) for c in s.columns]), key, "left")
    columns = dict.fromkeys(c for d in (base, *sources) for c in d.columns if c != key)
    first = lambda c: F.coalesce(*[F.col(f"_{i}_{c}") for i, s in enumerate(sources) if c in s.columns], *([F.col(f"_base_{c}")] if c in base.columns else []))
    return out.select(key, *[first(c).alias(c) for c in columns])


def medians(df: DataFrame, columns: list[str], bins: int = 2048) -> dict[str, float | None]:
    """Exact medians of what is neither null nor NaN: the bin of the middle rank is cut up again until it holds one value. The driver sees counts of bins alone.

    The columns are stored first. Infinities are counted at the ends; where the middle lies between the two of them the median is null.
    """
    inf = float("inf")
    x = stored(df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"x{i}") for i, c in enumerate(columns)]), "medians")
    finite = lambda i: F.when(F.abs(f"x{i}") < inf, F.col(f"x{i}"))
    ends = x.agg(*[f.alias(f"{n}_{i}") for i in range(len(columns)) for n, f in (("lo", F.min(finite(i))), ("hi", F.max(finite(i))), ("n", F.count(f"x{i}")), ("under", F.count_if(F.col(f"x{i}") == -inf)), ("over", F.count_if(F.col(f"x{i}") == inf)))]).first()
    goals = {}  # (column number, which middle) -> [rank inside, low, high]
    for i in range(len(columns)):
        n, under, over = (ends[f"{k}_{i}"] for k in ("n", "under", "over"))
        for side in (0, 1):
            if n:
                rank = (n - 1 + side) // 2
                goals[i, side] = [0, -inf, -inf] if rank < under else [0, inf, inf] if rank >= n - over else [rank - under, float(ends[f"lo_{i}"]), float(ends[f"hi_{i}"])]
    while open_goals := {g: v for g, v in goals.items() if v[1] < v[2]}:
        structs = []
        for (i, side), (_, low, high) in open_goals.items():
            v, step = F.col(f"x{i}"), high / bins - low / bins
            # Where a step is too small to tell values apart, there are no more values than bins, and each is its own.
            place = F.least(F.floor((v - low) / step), F.lit(bins - 1)).cast("double") if step > 0 and low + step > low and high - step < high and high - low < inf else F.least(F.floor(v / step - low / step), F.lit(bins - 1)).cast("double") if high - low == inf else v
            structs.append(F.when((v >= low) & (v <= high), F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), place.alias("bin"), v.alias("x"))))
        per = x.select(F.explode(F.filter(F.array(*structs), lambda s: s.isNotNull())).alias("s")).groupBy("s.i", "s.side", "s.bin").agg(F.count(F.lit(1)).alias("n"), F.min("s.x").alias("low"), F.max("s.x").alias("high"))
        found: dict = {}
        for r in per.collect():  # at most two times ``bins`` rows for each column
            found.setdefault((r.i, r.side), []).append(r)
        for g, rows in found.items():
            rank = goals[g][0]
            for r in sorted(rows, key=lambda r: r.bin):
                if rank < r.n:
                    at = r.low if rank == 0 else r.high if rank == r.n - 1 else None
                    goals[g] = [rank, r.low, r.high] if at is None else [0, at, at]
                    break
                rank -= r.n
    middle = lambda a, b: a if a == b else None if a == -inf and b == inf else a / 2 + b / 2 if abs(a) > 1e300 else (a + b) / 2
    return {c: middle(goals[i, 0][1], goals[i, 1][1]) if (i, 0) in goals else None for i, c in enumerate(columns)}


def filled(df: DataFrame, defaults: dict[str, float], rest: list[str]) -> DataFrame:
    """Nulls by the table of defaults; in the columns of ``rest`` by their median, 0 where there is none."""
    values = {c: v or 0.0 for c, v in medians(df, rest).items()} if rest else {}
    return df.na.fill({k: v for k, v in {**values, **defaults}.items() if k in df.columns})


def overwritten(dimension: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Type 1: rows of known keys are replaced, others added."""
    return new.unionByName(dimension.join(new.select(key), key, "left_anti"))


def versioned(dimension: DataFrame, new: DataFrame, key: str, attributes: list[str], day: Column) -> DataFrame:
    """Type 2: (key, attributes, valid_from, valid_to, is_current); changed keys get their version closed the day before and a new one, unknown keys a first one."""
    current = dimension.where("is_current").select(key, *[F.col(a).alias(f"_{a}") for a in attributes], F.lit(True).alias("_known"))
    same = reduce(Column.__and__, [F.col(a).eqNullSafe(F.col(f"_{a}")) for a in attributes], F.col("_known").isNotNull())
    changed = new.join(current, key, "left").where(~same).select(key, *attributes)
    closes = dimension.join(changed.select(key, F.lit(True).alias("_new")), key, "left").withColumn("_close", F.col("_new").isNotNull() & F.col("is_current"))
    kept = closes.select(key, *attributes, "valid_from", F.when(F.col("_close"), F.date_sub(day, 1)).otherwise(F.col("valid_to")).alias("valid_to"), (F.col("is_current") & ~F.col("_close")).alias("is_current"))
    return kept.unionByName(changed.select(key, *attributes, day.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current")))


def with_previous(snapshots: DataFrame, key: str, day: str, attribute: str) -> DataFrame:
    """Type 3: the latest value of each key beside the one before its last change."""
    w = W.partitionBy(key).orderBy(day)
    moves = snapshots.withColumn("_was", F.lag(attribute).over(w)).where(F.col("_was").isNull() | ~F.col("_was").eqNullSafe(F.col(attribute)))
    last = latest_per_key(moves, [key], [F.desc(day)])
    return last.select(key, attribute, F.col("_was").alias(f"previous_{attribute}"), F.col(day).alias("changed_on"))
