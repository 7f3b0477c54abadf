"""Materialised feature views over versioned tables: a refresh recomputes the partitions that changed, and nothing else.

A view is a plan over its source that works partition by partition: rows of a view partition depend on the source
partitions that ``needs`` names for it (by default the one of the same value; a carry-over from the season before names two). The view's
manifest says which version of the source it shows, so a refresh compares two manifests, reads the named source partitions and
replaces the view's partitions in one version switch; a refresh that fails leaves the old view, and one that finds nothing new does nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from formbook.sources import versions

#: Note of a view's manifest: the version of the source that it shows.
SHOWN = "source_version"


def same(value: str | None) -> list[str | None]:
    return [value]


@dataclass
class View:
    """``build``: source rows to view rows, each with the partition column ``by``. ``feeds``: view partitions that a source partition reaches;
    ``needs``: source partitions that a view partition reads."""

    source: str
    path: str
    build: Callable[[DataFrame], DataFrame]
    by: str
    feeds: Callable[[str | None], list[str | None]] = same
    needs: Callable[[str | None], list[str | None]] = same

    def rebuild(self, spark: SparkSession) -> versions.Version:
        """All of the view from all of the source."""
        at = versions.version(spark, self.source).number
        rows = self.build(versions.read(spark, self.source, at))
        if versions.exists(spark, self.path):
            return versions.truncate_and_load(rows, self.path, {SHOWN: at})
        return versions.create(rows, self.path, self.by, notes={SHOWN: at})

    def stale(self, spark: SparkSession, until: int | None = None) -> list[str | None]:
        """View partitions that the source's changes since the last refresh reach."""
        shown = versions.version(spark, self.path).notes[SHOWN]
        touched = versions.changed(spark, self.source, shown, until)
        return list(dict.fromkeys(v for t in touched for v in self.feeds(t)))

    def refresh(self, spark: SparkSession) -> list[str | None]:
        """Bring the view to the source's current version; the values of the partitions that were computed again."""
        if not versions.exists(spark, self.path):
            self.rebuild(spark)
            return []
        at = versions.version(spark, self.source).number
        if at == versions.version(spark, self.path).notes[SHOWN]:
            return []
        stale = self.stale(spark, at)
        rows = self.fresh(spark, stale, at)
        versions.overwrite_partitions(rows, self.path, also_emptied=stale, notes={SHOWN: at})
        return stale

    def fresh(self, spark: SparkSession, stale: list[str | None], at: int | None = None) -> DataFrame:
        """The plan of a refresh: the rows of ``stale`` from the source partitions that they need."""
        read = [versions._name(n) for n in dict.fromkeys(n for v in stale for n in self.needs(v))]
        rows = self.build(versions.read(spark, self.source, at, only=read))
        text = rows[self.by].cast("string")
        known = [v for v in stale if v is not None]
        return rows.where(text.isin(known) | text.isNull() if None in stale else text.isin(known))

    def read(self, spark: SparkSession) -> DataFrame:
        return versions.read(spark, self.path)


def follow(view: View, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: upsert each trigger's rows into the view's source, then refresh the view. A trigger that runs twice changes nothing."""

    def apply(batch: DataFrame, _: int) -> None:
        versions.upsert(batch, view.source, keys)
        view.refresh(batch.sparkSession)

    return apply
