"""Closed days of a live archive, brought together into few files.

Live batches land in small files, ``dt=<day>/run=<query>/batch_id=<number>``.  Compaction
writes the rows of closed days as a load of a table by day (see ``sources.loads``), which the
catalog table of the same name follows, and then removes the live batches it has read.  Rows
keep the name of their batch, so a batch that is replayed meanwhile or later counts once:
where the closed day has a batch, its live copy is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.sources import folders
from tillwise.sources.catalog import WarehouseCatalog
from tillwise.sources.loads import LoadStore

BATCH = T.StructType([T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])
DAY = "dt"
FEW_DAYS = 1


@dataclass(frozen=True)
class LiveArchive:
    """Live batches below ``live`` and closed days as table ``table`` of a store."""

    spark: SparkSession
    live: str
    store: LoadStore
    table: str
    schema: T.StructType
    catalog: WarehouseCatalog | None = None

    def live_days(self) -> dict[str, str]:
        """Folder of each day with live batches, newest day first."""
        found = folders.children(self.spark, self.live)
        days = {name.split("=", 1)[1]: path for name, path in found.items() if name.startswith(f"{DAY}=")}
        return dict(sorted(days.items(), reverse=True))

    def days(self) -> list[str]:
        """All days, newest first."""
        return sorted({*self.live_days(), *(d for d in self.store.months(self.table) if d)}, reverse=True)

    def batches(self, day: str) -> list[str]:
        """Folders of the live batches of a day."""
        runs = folders.children(self.spark, f"{self.live}/{DAY}={day}")
        return [path for run in runs.values() for path in folders.children(self.spark, run).values()]

    # --- reading ---

    def _closed(self, days: Iterable[str]) -> DataFrame:
        whole = T.StructType([*self.schema.fields, *BATCH.fields])
        return self.store.read_months(self.table, whole, days)

    def _live(self, days: Iterable[str], paths: Iterable[str]) -> DataFrame:
        """Rows of live batches that the closed days do not have yet."""
        whole = T.StructType([*self.schema.fields, T.StructField(DAY, T.StringType()), *BATCH.fields])
        paths = list(paths)
        if not paths:
            return self.spark.createDataFrame([], whole)
        rows = self.spark.read.schema(whole).option("basePath", self.live).parquet(*paths)
        both = set(days) & set(self.store.months(self.table))
        if not both:
            return rows
        known = self._closed(both).select(DAY, *BATCH.names).distinct()
        return rows.join(known, [DAY, *BATCH.names], "left_anti")

    def rows(self, days: Iterable[str] | None = None) -> DataFrame:
        """Every archived row once, of all days or of some; only their folders are read."""
        wanted = self.days() if days is None else list(days)
        live = self.live_days()
        both = [*self.schema.names, *BATCH.names, DAY]
        found = self._live(wanted, [live[d] for d in wanted if d in live])
        return self._closed(wanted).select(*both).unionByName(found.select(*both))

    def newest(self, order: list, limit: int) -> DataFrame:
        """The first ``limit`` rows by ``order``, which must put newer days first.

        Days are read from the newest on, twice as many each time, until they hold enough rows.
        """
        return self.rows(self._enough(limit)).orderBy(*order).limit(limit)

    def _enough(self, limit: int) -> list[str]:
        days, taken, rows = self.days(), 0, 0
        step = FEW_DAYS
        while taken < len(days) and rows < limit:
            rows += self.rows(days[taken : taken + step]).count()
            taken, step = taken + step, 2 * step
        return days[:taken]

    def status(self, limit: int) -> DataFrame:
        """Number of archived rows, up to ``limit``; every task sends one number."""
        count = F.count(F.lit(1))
        return self.rows(self._enough(limit)).agg(F.least(count, F.lit(limit).cast("bigint")).alias("recent_cnt"))

    # --- compaction ---

    def compact(self, before: str, newest: Callable[[DataFrame], DataFrame] | None = None) -> list[str]:
        """Bring days before ``before`` (yyyy-MM-dd) that have live batches into closed form.

        The batches are listed once: what lands later stays live until the next time.  They
        are removed only after the load is complete, so a failure loses nothing.  ``newest``
        keeps one version of each row where rows have versions; it must keep all columns.
        """
        live = {day: self.batches(day) for day in self.live_days() if day < before}
        days = [day for day, paths in live.items() if paths]
        if not days:
            return []
        paths = [path for day in days for path in live[day]]
        both = [*self.schema.names, *BATCH.names, DAY]
        rows = self._closed(days).select(*both).unionByName(self._live(days, paths).select(*both))
        written = self.store.replace_months(self.table, newest(rows).select(*both) if newest else rows)
        if self.catalog:
            self.catalog.follow_months(self.table, written)
        for path in paths:
            folders.remove(self.spark, path)
        return sorted(days)
