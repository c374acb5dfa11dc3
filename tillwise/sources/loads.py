"""Tables kept as complete loads, so that a write never takes away what readers see.

Every write goes to a folder of its own below the table, ``load=<number>-<letters>``.  Spark
leaves ``_SUCCESS`` there when the last task has committed; until then, and for ever if the
write fails, the folder counts for nothing.  A table is its newest complete load.  A table
by month is, for each month, the newest complete load that has it, so a load of one month
leaves the folders of all others as they are; a full load also ends the months it lacks.

Numbers rise over all tables of a store.  A month of a derived table is out of date when its
source has a load with a higher number.  One job at a time may write to a store; readers
need no care as long as the newest ``keep`` loads outlast them.
"""

from __future__ import annotations

import re
import threading
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillwise.sources import folders
from tillwise.sources.writers import write_by_month, write_table, write_wide_by_month

MONTH = "dt"
_NAME = re.compile(r"load=(\d+)-(all|months)-[0-9a-f]+")
# Fixed value: how Spark names the folder of rows without a partition value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

Month = str | None


@dataclass(frozen=True)
class Load:
    """A complete write; ``whole`` if it also ends the months it does not have."""

    number: int
    whole: bool
    path: str


@dataclass(frozen=True)
class Written:
    """What a write by month has done."""

    rows: int
    months: dict[Month, str]
    dropped: tuple[Month, ...] = ()


@dataclass
class LoadStore:
    """All tables below one root."""

    spark: SparkSession
    root: str
    keep: int = 2
    _last: int = field(default=0, repr=False)
    _lock: threading.Lock = field(default_factory=threading.Lock, repr=False)

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def loads(self, table: str) -> list[Load]:
        """Complete loads, newest first."""
        found = []
        for name, path in folders.children(self.spark, self.path(table)).items():
            match = _NAME.fullmatch(name)
            if match and folders.exists(self.spark, f"{path}/_SUCCESS"):
                found.append(Load(int(match[1]), match[2] == "all", path))
        return sorted(found, key=lambda load: -load.number)

    def current(self, table: str) -> str | None:
        """Folder of the newest complete load."""
        newest = self.loads(table)[:1]
        return newest[0].path if newest else None

    def month_loads(self, table: str) -> dict[Month, tuple[Load, str]]:
        """Newest load and folder of every month, in order of the months."""
        found: dict[Month, tuple[Load, str]] = {}
        for load in self.loads(table):
            for name, path in folders.children(self.spark, load.path).items():
                if name.startswith(f"{MONTH}="):
                    found.setdefault(_value(name), (load, path))
            if load.whole:
                break
        return dict(sorted(found.items(), key=lambda item: item[0] or ""))

    def months(self, table: str) -> dict[Month, str]:
        return {month: path for month, (_, path) in self.month_loads(table).items()}

    def out_of_date(self, derived: str, source: str) -> tuple[list[Month], bool]:
        """Months of ``derived`` to build anew, and whether others have to go with it."""
        theirs, ours = self.month_loads(source), self.month_loads(derived)
        old = [m for m, (load, _) in theirs.items() if m not in ours or ours[m][0].number < load.number]
        return old, bool(set(ours) - set(theirs))

    # --- writing ---

    def _next(self, table: str, kind: str) -> str:
        with self._lock:
            numbers = [self._last, int(time.time() * 1000)]
            if not self._last:  # what earlier jobs have written, perhaps by a clock that is ahead
                for path in folders.children(self.spark, self.root).values():
                    matches = map(_NAME.fullmatch, folders.children(self.spark, path))
                    numbers += [int(match[1]) for match in matches if match]
            self._last = max(numbers) + 1
            return f"{self.path(table)}/load={self._last:015d}-{kind}-{uuid.uuid4().hex[:8]}"

    def replace(self, table: str, frame: DataFrame) -> str:
        """Write a new state of an unpartitioned table; returns its folder."""
        target = self._next(table, "all")
        write_table(frame, target)
        self._tidy(table)
        return target

    def replace_months(
        self, table: str, frame: DataFrame, *, full: bool = False, then: Callable[[DataFrame], DataFrame] | None = None
    ) -> Written:
        """Write the months that occur in ``frame``; ``full`` ends all others.

        ``then`` derives the stored columns of wide rows from those of ``frame``, row by row.
        """
        before = set(self.months(table))
        target = self._next(table, "all" if full else "months")
        rows = write_wide_by_month(frame, target, then, full=True) if then else write_by_month(frame, target, full=True)
        written = {
            _value(name): path
            for name, path in folders.children(self.spark, target).items()
            if name.startswith(f"{MONTH}=")
        }
        self._tidy_months(table)
        return Written(rows, written, tuple(before - set(written)) if full else ())

    def _tidy(self, table: str) -> None:
        """Remove loads beyond the newest, and what failed before them."""
        complete = self.loads(table)
        kept = {load.path for load in complete[: self.keep]}
        for name, path in folders.children(self.spark, self.path(table)).items():
            match = _NAME.fullmatch(name)
            if match and path not in kept and int(match[1]) < complete[0].number:
                folders.remove(self.spark, path)

    def _tidy_months(self, table: str) -> None:
        """Remove month folders that newer loads replace, and loads left without any."""
        complete = self.loads(table)
        serving = set(self.months(table).values())
        kept = {load.path for load in complete[: self.keep]}
        known = {load.path for load in complete}
        for name, path in folders.children(self.spark, self.path(table)).items():
            match = _NAME.fullmatch(name)
            if not match or path in kept or int(match[1]) >= complete[0].number:
                continue
            parts = folders.children(self.spark, path).values()
            stale = [p for p in parts if p not in serving]
            if path not in known or len(stale) == len(parts):
                folders.remove(self.spark, path)
            else:
                for part in stale:
                    folders.remove(self.spark, part)

    # --- reading ---

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        """The newest state of an unpartitioned table; no rows before the first one."""
        path = self.current(table)
        return self.spark.read.schema(schema).parquet(path) if path else self.spark.createDataFrame([], schema)

    def read_months(self, table: str, schema: T.StructType, months: Iterable[Month] | None = None) -> DataFrame:
        """A table by month, or only some months of it; the month is the last column."""
        known = self.months(table)
        paths = [known[m] for m in (known if months is None else months) if m in known]
        whole = T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])
        if not paths:
            return self.spark.createDataFrame([], whole)
        reader = self.spark.read.schema(whole).option("basePath", self.path(table))
        return reader.parquet(*paths).select(*whole.names)


def _value(folder: str) -> Month:
    value = folder.split("=", 1)[1]
    return None if value == _NO_VALUE else value
