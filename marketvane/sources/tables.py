"""Result tables that are replaced whole or by month, so that no reader ever sees half of one.

A table is a folder with `data`, where each write adds files under a version of its own, and `log`, where each commit
adds one small file that lists the version each part of the table is read from. A write that fails, or a run that is
lost, leaves files that no commit names; the table stays what it was. A reader takes the newest commit and reads only
the folders it lists, so it may go on while the table is replaced, and a table may be made from what it replaces.

A table with a date is parted by month. A write may replace some months and leave the others' files alone, and a read
of some days lists those months as a partition filter. Rows are dealt to files by their measured size: adaptive
execution splits large months and puts small ones together.

One writer at a time is assumed; two that commit the same number are told apart and the second one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

MONTH, VERSION = "part_month", "part_version"
WHOLE, UNDATED = "", "undated"
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """What a write inside has shuffled is deleted when the write ends, and the driver lets go of its plans and broadcasts.

    Otherwise all that stays until the driver happens to collect its garbage, and a query that stores several tables has
    the shuffles of all of them on disk, and a driver grown to its whole heap. What was written is read from its files, so
    no later step needs them.
    """
    before = spark.conf.get(RELEASE, "false")
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASE, before)
        spark.sparkContext._jvm.System.gc()


def month_of(day: Column) -> Column:
    """The part of a date: its month, or `undated`."""
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(UNDATED))


class Table:
    """A versioned table at a path; `dated_by` names the date column whose months part it."""

    def __init__(self, spark: SparkSession, path: str, dated_by: str | None = None):
        self.spark, self.path, self.dated_by = spark, path.rstrip("/"), dated_by
        self._pinned: dict | None = None

    def snapshot(self) -> Table:
        """The table as it is now, whatever is written later; its reads don't look at the log again."""
        fixed = Table(self.spark, self.path, self.dated_by)
        fixed._pinned = self.current()
        return fixed

    def commits(self) -> list[dict]:
        """All commits, oldest first."""
        try:
            lines = self.spark.read.text(f"{self.path}/log/*").collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted((json.loads(line["value"]) for line in lines), key=lambda c: c["number"])

    def current(self) -> dict | None:
        if self._pinned is not None:
            return self._pinned
        known = self.commits()
        return known[-1] if known else None

    def exists(self) -> bool:
        return self.current() is not None

    def _folder(self, part: str, version: str) -> str:
        month = f"{MONTH}={part}/" if part != WHOLE else ""
        return f"{self.path}/data/{month}{VERSION}={version}"

    def _rows(self, commit: dict | None = None) -> DataFrame:
        """The rows of a commit, with their parts."""
        commit = commit or self.current()
        if commit is None:
            raise FileNotFoundError(f"no table at {self.path}")
        schema = StructType.fromJson(commit["schema"])
        keys = [VERSION] if commit["dated_by"] is None else [MONTH, VERSION]
        for key in keys:
            schema = schema.add(key, StringType())
        folders = [self._folder(part, version) for part, version in sorted(commit["parts"].items())]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*folders)

    def read(self, commit: dict | None = None) -> DataFrame:
        return self._rows(commit).drop(MONTH, VERSION)

    def last_day(self) -> Column:
        """The last date of the table, looked for in its last month only."""
        commit = self.current()
        dated = [part for part in commit["parts"] if part != UNDATED]
        rows = self._rows(commit).where(F.col(MONTH) == (max(dated) if dated else UNDATED))
        return rows.agg(F.max(self.dated_by)).scalar()

    def since(self, day: Column) -> DataFrame:
        """Rows from a day on; earlier months are not listed by the scan."""
        kept = (F.col(MONTH) >= F.date_format(day, "yyyy-MM")) & (F.col(MONTH) != UNDATED) & (F.col(self.dated_by) >= day)
        return self._rows().where(kept).drop(MONTH, VERSION)

    def last_days(self, days: int) -> DataFrame:
        """Rows from `days` days before the last date on."""
        return self.since(F.date_sub(self.last_day(), days))

    def on(self, day: Column) -> DataFrame:
        """Rows of a day."""
        return self._rows().where((F.col(MONTH) == F.date_format(day, "yyyy-MM")) & (F.col(self.dated_by) == day)).drop(MONTH, VERSION)

    def replace(self, frame: DataFrame, months: Iterable[str] | None = None, sort_by: str | None = None) -> None:
        """Put `frame` in place of the table, or of the given months (as `yyyy-MM`) with the frame's rows of them."""
        if self._pinned is not None:
            raise ValueError("a snapshot is for reading")
        before = self.current()
        if before is not None and before["dated_by"] != self.dated_by:
            raise ValueError(f"{self.path} is parted by {before['dated_by']}, not {self.dated_by}")
        if months is not None and self.dated_by is None:
            raise ValueError(f"{self.path} has no months")
        version = uuid.uuid4().hex
        schema = frame.schema
        rows = frame.withColumn(VERSION, F.lit(version))
        keys = [VERSION]
        if self.dated_by is not None:
            rows = rows.withColumn(MONTH, month_of(F.col(self.dated_by)))
            keys = [MONTH, VERSION]
            if months is not None:
                rows = rows.where(F.col(MONTH).isin(*months))
            rows = rows.hint("rebalance", MONTH)
        if sort_by is not None:
            rows = rows.sortWithinPartitions(*keys[:-1], sort_by)
        with released_shuffles(self.spark):
            rows.write.mode("append").partitionBy(*keys).parquet(f"{self.path}/data")
            parts = self._parts(version, before, months)
        self._commit(version, schema, parts, before)

    def _parts(self, version: str, before: dict | None, months: Iterable[str] | None) -> dict[str, str]:
        if self.dated_by is None:
            return {WHOLE: version}
        kept = {} if months is None or before is None else {p: v for p, v in before["parts"].items() if p not in set(months)}
        return kept | {part: version for part in self._written(version)}

    def _written(self, version: str) -> list[str]:
        """The months that a write has made: its folders' names, at most one a month."""
        try:
            files = self.spark.read.format("binaryFile").option("basePath", f"{self.path}/data").load(f"{self.path}/data/{MONTH}=*/{VERSION}={version}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(r[0] for r in files.select(F.col(MONTH).cast("string")).distinct().collect())

    def _commit(self, version: str, schema: StructType, parts: dict[str, str], before: dict | None) -> None:
        number = 1 + (before["number"] if before else 0)
        commit = {"number": number, "version": version, "dated_by": self.dated_by, "parts": parts, "schema": schema.jsonValue()}
        line = self.spark.createDataFrame([(json.dumps(commit),)], "value string").coalesce(1)
        line.write.mode("error").text(f"{self.path}/log/{number:08d}")

    def vacuum(self, keep: int = 2) -> None:
        """Remove what only commits before the last `keep` name, and what no commit names."""
        known = self.commits()
        kept = {self._folder(p, v) for commit in known[-keep:] for p, v in commit["parts"].items()}
        paths = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        root = paths(f"{self.path}/data")
        files = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        depth = "*" if self.dated_by is None else f"{MONTH}=*/*"
        named = {paths(folder).toUri().getPath() for folder in kept}
        for found in files.globStatus(paths(f"{self.path}/data/{depth}")) or []:
            if VERSION in found.getPath().getName() and found.getPath().toUri().getPath() not in named:
                files.delete(found.getPath(), True)
        for commit in known[:-keep]:
            files.delete(paths(f"{self.path}/log/{commit['number']:08d}"), True)
