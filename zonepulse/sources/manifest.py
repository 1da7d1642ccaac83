"""Which delivery of a day's file is the current one, and in which folders its rows are.

Every staging writes its rows to new folders, ``event_date=E/file_day=D/version=V`` under the
interim root, and then appends to the manifest (``<root>_manifest``) one entry per folder, or one
entry without an event date for a file that holds no valid row.  The entries of the highest
version of a file day are its delivery; all older folders of that day no longer exist for readers.
So a delivery replaces the one before as a whole, whatever it holds, and rows written by a staging
that failed before its entries were appended are never read.

The manifest has a few rows per delivered day; they are read by the driver.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonepulse.sources.listing import exists, file_status

SCHEMA = "file_day date, version long, event_date date, rows long, file string, bytes long, modified long"


@dataclass(frozen=True)
class Entry:
    """``rows`` rows of ``event_date`` in the file of ``file_day``, and the file they came from."""

    file_day: dt.date
    version: int
    event_date: dt.date | None
    rows: int
    file: str
    bytes: int
    modified: int

    @property
    def late(self) -> bool:
        return self.event_date != self.file_day and self.rows > 0

    def folder(self, root: str) -> str:
        day = self.event_date or "__HIVE_DEFAULT_PARTITION__"
        return f"{root.rstrip('/')}/event_date={day}/file_day={self.file_day}/version={self.version}"


def manifest_root(interim_root: str) -> str:
    return f"{interim_root.rstrip('/')}_manifest"


def current(spark: SparkSession, interim_root: str) -> list[Entry]:
    """The entries of each file day's last delivery."""
    root = manifest_root(interim_root)
    if not exists(spark, root):
        return []
    last = F.max("version").over(Window.partitionBy("file_day"))
    rows = spark.read.schema(SCHEMA).parquet(root).withColumn("last", last).where("version = last").drop("last")
    return sorted((Entry(**r.asDict()) for r in rows.distinct().collect()), key=lambda e: (e.file_day, str(e.event_date)))


def next_version(entries: Iterable[Entry]) -> int:
    """Above all versions so far; by the clock, so that a failed staging's folders aren't used again."""
    return max([time.time_ns() // 1_000_000, *(e.version + 1 for e in entries)])


def publish(spark: SparkSession, interim_root: str, written: DataFrame, version: int, files: dict[dt.date, str]) -> list[Entry]:
    """Appends the entries of a staging: ``written`` has (file_day, event_date, rows) of its folders."""
    found: dict[dt.date, list] = {day: [] for day in files}
    for r in written.collect():
        found[r["file_day"]].append((r["event_date"], r["rows"]))
    entries = []
    for day, file in files.items():
        size, modified = file_status(spark, file)
        entries += [Entry(day, version, event_date, rows, file, size, modified) for event_date, rows in found[day] or [(None, 0)]]
    table = spark.createDataFrame([tuple(vars(e).values()) for e in entries], SCHEMA)
    table.coalesce(1).write.mode("append").parquet(manifest_root(interim_root))
    return entries


def redelivered(spark: SparkSession, interim_root: str, files: dict[dt.date, str]) -> list[dt.date]:
    """Days of ``files`` whose file has another size or time than the delivery that was staged."""
    staged = {e.file_day: (e.bytes, e.modified) for e in current(spark, interim_root)}
    return sorted(d for d, file in files.items() if d in staged and exists(spark, file) and staged[d] != file_status(spark, file))
