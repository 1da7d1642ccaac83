"""What lies in a folder: listings through Hadoop's file system, no data file is read."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _folder(spark, path)
    return fs.exists(where)


def file_status(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes of a file (or folder: of all its files) and the time it was last changed, in milliseconds."""
    fs, where = _folder(spark, path)
    return fs.getContentSummary(where).getLength(), fs.getFileStatus(where).getModificationTime()


def partition_days(spark: SparkSession, root: str, column: str = "event_date") -> list[dt.date]:
    """Days that have a ``column=YYYY-MM-DD`` folder under ``root``; none if there is no root."""
    fs, where = _folder(spark, root)
    if not fs.exists(where):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(where)]
    found = [re.fullmatch(rf"{column}=([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})", name) for name in names]
    return sorted(dt.date.fromisoformat(m[1]) for m in found if m)
