"""Readers.  Every file source is read with a declared schema, all days in one scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.operators.ingest import DEDUP_KEYS, latest, with_derived
from zonepulse.sources import manifest, schemas
from zonepulse.sources.listing import exists


def order_file(src_dir: str, day: dt.date | str) -> str:
    """Path of one day of raw orders: ``{src_dir}/orders_YYYY-MM-DD.csv``."""
    return f"{src_dir.rstrip('/')}/orders_{day}.csv"


def read_orders_csv(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Raw order events, CSV with header, every column as text (cleaning casts)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schemas.RAW_ORDERS).option("header", True).csv(paths)


def read_delivered_days(spark: SparkSession, src_dir: str, days: Iterable[dt.date]) -> DataFrame:
    """Raw orders of several days in one scan, with the day of the file (``file_day``)."""
    raw = read_orders_csv(spark, [order_file(src_dir, d) for d in days])
    day = F.regexp_extract(F.col("_metadata.file_name"), r"orders_(\d{4}-\d{2}-\d{2})", 1)
    return raw.select("*", day.cast("date").alias("file_day"))


def read_zones_csv(spark: SparkSession, path: str) -> DataFrame:
    """Zone dimension (device density, area, ...) with its declared types."""
    return spark.read.schema(schemas.ZONES).option("header", True).csv(path)


def read_registry_csv(spark: SparkSession, path: str) -> DataFrame:
    """Zone registry; all seven columns are text, blanks read as null."""
    return spark.read.schema(schemas.REGISTRY).option("header", True).csv(path)


def late_root(interim_root: str) -> str:
    """Where rows wait that came in the file of another day than their own."""
    return f"{interim_root.rstrip('/')}_late"


def read_versions(spark: SparkSession, root: str, folders: list[str] | None = None) -> DataFrame:
    """Cleaned orders of all deliveries under ``root``, or of some folders, with file_day and version."""
    reader = spark.read.schema(f"{schemas.CLEAN_ORDERS}, file_day date, version long").option("basePath", root)
    if folders is not None and not folders:
        return spark.createDataFrame([], f"{schemas.CLEAN_ORDERS}, file_day date, version long")
    return reader.parquet(*(folders if folders is not None else [root]))


def read_interim(spark: SparkSession, root: str, start: dt.date | None = None,
                 end: dt.date | None = None) -> DataFrame:
    """Cleaned orders of the window, each with the rows of its own day that came in other files.

    Only the folders that the manifest names for the window are read.  A day without late rows
    is read as it lies; on a day with some, orders that occur on both sides are reduced to their
    latest row and all others are untouched.  A root without a manifest is read as plain
    ``event_date=`` partitions and a late table.
    """
    entries = manifest.current(spark, root)
    if not entries:
        return _read_plain(spark, root, start, end)
    wanted = [e for e in entries if e.rows and e.event_date is not None and (start is None or end is None or start <= e.event_date <= end)]
    mixed = {e.event_date for e in wanted if e.late}

    def read(some: list[manifest.Entry]) -> DataFrame:
        return read_versions(spark, root, [e.folder(root) for e in some]).drop("file_day", "version")

    orders = read([e for e in wanted if e.event_date not in mixed])
    if not mixed:
        return orders
    own = read([e for e in wanted if e.event_date in mixed and not e.late])
    return orders.unionByName(_with_late(own, read([e for e in wanted if e.late])))


def _with_late(main: DataFrame, late: DataFrame) -> DataFrame:
    touched = late.select(*[F.col(k).alias(f"_{k}") for k in DEDUP_KEYS]).distinct()
    same = F.col("order_id").eqNullSafe(F.col("_order_id")) & (F.col("event_date") == F.col("_event_date"))
    both = main.join(touched, same, "left_semi").unionByName(late)
    return main.join(touched, same, "left_anti").unionByName(with_derived(latest(both, DEDUP_KEYS)))


def _read_plain(spark: SparkSession, root: str, start: dt.date | None, end: dt.date | None) -> DataFrame:
    """The window predicate is on the partition column, so it prunes directories
    (PartitionFilters) instead of reading and filtering rows."""
    def window(df: DataFrame) -> DataFrame:
        if start is None or end is None:
            return df
        return df.where(F.col("event_date").between(F.lit(start), F.lit(end)))

    main = window(spark.read.schema(schemas.CLEAN_ORDERS).parquet(root))
    if not exists(spark, late_root(root)):
        return main
    late = spark.read.schema(f"{schemas.CLEAN_ORDERS}, file_day date").parquet(late_root(root))
    return _with_late(main, window(late.where("event_date is not null")).drop("file_day"))


def read_zone_day_csv(spark: SparkSession, path: str) -> DataFrame:
    """Zone x day aggregate delivered as CSV by an outside party (declared types)."""
    return spark.read.schema(schemas.ZONE_DAY).option("header", True).csv(path)
