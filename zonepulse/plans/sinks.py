"""Writers.  Every output of a run lives under ``{root}/{start}_to_{end}`` so a
re-run of the same window overwrites exactly that window and nothing else."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.config import RunConfig
from zonepulse.operators.summary import summary_order


def window_path(root: str, cfg: RunConfig) -> str:
    return f"{root.rstrip('/')}/{cfg.window_label}"


def write_interim(clean: DataFrame, root: str) -> None:
    """Cleaned orders as Parquet under ``event_date=`` directories.

    Dynamic partition overwrite: exactly the days present in ``clean`` are replaced, so the
    caller passes complete days only (see :func:`zonepulse.plans.run.stage_orders`), and
    re-loading a day is idempotent.  The rebalance hint lets adaptive execution merge small
    pieces of a day into files of a good size and split a hot day over many tasks.
    """
    _write_days(clean.hint("rebalance", "event_date"), root, "event_date")


def write_late(late: DataFrame, root: str) -> None:
    """Cleaned rows that came in the file of another day (or have no day), by ``file_day``."""
    _write_days(late, root, "file_day")


def write_delivery(orders: DataFrame, root: str) -> None:
    """Cleaned orders with ``file_day`` and ``version``, to folders that no delivery had before:
    ``event_date=E/file_day=D/version=V`` (see :mod:`zonepulse.sources.manifest`)."""
    orders.hint("rebalance", "event_date", "file_day").write.mode("append").partitionBy("event_date", "file_day", "version").parquet(root)


def _write_days(orders: DataFrame, root: str, day: str) -> None:
    (
        orders.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(root)
    )


def write_table(df: DataFrame, root: str, cfg: RunConfig) -> str:
    """A table that several later steps read, under the run's (shared) output folder."""
    path = f"{window_path(root, cfg)}/parquet"
    df.write.mode("overwrite").parquet(path)
    return path


def write_zone_day(zone_day: DataFrame, root: str, cfg: RunConfig) -> str:
    """The released zone x day aggregate: Parquet (typed, read back by the run)
    and CSV with header (the hand-over format).  Returns the Parquet path."""
    base = window_path(root, cfg)
    zone_day.write.mode("overwrite").parquet(f"{base}/parquet")
    # The CSV copy is made from the written Parquet, so the aggregate over the
    # orders runs once.  It is ordered (most orders first, then city,
    # neighbourhood); only the sink sorts, since every consumer re-aggregates.
    written = zone_day.sparkSession.read.parquet(f"{base}/parquet")
    (
        written.orderBy(F.desc("total_orders"), F.asc("city"), F.asc("neighbourhood"), F.asc("event_date"))
        .write.mode("overwrite")
        .option("header", True)
        .csv(f"{base}/csv")
    )
    return f"{base}/parquet"


def write_grid(grid: DataFrame, root: str, cfg: RunConfig) -> tuple[str, str]:
    """Hourly grid as Snappy Parquet and as CSV with header, both partitioned by city.

    Partition columns live in directory names, not inside the files: read the
    root directory to get ``city`` back.  The CSV copy is repartitioned by city
    so each city is one file; the grid holds at most zones x 168 rows.  The CSV
    copy is made from the written Parquet, so the grid is computed once.
    """
    base = window_path(root, cfg)
    grid.write.mode("overwrite").partitionBy("city").parquet(f"{base}/parquet")
    written = grid.sparkSession.read.parquet(f"{base}/parquet")  # the grid is computed once
    (
        written.select(*grid.columns)
        .repartition("city")
        .write.mode("overwrite")
        .option("header", True)
        .partitionBy("city")
        .csv(f"{base}/csv")
    )
    return f"{base}/parquet", f"{base}/csv"


def write_summary(summary: DataFrame, root: str, cfg: RunConfig) -> str:
    """Zone summary as one CSV file with header, most orders first.

    One row per released zone (bounded by the zone table), so a single output
    task is fine; the global sort's order survives ``coalesce(1)``.
    """
    path = window_path(root, cfg)
    summary.orderBy(*summary_order()).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_report(report: DataFrame, root: str, cfg: RunConfig, order: list) -> str:
    path = window_path(root, cfg)
    report.orderBy(*order).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path
