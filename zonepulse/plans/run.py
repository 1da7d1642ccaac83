"""The windowed run: ingest -> zone-day metrics -> enrichment -> grid -> summary.

``run_window`` is the single callable a scheduler invokes per window.  All
steps are Spark jobs; the driver only sees the list of days still to stage
(at most the window length) and single rows of counters.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from zonepulse.config import RunConfig
from zonepulse.operators.grid import hourly_demand_grid
from zonepulse.operators.ingest import clean_orders, day_spine, missing_days
from zonepulse.operators.summary import (
    hotspot_report,
    run_metrics,
    underserved_report,
    zone_summary,
)
from zonepulse.operators.zones import enrich_zones, zone_day_metrics
from zonepulse.plans import sinks
from zonepulse.sources import manifest, readers
from zonepulse.sources.listing import exists, partition_days


class MissingDaysError(ValueError):
    """Window days that are neither staged nor delivered."""

    def __init__(self, days: list[dt.date]):
        super().__init__("no raw orders for " + ", ".join(d.isoformat() for d in days))
        self.days = days


@dataclass(frozen=True)
class RunPaths:
    """Where a run reads and writes.

    orders_src  directory of raw daily files ``orders_YYYY-MM-DD.csv``
    zones       zone table CSV;  registry: zone registry CSV
    interim     Parquet root of cleaned orders (``event_date=`` partitions); its manifest lies beside it
    output      root of all deliverables (zone_day, grid, summary, reports)
    zone_day    CSV of the released zone x day aggregate if another party delivers it; the
                zone table is not read then
    """

    orders_src: str
    zones: str | None
    registry: str
    interim: str
    output: str
    zone_day: str | None = None

    def out(self, name: str) -> str:
        return f"{self.output.rstrip('/')}/{name}"


@dataclass
class StageResult:
    """``staged_days`` now staged; ``missing_days`` without a file; ``late_rows`` kept beside
    the staged days because they came in the file of another day; ``rejected`` raw rows by
    reason (see :func:`zonepulse.operators.ingest.rejected_orders`)."""

    staged_days: list = field(default_factory=list)
    missing_days: list = field(default_factory=list)
    late_rows: int = 0
    rejected: dict = field(default_factory=dict)


@dataclass
class RunResult(StageResult):
    outputs: dict = field(default_factory=dict)
    metrics: dict = field(default_factory=dict)


def staged_days(spark: SparkSession, interim_root: str) -> DataFrame:
    """Days whose file was staged: those of the manifest, or where there is none those that
    have an interim partition."""
    entries = manifest.current(spark, interim_root)
    days = sorted({e.file_day for e in entries}) if entries else partition_days(spark, interim_root)
    return spark.createDataFrame([(d,) for d in days], "event_date date")


def staging(raw: DataFrame, version: int, counters: Observation | None = None) -> DataFrame:
    """What one staging writes, from one scan of the raw files: the cleaned rows of every file,
    with their file's day and the version."""
    return clean_orders(raw, also=("file_day",), counters=counters).withColumn("version", F.lit(version).cast("long"))


def stage_orders(
    spark: SparkSession, cfg: RunConfig, paths: RunPaths, allow_missing_days: bool = False,
    restage: Iterable[dt.date] = (),
) -> StageResult:
    """Clean and stage every window day that is not staged yet, and ``restage``.

    The missing days come from a left-anti join of the day spine against the staged days; their
    raw files are read in one scan, which feeds the write and the counters.  A file is the
    complete delivery of its day: what an earlier file of that day brought is no longer read,
    its rows of other days included, even if the new one holds no valid row.  Rows of another
    day lie in their own day's partition, under the day of their file, and readers add them to
    their own day.  So no valid row is lost, whatever a file holds, and loading a file again
    changes nothing.
    """
    known = manifest.current(spark, paths.interim)
    if not known and partition_days(spark, paths.interim):
        raise ValueError(f"{paths.interim} was written without a manifest; stage into a new folder")
    spine = day_spine(spark, cfg.start, cfg.end)
    todo = {r.event_date for r in missing_days(spine, staged_days(spark, paths.interim)).collect()} | set(restage)
    files = {d: readers.order_file(paths.orders_src, d) for d in sorted(todo)}
    files = {d: file for d, file in files.items() if exists(spark, file)}
    result = StageResult(missing_days=sorted(todo - set(files)))
    if result.missing_days and not allow_missing_days:
        raise MissingDaysError(result.missing_days)
    if not files:
        return result
    version, counters = manifest.next_version(known), Observation("staging")
    raw = readers.read_delivered_days(spark, paths.orders_src, files)
    sinks.write_delivery(staging(raw, version, counters), paths.interim)
    written = readers.read_versions(spark, paths.interim).where(F.col("version") == version)
    entries = manifest.publish(
        spark, paths.interim, written.groupBy("file_day", "event_date").agg(F.count(F.lit(1)).alias("rows")), version, files
    )
    result.staged_days = list(files)
    result.rejected = counters.get
    result.late_rows = sum(e.rows for e in entries if e.late)
    return result


def redelivered_days(spark: SparkSession, cfg: RunConfig, paths: RunPaths) -> list[dt.date]:
    """Window days whose file was delivered anew since it was staged; pass them as ``restage``."""
    days = [r.event_date for r in day_spine(spark, cfg.start, cfg.end).collect()]
    return manifest.redelivered(spark, paths.interim, {d: readers.order_file(paths.orders_src, d) for d in days})


def run_window(
    spark: SparkSession, cfg: RunConfig, paths: RunPaths, allow_missing_days: bool = False,
    restage: Iterable[dt.date] = (),
) -> RunResult:
    """One window from raw files to reports.  Raises :class:`MissingDaysError` if a day of the
    window is neither staged nor delivered, unless ``allow_missing_days``; the result then
    lists those days."""
    result = RunResult(**vars(stage_orders(spark, cfg, paths, allow_missing_days, restage)))

    orders = readers.read_interim(spark, paths.interim, cfg.start, cfg.end)
    registry = readers.read_registry_csv(spark, paths.registry)

    # Protected aggregate: written (Parquet + CSV hand-over) and read back, which
    # cuts the lineage before everything that branches from it.
    if paths.zone_day:
        zone_day = readers.read_zone_day_csv(spark, paths.zone_day)
        zone_day = zone_day.where(F.col("event_date").between(F.lit(cfg.start), F.lit(cfg.end)))
    else:
        zones = readers.read_zones_csv(spark, paths.zones)
        zone_day = zone_day_metrics(orders, zones, cfg.start, cfg.end, cfg.min_group_size, cfg.approx_distinct)
    zd_path = sinks.write_zone_day(zone_day, paths.out("zone_day"), cfg)
    zone_day = spark.read.parquet(zd_path)
    # Tables that several branches read are written under the shared output folder, so
    # losing executors costs only unfinished stages.
    enriched = spark.read.parquet(sinks.write_table(enrich_zones(zone_day, registry), paths.out("enriched"), cfg))

    grid = hourly_demand_grid(orders, enriched, cfg.start, cfg.end, cfg.min_cell_size, cfg.approx_distinct)
    grid_pq, grid_csv = sinks.write_grid(grid, paths.out("grid"), cfg)

    summary = zone_summary(
        orders, enriched, cfg.start, cfg.end, cfg.density_pct, cfg.ratio_pct,
        approx_quantiles=cfg.approx_quantiles, approx_distinct=cfg.approx_distinct,
    )
    summary = spark.read.parquet(sinks.write_table(summary, paths.out("summary_table"), cfg))
    summary_csv = sinks.write_summary(summary, paths.out("summary"), cfg)
    underserved_csv = sinks.write_report(
        underserved_report(summary), paths.out("underserved"), cfg,
        [F.desc("device_density_per_km2"), F.asc("zone_id")],
    )
    hotspot_csv = sinks.write_report(
        hotspot_report(summary, cfg.top_n), paths.out("hotspots"), cfg,
        [F.asc("city"), F.asc("zone_rank"), F.asc("zone_id")],
    )
    result.outputs = {
        "zone_day": zd_path, "grid_parquet": grid_pq, "grid_csv": grid_csv,
        "summary_csv": summary_csv, "underserved_csv": underserved_csv, "hotspot_csv": hotspot_csv,
    }
    result.metrics = run_metrics(enriched, summary).first().asDict()
    return result
