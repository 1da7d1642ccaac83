"""Named queries over the driver's test tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame built from
the whole tables under ``sf_dir`` through the adapters in
:mod:`zonepulse.sources.fixtures`.  Parameters (window, k) come from
:func:`zonepulse.config.fixture_config`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from zonepulse.config import FIXTURE_SPINE, RunConfig, fixture_config
from zonepulse.operators.grid import hourly_demand_grid
from zonepulse.operators.ingest import clean_orders, day_spine, missing_days
from zonepulse.operators.summary import (
    hotspot_report,
    run_metrics,
    thresholds,
    underserved_report,
    zone_summary,
)
from zonepulse.operators.zones import enrich_zones, zone_day_metrics, zone_day_metrics_sql
from zonepulse.sources import fixtures


class FixtureRun:
    """The inputs and steps of one run over ``sf_dir``, all lazy: nothing is written or
    counted while a query is built."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: RunConfig | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.cfg = cfg or fixture_config()
        self.orders = clean_orders(fixtures.order_events(spark, sf_dir))
        self.zones = fixtures.geo_zone_devices(spark, sf_dir)
        self.registry = fixtures.zone_registry(spark, sf_dir, self.cfg.min_group_size)

    def zone_day(self) -> DataFrame:
        c = self.cfg
        return zone_day_metrics(self.orders, self.zones, c.start, c.end, c.min_group_size, c.approx_distinct)

    def enriched(self) -> DataFrame:
        return enrich_zones(self.zone_day(), self.registry)

    def summary(self) -> DataFrame:
        c = self.cfg
        return zone_summary(
            self.orders, self.enriched(), c.start, c.end, c.density_pct, c.ratio_pct,
            approx_quantiles=c.approx_quantiles, approx_distinct=c.approx_distinct,
        )


def q_clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_orders(fixtures.dirty_order_events(spark, sf_dir))


def q_missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_days(day_spine(spark, *FIXTURE_SPINE), fixtures.staged_dates(spark, sf_dir))


def q_zone_day_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FixtureRun(spark, sf_dir).zone_day()


def q_zone_day_metrics_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = FixtureRun(spark, sf_dir)
    c = run.cfg
    return zone_day_metrics_sql(spark, run.orders, run.zones, c.start, c.end, c.min_group_size)


def q_enrich_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FixtureRun(spark, sf_dir).enriched()


def q_hourly_demand_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = FixtureRun(spark, sf_dir)
    c = run.cfg
    return hourly_demand_grid(run.orders, run.enriched(), c.start, c.end, c.min_cell_size, c.approx_distinct)


def q_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = FixtureRun(spark, sf_dir)
    c = run.cfg
    return thresholds(run.enriched(), c.density_pct, c.ratio_pct, c.approx_quantiles)


def q_zone_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FixtureRun(spark, sf_dir).summary()


def q_underserved_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return underserved_report(FixtureRun(spark, sf_dir).summary())


def q_hotspot_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = FixtureRun(spark, sf_dir)
    return hotspot_report(run.summary(), run.cfg.top_n)


def q_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = FixtureRun(spark, sf_dir)
    return run_metrics(run.enriched(), run.summary())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_orders": q_clean_orders,
    "missing_days": q_missing_days,
    "zone_day_metrics": q_zone_day_metrics,
    "zone_day_metrics_sql": q_zone_day_metrics_sql,
    "enrich_zones": q_enrich_zones,
    "hourly_demand_grid": q_hourly_demand_grid,
    "thresholds": q_thresholds,
    "zone_summary": q_zone_summary,
    "underserved_report": q_underserved_report,
    "hotspot_report": q_hotspot_report,
    "run_metrics": q_run_metrics,
}
