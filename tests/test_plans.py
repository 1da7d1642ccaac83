"""Plan-shape checks for the scale properties (read from ``explain``)."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import os

import pytest

from zonepulse.operators.grid import hourly_demand_grid
from zonepulse.operators.ingest import clean_orders
from zonepulse.operators.summary import zone_summary
from zonepulse.operators.zones import enrich_zones, zone_day_metrics, zone_day_metrics_sql
from zonepulse.plans.catalog import QUERIES
from zonepulse.plans.sinks import write_interim
from zonepulse.sources import fixtures, readers

SF = "/root/testdata/sf0.001"
WIN = (dt.date(2024, 1, 3), dt.date(2024, 1, 9))


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def staged(spark):
    import tempfile
    root = os.path.join(tempfile.mkdtemp(prefix="run-", dir="/tmp"), "interim")
    write_interim(clean_orders(fixtures.order_events(spark, SF)), root)
    orders = readers.read_interim(spark, root, *WIN)
    zones = fixtures.geo_zone_devices(spark, SF)
    zd = zone_day_metrics(orders, zones, *WIN, 3)
    enriched = enrich_zones(zd, fixtures.zone_registry(spark, SF, 3))
    return orders, zones, zd, enriched


def test_zone_day_plan(staged):
    orders, zones, zd, _ = staged
    p = plan(zd)
    assert "PartitionFilters: [isnotnull(event_date" in p          # window prunes directories
    assert "pickup_lat" not in p and "delivery_lon" not in p        # unused columns never read
    assert "LeftSemi" in p                                          # places filtered inside the scan stage
    assert "ObjectHashAggregate" not in p                           # no per-group object buffers
    assert "CartesianProduct" not in p


def test_sql_form_has_the_same_shape(spark, staged):
    orders, zones, _, _ = staged
    p = plan(zone_day_metrics_sql(spark, orders, zones, *WIN, 3))
    assert "LeftSemi" in p and "Expand" in p
    assert "ObjectHashAggregate" not in p


def test_grid_and_summary_plans(staged):
    orders, _, _, enriched = staged
    g = plan(hourly_demand_grid(orders, enriched, *WIN))
    assert "PartitionFilters: [isnotnull(event_date" in g and "LeftSemi" in g
    assert "ObjectHashAggregate" not in g and "CartesianProduct" not in g
    s = plan(zone_summary(orders, enriched, *WIN))
    assert "CartesianProduct" not in s


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_are_lazy(spark, name):
    """Building a query runs no job beyond reading footers, and writes nothing."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build {name}", "")
    df = QUERIES[name](spark, SF)
    footers = {"region", "nation", "customer", "events"}
    assert len(tracker.getJobIdsForGroup(f"build {name}")) <= 4 * len(footers)
    spark.sparkContext.setJobGroup("", "")
    assert all("/root/testdata/" in f for f in df.inputFiles())


def test_late_rows_leave_the_partition_pruned(spark, staged):
    orders, _, _, _ = staged
    p = plan(orders)
    assert "PartitionFilters: [isnotnull(event_date" in p and "Exchange" not in p


@pytest.mark.parametrize("name", ["thresholds", "run_metrics"])
def test_queries_scan_the_events_once(spark, name):
    """All branches of a query share the dedup shuffle: one scan of events in the final plan."""
    df = QUERIES[name](spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert sum("FileScan parquet" in x and "event_id" in x for x in final.splitlines()) == 1
    assert "ReusedExchange" in final
