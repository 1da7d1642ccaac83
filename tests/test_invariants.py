"""Cross-output invariants on the sf0.01 tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from zonepulse.config import fixture_config
from zonepulse.operators.grid import hourly_demand_grid
from zonepulse.operators.ingest import clean_orders
from zonepulse.operators.summary import zone_summary
from zonepulse.operators.zones import enrich_zones, zone_day_metrics, zone_day_metrics_sql
from zonepulse.sources import fixtures

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def run(spark):
    cfg = fixture_config()
    orders = clean_orders(fixtures.order_events(spark, SF)).cache()
    zd = zone_day_metrics(orders, fixtures.geo_zone_devices(spark, SF), cfg.start, cfg.end, cfg.min_group_size).cache()
    enriched = enrich_zones(zd, fixtures.zone_registry(spark, SF, cfg.min_group_size)).cache()
    grid = hourly_demand_grid(orders, enriched, cfg.start, cfg.end)
    summary = zone_summary(orders, enriched, cfg.start, cfg.end).cache()
    yield cfg, orders, zd, enriched, grid, summary
    for df in (orders, zd, enriched, summary):
        df.unpersist()


def test_every_released_zone_day_meets_k(run):
    cfg, _, zd, _, _, _ = run
    assert zd.where(F.col("total_orders") < cfg.min_group_size).count() == 0
    assert zd.groupBy("zone_id", "event_date").count().where("count > 1").count() == 0


def test_grid_counts_all_window_orders_of_released_zones(run):
    cfg, orders, _, enriched, grid, _ = run
    places = enriched.select("zone_id", "neighbourhood", "city").distinct()  # zones may share a place
    expected = orders.where(F.col("event_date").between(cfg.start, cfg.end)).join(places, ["neighbourhood", "city"]).count()
    assert grid.agg(F.sum("order_count")).first()[0] == expected


def test_summary_totals_and_distincts(run):
    _, _, _, enriched, _, summary = run
    assert summary.agg(F.sum("total_orders")).first()[0] == enriched.agg(F.sum("total_orders")).first()[0]
    assert summary.where(F.col("total_customers") > F.col("customer_days")).count() == 0
    assert summary.count() == enriched.select("zone_id").distinct().count()


def test_row_order_does_not_change_results(spark, run):
    cfg, orders, zd, _, _, _ = run
    shuffled = orders.repartition(7, F.rand(seed=11))
    again = zone_day_metrics(shuffled, fixtures.geo_zone_devices(spark, SF), cfg.start, cfg.end, cfg.min_group_size)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, zd.collect()))


def test_sql_form_equals_dataframe_form_and_binds_parameters(spark, run):
    cfg, orders, zd, _, _, _ = run
    zones = fixtures.geo_zone_devices(spark, SF)
    via_sql = zone_day_metrics_sql(spark, orders, zones, cfg.start, cfg.end, cfg.min_group_size)
    assert sorted(map(tuple, via_sql.collect())) == sorted(map(tuple, zd.collect()))
    hostile = "2024-01-01' OR '1'='1"
    try:
        rows = zone_day_metrics_sql(spark, orders, zones, hostile, cfg.end, cfg.min_group_size).count()
    except Exception:  # the bound value is text that is not a date: rejected, never spliced
        rows = 0
    assert rows == 0
