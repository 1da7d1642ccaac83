"""The reference suite's literal cases (fixed values), run through the library's own functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import D, order, raw_orders, registry_rows, zone_rows
from zonepulse.operators.grid import hourly_demand_grid
from zonepulse.operators.ingest import clean_orders, day_spine, missing_days
from zonepulse.operators.summary import thresholds, underserved_flag
from zonepulse.operators.zones import enrich_zones, zone_day_metrics


def test_day_spine_single_day(spark):
    days = [r.event_date for r in day_spine(spark, D(2025, 1, 1), D(2025, 1, 1)).collect()]
    assert days == [D(2025, 1, 1)]


def test_day_spine_seven_days_inclusive(spark):
    days = [r.event_date for r in day_spine(spark, D(2025, 1, 1), D(2025, 1, 7)).collect()]
    assert len(days) == 7 and days[0] == D(2025, 1, 1) and days[-1] == D(2025, 1, 7)


def test_day_spine_ascending_and_reversed_is_empty(spark):
    days = [r.event_date for r in day_spine(spark, D(2025, 6, 1), D(2025, 6, 5)).collect()]
    assert days == sorted(days)
    assert day_spine(spark, D(2025, 6, 5), D(2025, 6, 1)).count() == 0


def test_staged_day_is_skipped(spark):
    spine = day_spine(spark, D(2025, 1, 1), D(2025, 1, 3))
    staged = spark.createDataFrame([(D(2025, 1, 2),), (D(2025, 1, 2),)], "event_date date")
    todo = sorted(r.event_date for r in missing_days(spine, staged).collect())
    assert todo == [D(2025, 1, 1), D(2025, 1, 3)]
    nothing_staged = spark.createDataFrame([], "event_date date")
    assert missing_days(spine, nothing_staged).count() == 3


def test_dedup_on_order_id_and_date(spark):
    rows = [order("ORD_001", day="2025-01-01", cust="CUST_1", value=15.0)] * 2 + [
        order("ORD_002", day="2025-01-01", cust="CUST_2", value=22.5)
    ]
    assert clean_orders(raw_orders(spark, rows)).count() == 2


def test_zero_and_negative_value_orders_excluded(spark):
    rows = [order("ORD_001", value=0.0), order("ORD_002", value=12.5), order("ORD_003", value=-1.0)]
    out = clean_orders(raw_orders(spark, rows)).collect()
    assert [r.order_id for r in out] == ["ORD_002"]


def test_grid_cell_aggregation(spark):
    # Monday 2025-01-06, hour 12 -> day_of_week 2
    rows = [
        order("O1", value=15.0, cust="C1", rest="R1", cuisine="Pizza", ts="2025-01-06 12:01:00"),
        order("O2", value=20.0, cust="C2", rest="R1", cuisine="Pizza", ts="2025-01-06 12:02:00"),
        order("O3", value=10.0, cust="C1", rest="R2", cuisine="Burgers", ts="2025-01-06 12:03:00"),
    ]
    orders = clean_orders(raw_orders(spark, rows))
    zones = zone_rows(spark, [("Z001", "Manhattan", "New York", 4500.0, 2.0)])
    win = (D(2025, 1, 6), D(2025, 1, 6))
    zd = zone_day_metrics(orders, zones, *win, min_group_size=1)
    enriched = enrich_zones(zd, registry_rows(spark, [("Z001", "1")]))
    cell = hourly_demand_grid(orders, enriched, *win).collect()
    assert len(cell) == 1
    c = cell[0]
    assert (c.order_hour, c.day_of_week) == (12, 2)
    assert c.order_count == 3
    assert c.distinct_customers == 2
    assert abs(c.avg_order_value_usd - 15.0) < 0.01
    assert c.distinct_restaurants == 2
    assert c.top_cuisine == "Pizza"
    assert c.city_rank == 1


def _flag_frame(spark):
    return spark.createDataFrame(
        [("Z001", 4500.0, 0.001), ("Z002", 300.0, 0.150), ("Z003", 4800.0, 0.200)],
        "zone_id string, device_density_per_km2 double, orders_per_device_ratio double",
    )


def test_underserved_fixed_thresholds(spark):
    df = _flag_frame(spark).withColumn("is_underserved", underserved_flag(F.lit(4000.0), F.lit(0.05)))
    assert [r.zone_id for r in df.where("is_underserved").collect()] == ["Z001"]


def test_underserved_real_quantiles_flag_nobody(spark):
    df = _flag_frame(spark)
    t = thresholds(df).first()
    assert (t.density_threshold, t.ratio_median) == (4800.0, 0.15)
    flagged = df.crossJoin(thresholds(df)).withColumn(
        "f", underserved_flag(F.col("density_threshold"), F.col("ratio_median"))
    )
    assert flagged.where("f").count() == 0


def test_day_of_week_is_one_based_sunday(spark):
    out = clean_orders(raw_orders(spark, [order("O1", day="2025-01-05", ts="2025-01-05 08:00:00")])).first()
    assert out.day_of_week == 1 and out.order_hour == 8
    assert isinstance(out.event_date, dt.date)
