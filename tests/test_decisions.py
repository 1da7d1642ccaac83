"""One test per semantic decision and the edge rows every suite needs."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import D, order, raw_orders, registry_rows, zone_rows
from zonepulse.functions.exprs import exact_avg, round_half_up, safe_ratio
from zonepulse.operators.grid import hourly_demand_grid
from zonepulse.operators.ingest import clean_orders, rejected_orders
from zonepulse.operators.summary import hotspot_report, run_metrics, thresholds, zone_summary
from zonepulse.operators.zones import enrich_zones, zone_day_metrics
from zonepulse.plans.sinks import write_interim

WIN = (D(2025, 1, 6), D(2025, 1, 7))


def _zones(spark):
    return zone_rows(spark, [
        ("Z1", "Manhattan", "New York", 4000.0, 2.0),
        ("Z2", "Queens", "New York", 1000.0, 0.0),      # density x area = 0
        ("Z3", "Loop", "Chicago", 500.0, 1.0),
    ])


def test_d1_second_daily_load_keeps_first_day(spark, scratch):
    root = os.path.join(scratch, "interim")
    day1 = clean_orders(raw_orders(spark, [order("A", day="2025-01-06", ts="2025-01-06 10:00:00")]))
    day2 = clean_orders(raw_orders(spark, [order("B", day="2025-01-07", ts="2025-01-07 10:00:00")]))
    write_interim(day1, root)
    write_interim(day2, root)
    write_interim(day2, root)  # re-load is idempotent
    back = spark.read.parquet(root)
    assert sorted((r.order_id, r.event_date) for r in back.collect()) == [
        ("A", D(2025, 1, 6)), ("B", D(2025, 1, 7))
    ]


def test_d2_grid_counts_each_order_once(spark):
    rows = [order(f"a{i}", day="2025-01-06", ts="2025-01-06 12:00:00") for i in range(3)]
    rows += [order(f"b{i}", day="2025-01-07", ts="2025-01-07 12:00:00") for i in range(3)]
    orders = clean_orders(raw_orders(spark, rows))
    zd = zone_day_metrics(orders, _zones(spark), *WIN, min_group_size=2)
    assert zd.count() == 2  # the zone survives on both days
    enriched = enrich_zones(zd, registry_rows(spark, [("Z1", "1")]))
    grid = hourly_demand_grid(orders, enriched, *WIN)
    assert grid.agg(F.sum("order_count")).first()[0] == 6


def test_d3_true_distinct_customers_and_mean(spark):
    rows = [
        order("a", day="2025-01-06", ts="2025-01-06 12:00:00", cust="C1", value=10.0),
        order("b", day="2025-01-06", ts="2025-01-06 13:00:00", cust="C2", value=20.0),
        order("c", day="2025-01-07", ts="2025-01-07 12:00:00", cust="C1", value=30.0),
        order("d", day="2025-01-07", ts="2025-01-07 12:30:00", cust="C1", value=60.0),
        order("e", day="2025-01-07", ts="2025-01-07 12:40:00", cust="C1", value=90.0),
    ]
    orders = clean_orders(raw_orders(spark, rows))
    zd = zone_day_metrics(orders, _zones(spark), *WIN, min_group_size=2)
    enriched = enrich_zones(zd, registry_rows(spark, [("Z1", "1")]))
    s = zone_summary(orders, enriched, *WIN).first()
    assert s.total_orders == 5
    assert s.customer_days == 3 and s.total_customers == 2
    assert s.avg_order_value_usd == 42.0            # (10+20+30+60+90)/5
    assert s.avg_daily_order_value_usd == 37.5      # mean of 15.0 and 60.0
    assert s.peak_hour == 12 and s.top_cuisine == "Pizza"


def test_d4_mode_ties_go_to_lowest(spark):
    rows = [
        order("a", ts="2025-01-06 18:00:00", cuisine="Thai"),
        order("b", ts="2025-01-06 18:10:00", cuisine="Pizza"),
        order("c", ts="2025-01-06 09:00:00", cuisine="Thai"),
        order("d", ts="2025-01-06 09:10:00", cuisine="Pizza"),
        order("e", ts="2025-01-06 23:10:00", cuisine=None),
        order("f", ts="2025-01-06 23:20:00", cuisine=None),
        order("g", ts="2025-01-06 23:30:00", cuisine=None),
    ]
    orders = clean_orders(raw_orders(spark, rows))
    zd = zone_day_metrics(orders, _zones(spark), *WIN, min_group_size=1).first()
    assert zd.top_cuisine == "Pizza"      # nulls are not a value
    assert zd.peak_hour == 23             # 3 orders at 23h


def test_d4_hour_tie(spark):
    rows = [order("a", ts="2025-01-06 18:00:00"), order("b", ts="2025-01-06 09:00:00")]
    zd = zone_day_metrics(clean_orders(raw_orders(spark, rows)), _zones(spark), *WIN, min_group_size=1)
    assert zd.first().peak_hour == 9


def test_d6_filter_before_dedup_and_latest_wins(spark):
    rows = [
        order("X", ts="2025-01-06 10:00:00", value=25.0),
        order("X", ts="2025-01-06 11:00:00", value=-5.0),   # corrupt re-delivery
        order("Y", ts="2025-01-06 10:00:00", value=10.0),
        order("Y", ts="2025-01-06 10:05:00", value=12.0),   # later correction
        order("Z", ts="2025-01-06 10:00:00", value=7.0, cust="C1"),
        order("Z", ts="2025-01-06 10:00:00", value=7.0, cust="C9"),  # tie -> other columns
    ]
    out = {r.order_id: r for r in clean_orders(raw_orders(spark, rows)).collect()}
    assert out["X"].order_value_usd == 25.0
    assert out["Y"].order_value_usd == 12.0 and out["Y"].order_timestamp.minute == 5
    assert out["Z"].customer_id == "C9"
    # row order does not matter
    again = {r.order_id: r for r in clean_orders(raw_orders(spark, rows[::-1])).collect()}
    assert again == out


def test_d7_ratio_is_double_precision(spark):
    df = spark.createDataFrame([(16777217, 1.0)], "n long, d double")
    assert df.select(safe_ratio("n", "d").alias("r")).first().r == 16777217.0


def test_d8_half_up_rounding(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (0.12345,), (None,)], "x double")
    got = [r.r for r in df.select(round_half_up("x", 2).alias("r")).collect()]
    assert got[:3] == [1.01, 2.68, -1.01] and got[4] is None
    assert df.select(round_half_up("x", 4).alias("r")).collect()[3].r == 0.1235


def test_d9_bad_text_becomes_null_not_error(spark):
    rows = [
        order("ok", value="12.5"),
        order("bad_value", value="twelve"),
        order("bad_ts", ts="not a time", value="3.0"),
        order("bad_day", day="2025-13-45", value="4.0"),
    ]
    out = {r.order_id: r for r in clean_orders(raw_orders(spark, rows)).collect()}
    assert "bad_value" not in out
    assert out["bad_ts"].order_timestamp is None and out["bad_ts"].order_hour is None
    assert out["bad_day"].event_date is None
    reg = registry_rows(spark, [("Z1", "abc")])
    zd = zone_day_metrics(clean_orders(raw_orders(spark, [order("ok")])), _zones(spark), *WIN, min_group_size=1)
    assert enrich_zones(zd, reg).count() == 0


def test_d10_exact_discrete_percentiles(spark):
    df = spark.createDataFrame([(float(v), float(v) / 100) for v in range(1, 11)],
                               "device_density_per_km2 double, orders_per_device_ratio double")
    t = thresholds(df, 0.75, 0.5).first()
    assert (t.density_threshold, t.ratio_median) == (8.0, 0.05)
    empty = thresholds(df.limit(0)).first()
    assert empty.density_threshold is None and empty.ratio_median is None
    a = thresholds(df, 0.75, 0.5, approx=True).first()
    assert (a.density_threshold, a.ratio_median) == (8.0, 0.05)


def test_d12_min_cell_size_suppresses_small_cells(spark):
    rows = [order("a", ts="2025-01-06 12:00:00"), order("b", ts="2025-01-06 12:10:00"),
            order("c", ts="2025-01-06 15:00:00")]
    orders = clean_orders(raw_orders(spark, rows))
    enriched = enrich_zones(zone_day_metrics(orders, _zones(spark), *WIN, min_group_size=1),
                            registry_rows(spark, [("Z1", "1")]))
    assert hourly_demand_grid(orders, enriched, *WIN).count() == 2
    kept = hourly_demand_grid(orders, enriched, *WIN, min_cell_size=2).collect()
    assert [(r.order_hour, r.order_count) for r in kept] == [(12, 2)]


def test_d13_group_size_gate_and_registry_threshold(spark):
    rows = [order(f"m{i}", ts="2025-01-06 12:00:00") for i in range(5)]                # Z1: 5
    rows += [order(f"q{i}", ts="2025-01-06 12:00:00", nb="Queens") for i in range(4)]  # Z2: 4
    rows += [order(f"l{i}", ts="2025-01-06 12:00:00", nb="Loop", city="Chicago") for i in range(6)]
    orders = clean_orders(raw_orders(spark, rows))
    zd = zone_day_metrics(orders, _zones(spark), *WIN, min_group_size=5)
    assert sorted(r.zone_id for r in zd.collect()) == ["Z1", "Z3"]   # exactly k kept, k-1 dropped
    enriched = enrich_zones(zd, registry_rows(spark, [("Z1", "5"), ("Z3", "7")]))
    assert [r.zone_id for r in enriched.collect()] == ["Z1"]         # threshold above the gate bites


def test_edge_rows(spark):
    rows = [
        order("a", ts="2025-01-06 12:00:00", nb=None),                   # null key: dropped
        order("b", ts="2025-01-06 12:00:00", nb="Nowhere"),              # no zone: dropped
        order("c", ts="2025-01-06 12:00:00", nb="Queens"),               # area 0: ratio null
        order("d", ts="2025-01-06 12:00:00"),
    ]
    orders = clean_orders(raw_orders(spark, rows))
    zd = {r.zone_id: r for r in zone_day_metrics(orders, _zones(spark), *WIN, min_group_size=1).collect()}
    assert set(zd) == {"Z1", "Z2"}
    assert zd["Z2"].orders_per_device_ratio is None
    assert zd["Z1"].orders_per_device_ratio == 0.0001   # 1 / (4000 x 2) = 0.000125


def test_rank_ties_share_rank_and_top_n(spark):
    rows = [order(f"m{i}", ts="2025-01-06 12:00:00") for i in range(2)]
    rows += [order(f"q{i}", ts="2025-01-06 12:00:00", nb="Queens") for i in range(2)]
    rows += [order(f"x{i}", ts="2025-01-06 12:00:00", nb="Bronx") for i in range(1)]
    zones = zone_rows(spark, [("Z1", "Manhattan", "New York", 1.0, 1.0), ("Z2", "Queens", "New York", 1.0, 1.0),
                              ("Z4", "Bronx", "New York", 1.0, 1.0)])
    orders = clean_orders(raw_orders(spark, rows))
    enriched = enrich_zones(zone_day_metrics(orders, zones, *WIN, min_group_size=1),
                            registry_rows(spark, [("Z1", "1"), ("Z2", "1"), ("Z4", "1")]))
    grid = {r.zone_id: r.city_rank for r in hourly_demand_grid(orders, enriched, *WIN).collect()}
    assert grid == {"Z1": 1, "Z2": 1, "Z4": 3}
    top = hotspot_report(zone_summary(orders, enriched, *WIN), top_n=1).collect()
    assert sorted(r.zone_id for r in top) == ["Z1", "Z2"]


def test_empty_window_yields_empty_outputs(spark):
    orders = clean_orders(raw_orders(spark, [order("a", day="2024-01-01", ts="2024-01-01 12:00:00")]))
    zd = zone_day_metrics(orders, _zones(spark), *WIN, min_group_size=1)
    enriched = enrich_zones(zd, registry_rows(spark, [("Z1", "1")]))
    assert zd.count() == 0 and enriched.count() == 0
    summary = zone_summary(orders, enriched, *WIN)
    assert summary.count() == 0
    assert hourly_demand_grid(orders, enriched, *WIN).count() == 0
    m = run_metrics(enriched, summary).first()
    assert (m.enriched_zone_days, m.summary_zones, m.underserved_zones) == (0, 0, 0)


def test_null_density_gives_null_ratio_and_no_flag(spark):
    zones = spark.createDataFrame(
        [("Z9", "Harlem", "New York", "Ne", "mixed", 0.0, 0.0, None, 30.0, 1.0)],
        "zone_id string, neighbourhood string, city string, state string, zone_type string, "
        "centre_lat double, centre_lon double, device_density_per_km2 double, "
        "avg_dwell_time_min double, zone_area_km2 double",
    )
    orders = clean_orders(raw_orders(spark, [order("h1", nb="Harlem"), order("h2", nb="Harlem")]))
    zd = zone_day_metrics(orders, zones, *WIN, min_group_size=1)
    assert zd.first().orders_per_device_ratio is None
    enriched = enrich_zones(zd, registry_rows(spark, [("Z9", "1")]))
    s = zone_summary(orders, enriched, *WIN).first()
    assert s.orders_per_device_ratio is None and s.is_underserved is False


def test_grid_keeps_null_hour_cell_with_its_mode(spark):
    rows = [order("t1", ts="not a time", cuisine="Thai"), order("t2", ts="also bad", cuisine="Thai"),
            order("ok", ts="2025-01-06 12:00:00", cuisine="Pizza")]
    orders = clean_orders(raw_orders(spark, rows))
    enriched = enrich_zones(zone_day_metrics(orders, _zones(spark), *WIN, min_group_size=1),
                            registry_rows(spark, [("Z1", "1")]))
    cells = {(r.order_hour, r.day_of_week): r for r in hourly_demand_grid(orders, enriched, *WIN).collect()}
    assert set(cells) == {(None, None), (12, 2)}
    assert cells[(None, None)].order_count == 2 and cells[(None, None)].top_cuisine == "Thai"
    assert cells[(12, 2)].top_cuisine == "Pizza"


def test_non_finite_and_huge_values_drop_out(spark):
    rows = [order("a", value=10.0), order("b", value="NaN"), order("c", value="Infinity"), order("d", value="1e40"),
            order("e", value="-Infinity"), order("f", value="n/a"), order("g", value=20.0)]
    orders = clean_orders(raw_orders(spark, rows))
    assert sorted(r.order_id for r in orders.collect()) == ["a", "g"]
    zd = zone_day_metrics(orders, _zones(spark), *WIN, min_group_size=1).first()
    assert zd.avg_order_value_usd == 15.0 and zd.total_order_value_usd == 30.0
    counts = rejected_orders(raw_orders(spark, rows)).first().asDict()
    assert counts == {"rows": 7, "no_value": 1, "not_positive": 1, "not_finite_or_too_large": 3, "undated": 0}


def test_exact_mean_counts_what_it_sums(spark):
    df = spark.createDataFrame([(10.0,), (float("nan"),), (float("inf"),), (1e40,), (None,)], "x double")
    assert df.agg(exact_avg("x")).first()[0] == 10.0


def test_zones_of_one_place_keep_their_own_days(spark):
    """Two zones at one place, released on different days (D3): orders of a day that was not
    released for a zone stay out of its row."""
    rows = [order(f"a{i}", day="2025-01-06", ts="2025-01-06 12:00:00", cust=f"C{i}", value=10.0) for i in range(5)]
    rows += [order(f"b{i}", day="2025-01-07", ts="2025-01-07 12:00:00", cust=f"D{i}", value=50.0) for i in range(3)]
    orders = clean_orders(raw_orders(spark, rows))
    zones = zone_rows(spark, [("Z1", "Manhattan", "New York", 10.0, 1.0), ("Z2", "Manhattan", "New York", 20.0, 1.0)])
    zd = zone_day_metrics(orders, zones, *WIN, min_group_size=1)
    enriched = enrich_zones(zd, registry_rows(spark, [("Z1", "1"), ("Z2", "4")]))
    s = {r.zone_id: r for r in zone_summary(orders, enriched, *WIN).collect()}
    assert (s["Z1"].total_orders, s["Z1"].total_customers, s["Z1"].avg_order_value_usd) == (8, 8, 25.0)
    assert (s["Z2"].total_orders, s["Z2"].total_customers, s["Z2"].avg_order_value_usd) == (5, 5, 10.0)
    assert all(r.total_customers <= r.customer_days for r in s.values())
