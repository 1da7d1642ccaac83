"""End-to-end windowed run on CSV inputs made from the driver's sf0.001 tables:
staging skips days already staged, keeps earlier days, and every deliverable
lands under its window folder with the same numbers as the lazy queries."""

from __future__ import annotations

import glob
import os

import pandas as pd
import pytest

from conftest import D
from zonepulse.config import RunConfig
from zonepulse.operators.ingest import clean_orders
from zonepulse.operators.zones import enrich_zones, zone_day_metrics
from zonepulse.plans.run import MissingDaysError, RunPaths, run_window, stage_orders
from zonepulse.sources import fixtures, readers
from zonepulse.sources.schemas import ORDER_COLUMNS

SF = "/root/testdata/sf0.001"


def _write_inputs(spark, root):
    src = os.path.join(root, "src")
    os.makedirs(src)
    pdf = fixtures.order_events(spark, SF).toPandas()
    for day, part in pdf.groupby(pdf["event_date"].astype(str)):
        part.to_csv(os.path.join(src, f"orders_{day}.csv"), index=False)
    zones = os.path.join(root, "zones.csv")
    fixtures.geo_zone_devices(spark, SF).toPandas().to_csv(zones, index=False)
    registry = os.path.join(root, "registry.csv")
    fixtures.zone_registry(spark, SF, 3).toPandas().to_csv(registry, index=False)
    return RunPaths(src, zones, registry, os.path.join(root, "interim"), os.path.join(root, "out"))


def test_run_window_end_to_end(spark, scratch):
    paths = _write_inputs(spark, scratch)
    first = RunConfig(start=D(2024, 1, 1), end=D(2024, 1, 10), min_group_size=3)
    r1 = run_window(spark, first, paths)
    assert len(r1.staged_days) == 10

    second = first.with_(start=D(2024, 1, 8), end=D(2024, 1, 30))
    r2 = run_window(spark, second, paths)
    assert sorted(r2.staged_days) == [D(2024, 1, d) for d in range(11, 31)]   # 8..10 skipped
    staged = sorted(os.path.basename(p) for p in glob.glob(os.path.join(paths.interim, "event_date=*")))
    assert len(staged) == 30                                                   # day 1 kept (D1)
    assert run_window(spark, second, paths).staged_days == []                  # idempotent

    # zone-day output equals the lazy operator over the same cleaned orders
    orders = clean_orders(fixtures.order_events(spark, SF))
    want = zone_day_metrics(orders, fixtures.geo_zone_devices(spark, SF), second.start, second.end, 3)
    got = spark.read.parquet(r2.outputs["zone_day"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    enriched = enrich_zones(want, fixtures.zone_registry(spark, SF, 3))
    # the CSV hand-over reads back with its declared schema to the same rows
    handed = readers.read_zone_day_csv(spark, r2.outputs["zone_day"].replace("/parquet", "/csv"))
    assert handed.schema == got.schema
    assert sorted(map(tuple, handed.collect())) == sorted(map(tuple, got.collect()))

    # summary: one CSV file with header, sorted by total_orders desc
    files = glob.glob(os.path.join(r2.outputs["summary_csv"], "*.csv"))
    assert len(files) == 1
    summary = pd.read_csv(files[0])
    assert list(summary["total_orders"]) == sorted(summary["total_orders"], reverse=True)
    assert r2.metrics["summary_zones"] == len(summary)
    assert r2.metrics["enriched_zone_days"] == enriched.count()
    assert r2.metrics["underserved_zones"] == int(summary["is_underserved"].sum())

    # grid: Parquet and CSV partitioned by city, city read back from the folder names
    grid = spark.read.parquet(r2.outputs["grid_parquet"])
    assert "city" in grid.columns and grid.count() > 0
    csv_dirs = glob.glob(os.path.join(r2.outputs["grid_csv"], "city=*"))
    assert len(csv_dirs) == grid.select("city").distinct().count()
    for d in csv_dirs:
        assert len(glob.glob(os.path.join(d, "*.csv"))) == 1
    assert os.path.isdir(r2.outputs["hotspot_csv"]) and os.path.isdir(r2.outputs["underserved_csv"])
    assert r2.outputs["summary_csv"].endswith("2024-01-08_to_2024-01-30")


def _day(src, day, rows):
    """One raw file; rows are (order id, event date, hour, value)."""
    names = [n for n, _ in ORDER_COLUMNS]
    lines = [",".join(names)]
    for oid, date, hour, value in rows:
        given = {"order_id": oid, "event_date": date, "order_timestamp": f"2025-01-06 {hour:02d}:00:00", "customer_id": "C1",
                 "restaurant_id": "R1", "cuisine_type": "Thai", "order_value_usd": value, "city": "New York", "neighbourhood": "Queens"}
        lines.append(",".join(str(given.get(n, "")) for n in names))
    os.makedirs(src, exist_ok=True)
    with open(os.path.join(src, f"orders_{day}.csv"), "w") as f:
        f.write("\n".join(lines) + "\n")


def _paths(root):
    return RunPaths(os.path.join(root, "src"), None, "", os.path.join(root, "interim"), os.path.join(root, "out"))


def _staged(spark, paths, cfg):
    return sorted((r.order_id, r.event_date, r.order_value_usd) for r in
                  readers.read_interim(spark, paths.interim, cfg.start, cfg.end).collect())


def test_rows_of_another_day_are_kept(spark, scratch):
    paths, d6, d7 = _paths(scratch), D(2025, 1, 6), D(2025, 1, 7)
    both = RunConfig(start=d6, end=d7)
    _day(paths.orders_src, d6, [(f"a{i}", d6, 8, 5.0) for i in range(5)])
    first = stage_orders(spark, both.with_(end=d6), paths)
    assert (first.staged_days, first.late_rows) == ([d6], 0)
    # the file of the 7th holds a row of the 6th, a correction of one, one without a date and a bad one
    _day(paths.orders_src, d7, [("b0", d7, 9, 1.0), ("late", d6, 9, 2.0), ("a0", d6, 10, 6.0), ("nodate", "", 9, 3.0), ("bad", d7, 9, "NaN")])
    second = stage_orders(spark, both, paths)
    assert (second.staged_days, second.late_rows) == ([d7], 3)
    assert second.rejected == {"rows": 5, "no_value": 0, "not_positive": 0, "not_finite_or_too_large": 1, "undated": 1}
    want = [("a0", d6, 6.0)] + [(f"a{i}", d6, 5.0) for i in range(1, 5)] + [("b0", d7, 1.0), ("late", d6, 2.0)]
    assert _staged(spark, paths, both) == sorted(want)
    # nothing to do, and loading a re-delivered file again changes only its own rows
    assert stage_orders(spark, both, paths).staged_days == []
    again = stage_orders(spark, both, paths, restage=[d7])
    assert (again.staged_days, again.late_rows) == ([d7], 3)
    assert _staged(spark, paths, both) == sorted(want)
    _day(paths.orders_src, d6, [("a9", d6, 8, 4.0)])
    stage_orders(spark, both, paths, restage=[d6])
    assert _staged(spark, paths, both) == sorted([("a9", d6, 4.0), ("a0", d6, 6.0), ("b0", d7, 1.0), ("late", d6, 2.0)])


def test_missing_days_fail_unless_allowed(spark, scratch):
    paths, cfg = _paths(scratch), RunConfig(start=D(2025, 1, 6), end=D(2025, 1, 8))
    with pytest.raises(MissingDaysError) as error:      # wrong or empty folder, first run
        stage_orders(spark, cfg, paths)
    assert error.value.days == [D(2025, 1, d) for d in (6, 7, 8)]
    _day(paths.orders_src, D(2025, 1, 7), [("a", D(2025, 1, 7), 8, 5.0)])
    with pytest.raises(MissingDaysError):
        run_window(spark, cfg, paths)
    result = stage_orders(spark, cfg, paths, allow_missing_days=True)
    assert result.staged_days == [D(2025, 1, 7)] and result.missing_days == [D(2025, 1, 6), D(2025, 1, 8)]


def test_run_from_a_delivered_aggregate(spark, scratch):
    paths = _write_inputs(spark, scratch)
    cfg = RunConfig(start=D(2024, 1, 1), end=D(2024, 1, 30), min_group_size=3)
    own = run_window(spark, cfg, paths)
    delivered = own.outputs["zone_day"].replace("/parquet", "/csv")
    there = RunPaths(paths.orders_src, None, paths.registry, paths.interim, os.path.join(scratch, "out2"), zone_day=delivered)
    other = run_window(spark, cfg, there)
    assert other.metrics == own.metrics
    rows = lambda r, name: sorted(map(str, spark.read.parquet(r.outputs[name]).collect()))
    assert rows(other, "grid_parquet") == rows(own, "grid_parquet")
    text = lambda r: sorted(x for f in glob.glob(os.path.join(r.outputs["summary_csv"], "*.csv")) for x in open(f))
    assert text(other) == text(own)
