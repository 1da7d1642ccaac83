from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from zonepulse.sources.schemas import ORDER_COLUMNS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[*]")
        .appName("zonepulse-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def raw_orders(spark, rows: list[dict]):
    """Raw (all-text) order frame; columns not given are null."""
    names = [n for n, _ in ORDER_COLUMNS]
    data = [tuple(None if r.get(n) is None else str(r[n]) for n in names) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"{n} string" for n in names))


def order(oid, day="2025-01-06", ts="2025-01-06 12:00:00", cust="C1", rest="R1", cuisine="Pizza",
          value=10.0, city="New York", nb="Manhattan"):
    return {
        "order_id": oid, "event_date": day, "order_timestamp": ts, "customer_id": cust,
        "restaurant_id": rest, "cuisine_type": cuisine, "order_value_usd": value,
        "city": city, "neighbourhood": nb,
    }


def zone_rows(spark, rows: list[tuple]):
    """(zone_id, neighbourhood, city, density, area) -> zone table."""
    data = [(z, nb, c, c[:2], "mixed", 0.0, 0.0, float(d), 30.0, float(a)) for z, nb, c, d, a in rows]
    return spark.createDataFrame(
        data,
        "zone_id string, neighbourhood string, city string, state string, zone_type string, "
        "centre_lat double, centre_lon double, device_density_per_km2 double, "
        "avg_dwell_time_min double, zone_area_km2 double",
    )


def registry_rows(spark, rows: list[tuple]):
    """(zone_id, threshold text) -> registry (all text)."""
    data = [(z, "STUDY_1", "CAMP_1", None, t, None, None) for z, t in rows]
    return spark.createDataFrame(
        data,
        "zone_id string, study_id string, campaign_id string, target_city string, "
        "min_order_threshold string, ext1 string, ext2 string",
    )


D = dt.date
