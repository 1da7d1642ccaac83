"""Declared schemas of the inputs and outputs.  Nothing is inferred: inference is
an extra pass over the data, and its result would depend on the content."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    StringType,
    StructField,
    StructType,
)


def _all_strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


# Fixed values (file contract, as are all column names of this module).
# Order columns in file order, with the type each one has after cleaning.
ORDER_COLUMNS: list[tuple[str, str]] = [
    ("order_id", "string"),
    ("event_date", "date"),
    ("order_timestamp", "timestamp_ntz"),
    ("customer_id", "string"),
    ("restaurant_id", "string"),
    ("cuisine_type", "string"),
    ("pickup_lat", "double"),
    ("pickup_lon", "double"),
    ("delivery_lat", "double"),
    ("delivery_lon", "double"),
    ("order_value_usd", "double"),
    ("city", "string"),
    ("neighbourhood", "string"),
]

# Raw CSV is read as text; clean_orders casts with try_cast.
RAW_ORDERS = _all_strings(*(n for n, _ in ORDER_COLUMNS))

# Orders after cleaning: the columns above with their types, and two derived ones.
CLEAN_ORDERS = ", ".join(f"{name} {t}" for name, t in ORDER_COLUMNS) + ", order_hour int, day_of_week int"

ZONES = StructType(
    [
        StructField("zone_id", StringType(), True),
        StructField("neighbourhood", StringType(), True),
        StructField("city", StringType(), True),
        StructField("state", StringType(), True),
        StructField("zone_type", StringType(), True),
        StructField("centre_lat", DoubleType(), True),
        StructField("centre_lon", DoubleType(), True),
        StructField("device_density_per_km2", DoubleType(), True),
        StructField("avg_dwell_time_min", DoubleType(), True),
        StructField("zone_area_km2", DoubleType(), True),
    ]
)

REGISTRY_COLUMNS = [
    "zone_id",
    "study_id",
    "campaign_id",
    "target_city",
    "min_order_threshold",
    "ext1",
    "ext2",
]
REGISTRY = _all_strings(*REGISTRY_COLUMNS)

# Zone attributes carried by the zone x day aggregate (grouping columns).
ZONE_ATTRS = [
    "zone_id",
    "neighbourhood",
    "city",
    "state",
    "zone_type",
    "device_density_per_km2",
    "avg_dwell_time_min",
    "zone_area_km2",
]

# Zone attributes published by the grid and the summary.
REPORT_ZONE_ATTRS = [
    "zone_id",
    "neighbourhood",
    "city",
    "state",
    "zone_type",
    "study_id",
    "campaign_id",
    "device_density_per_km2",
    "zone_area_km2",
]

ZONE_DAY_COLUMNS = ZONE_ATTRS + [
    "total_orders",
    "distinct_customers",
    "distinct_restaurants",
    "avg_order_value_usd",
    "total_order_value_usd",
    "peak_hour",
    "top_cuisine",
    "orders_per_device_ratio",
    "event_date",
]

# The zone x day aggregate as it is handed over in files.
ZONE_DAY = (
    "zone_id string, neighbourhood string, city string, state string, zone_type string, "
    "device_density_per_km2 double, avg_dwell_time_min double, zone_area_km2 double, "
    "total_orders bigint, distinct_customers bigint, distinct_restaurants bigint, "
    "avg_order_value_usd double, total_order_value_usd double, peak_hour int, top_cuisine string, "
    "orders_per_device_ratio double, event_date date"
)
