"""Hourly demand grid: zone x hour of day x day of week."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonepulse.functions.exprs import rounded_mean
from zonepulse.operators.joins import attach, restrict_to
from zonepulse.operators.profile import group_profile
from zonepulse.sources.schemas import REPORT_ZONE_ATTRS

GRID_COLUMNS = REPORT_ZONE_ATTRS + [
    "order_hour",
    "day_of_week",
    "order_count",
    "avg_order_value_usd",
    "distinct_customers",
    "distinct_restaurants",
    "top_cuisine",
    "city_rank",
]


def released_zones(enriched: DataFrame) -> DataFrame:
    """Distinct zone attributes of the enriched zone-days: one row per zone.

    Joining orders to these (instead of to zone-day rows) counts every order
    once, however many days of its zone were released.
    """
    return enriched.select(*REPORT_ZONE_ATTRS).distinct()


def hourly_demand_grid(
    orders: DataFrame,
    enriched: DataFrame,
    start: dt.date,
    end: dt.date,
    min_cell_size: int = 1,
    approx_distinct: bool = False,
) -> DataFrame:
    """Demand per (zone, order_hour, day_of_week) over the window.

    All window orders of every zone with at least one released day count.
    order_count, avg_order_value_usd (2 dp), distinct customers and
    restaurants, top_cuisine (mode, ties -> lowest); cells below
    ``min_cell_size`` are not published.  city_rank = rank() of the cell's
    order_count within its city, descending; ties share a rank.

    Plan: pruned window scan -> left-semi join to the released
    zones' (neighbourhood, city) -> grouping-sets aggregate on (neighbourhood,
    city, hour, weekday) -> zone attributes joined to the cells -> one window
    shuffle by city over the cells (at most zones x 168 rows).
    """
    window = orders.select(
        "order_id", "event_date", "order_value_usd", "customer_id", "restaurant_id",
        "cuisine_type", "order_hour", "day_of_week", "neighbourhood", "city",
    ).where(F.col("event_date").between(F.lit(start), F.lit(end)))
    zones = released_zones(enriched)
    geo = ["neighbourhood", "city"]
    cells = (
        group_profile(
            restrict_to(window, zones, geo),
            geo + ["order_hour", "day_of_week"],
            count_col="order_id",
            value_col="order_value_usd",
            distinct={"distinct_customers": "customer_id", "distinct_restaurants": "restaurant_id"},
            modes={"top_cuisine": "cuisine_type"},
            approx_distinct=approx_distinct,
        )
        .where(F.col("_n") >= F.lit(min_cell_size))
        .withColumnRenamed("_n", "order_count")
        .withColumn("avg_order_value_usd", rounded_mean("value", 2))
    )
    by_city = Window.partitionBy("city").orderBy(F.desc("order_count"))
    return (
        attach(cells, zones, geo)
        .withColumn("city_rank", F.rank().over(by_city))
        .select(*GRID_COLUMNS)
    )
