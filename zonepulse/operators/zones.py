"""Zone x day metrics (the protected aggregate) and their enrichment."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.config import DEFAULT_MIN_GROUP_SIZE
from zonepulse.functions.exprs import MONEY_SCALE, round_half_up, rounded_mean, safe_ratio
from zonepulse.operators.joins import attach, restrict_to
from zonepulse.operators.profile import group_profile
from zonepulse.sources.schemas import REGISTRY_COLUMNS, ZONE_ATTRS, ZONE_DAY_COLUMNS

_ORDER_INPUTS = [
    "order_id", "event_date", "order_hour", "customer_id", "restaurant_id",
    "cuisine_type", "order_value_usd", "neighbourhood", "city",
]


def zone_day_metrics(
    orders: DataFrame,
    zones: DataFrame,
    start: dt.date,
    end: dt.date,
    min_group_size: int = DEFAULT_MIN_GROUP_SIZE,
    approx_distinct: bool = False,
) -> DataFrame:
    """Orders per zone and day, released only for groups of at least ``min_group_size``.

    Grain: (zone, event_date).  Orders match a zone on (neighbourhood, city);
    orders without a zone, or with a null key, drop out.  Output columns:
    the eight zone attributes, total_orders, distinct_customers,
    distinct_restaurants, avg_order_value_usd / total_order_value_usd (2 dp),
    peak_hour and top_cuisine (mode, ties -> lowest), orders_per_device_ratio
    (= total_orders / (density x area), null when that is 0; 4 dp), event_date.

    Plan: window filter pushed into the scan; a left-semi join (a broadcast for a small
    zone table) drops orders of unknown places; one grouping-sets aggregate on the orders'
    own keys (neighbourhood, city, event_date), see :func:`group_profile`; suppression; then
    the zone attributes are joined to the aggregate.  Several zones may share a place; each
    gets all its orders.  Assumes one zone row per zone, as in a dimension table.
    """
    window = orders.select(*_ORDER_INPUTS).where(
        F.col("event_date").between(F.lit(start), F.lit(end))
    )
    dim = zones.select(*ZONE_ATTRS)
    geo = ["neighbourhood", "city"]
    profile = group_profile(
        restrict_to(window, dim, geo),
        geo + ["event_date"],
        count_col="order_id",
        value_col="order_value_usd",
        distinct={"distinct_customers": "customer_id", "distinct_restaurants": "restaurant_id"},
        modes={"peak_hour": "order_hour", "top_cuisine": "cuisine_type"},
        approx_distinct=approx_distinct,
    ).where(F.col("_n") >= F.lit(min_group_size))
    agg = attach(profile, dim, geo).withColumnRenamed("_n", "total_orders")
    ratio = safe_ratio("total_orders", F.col("device_density_per_km2") * F.col("zone_area_km2"))
    return agg.withColumns(
        {
            "avg_order_value_usd": rounded_mean("value", 2),
            "total_order_value_usd": F.round(F.col("_value_sum"), 2).cast("double"),
            "orders_per_device_ratio": round_half_up(ratio, 4),
        }
    ).select(*ZONE_DAY_COLUMNS)


# The protected query as parameterised SQL, written the way the DataFrame form
# plans it: orders of known places only (semi-join), counts and exact distinct
# counts from one GROUPING SETS hash aggregate, modes from a narrow value count,
# zone attributes attached to the small result.  {orders} and {zones} are
# DataFrames handed to spark.sql as keyword arguments; :start_date, :end_date
# and :min_group_size are bound parameters (never spliced into the text).
# grouping_id bits: (k) = 3, (k, customer) = 1, (k, restaurant) = 2;
# value counts: (k, hour) = 1, (k, cuisine) = 2.
ZONE_DAY_SQL = f"""
WITH src AS (
  SELECT oe.neighbourhood, oe.city, oe.event_date, oe.order_id, oe.customer_id,
         oe.restaurant_id, oe.order_value_usd, oe.cuisine_type,
         oe.order_hour AS hr
  FROM {{orders}} oe
  LEFT SEMI JOIN {{zones}} gz
    ON oe.neighbourhood = gz.neighbourhood AND oe.city = gz.city
  WHERE oe.event_date BETWEEN :start_date AND :end_date
), level1 AS (
  SELECT neighbourhood, city, event_date, customer_id, restaurant_id,
         COUNT(order_id)                                          AS n,
         SUM(TRY_CAST(order_value_usd AS DECIMAL(38,{MONEY_SCALE})))   AS value_sum,
         COUNT(TRY_CAST(order_value_usd AS DECIMAL(38,{MONEY_SCALE}))) AS value_n,
         GROUPING_ID()                                            AS gid
  FROM src
  GROUP BY GROUPING SETS ((neighbourhood, city, event_date),
                          (neighbourhood, city, event_date, customer_id),
                          (neighbourhood, city, event_date, restaurant_id))
), counts AS (
  SELECT neighbourhood, city, event_date,
         SUM(CASE WHEN gid = 3 THEN n END)                   AS total_orders,
         COUNT(CASE WHEN gid = 1 THEN customer_id END)       AS distinct_customers,
         COUNT(CASE WHEN gid = 2 THEN restaurant_id END)     AS distinct_restaurants,
         SUM(CASE WHEN gid = 3 THEN value_sum END)           AS value_sum,
         SUM(CASE WHEN gid = 3 THEN value_n END)             AS value_n
  FROM level1
  GROUP BY neighbourhood, city, event_date
  HAVING SUM(CASE WHEN gid = 3 THEN n END) >= :min_group_size
), value_counts AS (
  SELECT neighbourhood, city, event_date, hr, cuisine_type, COUNT(*) AS n, GROUPING_ID() AS gid
  FROM src
  GROUP BY GROUPING SETS ((neighbourhood, city, event_date, hr),
                          (neighbourhood, city, event_date, cuisine_type))
), modes AS (
  SELECT neighbourhood, city, event_date,
         MIN_BY(CASE WHEN gid = 1 AND hr IS NOT NULL THEN hr END,
                CASE WHEN gid = 1 AND hr IS NOT NULL THEN named_struct('n', -n, 'v', hr) END)
           AS peak_hour,
         MIN_BY(CASE WHEN gid = 2 AND cuisine_type IS NOT NULL THEN cuisine_type END,
                CASE WHEN gid = 2 AND cuisine_type IS NOT NULL
                     THEN named_struct('n', -n, 'v', cuisine_type) END)
           AS top_cuisine
  FROM value_counts
  GROUP BY neighbourhood, city, event_date
), raw AS (
  SELECT gz.zone_id, gz.neighbourhood, gz.city, gz.state, gz.zone_type,
         gz.device_density_per_km2, gz.avg_dwell_time_min, gz.zone_area_km2,
         c.total_orders, c.distinct_customers, c.distinct_restaurants, c.value_sum,
         m.peak_hour, m.top_cuisine, c.event_date,
         TRY_DIVIDE(CAST(c.value_sum AS DOUBLE), CAST(c.value_n AS DOUBLE)) AS avg_raw,
         CAST(c.total_orders AS DOUBLE)
           / NULLIF(gz.device_density_per_km2 * gz.zone_area_km2, 0D) AS ratio_raw
  FROM counts c
  LEFT JOIN modes m
    ON c.neighbourhood <=> m.neighbourhood AND c.city <=> m.city AND c.event_date <=> m.event_date
  JOIN {{zones}} gz
    ON c.neighbourhood = gz.neighbourhood AND c.city = gz.city
)
SELECT
  zone_id, neighbourhood, city, state, zone_type,
  device_density_per_km2, avg_dwell_time_min, zone_area_km2,
  total_orders, distinct_customers, distinct_restaurants,
  CASE WHEN abs(avg_raw) < 1e20
       THEN CAST(ROUND(CAST(avg_raw AS DECIMAL(38,6)), 2) AS DOUBLE)
       ELSE ROUND(avg_raw, 2) END                             AS avg_order_value_usd,
  CAST(ROUND(value_sum, 2) AS DOUBLE)                         AS total_order_value_usd,
  peak_hour,
  top_cuisine,
  CASE WHEN abs(ratio_raw) < 1e20
       THEN CAST(ROUND(CAST(ratio_raw AS DECIMAL(38,8)), 4) AS DOUBLE)
       ELSE ROUND(ratio_raw, 4) END                           AS orders_per_device_ratio,
  event_date
FROM raw
"""


def zone_day_metrics_sql(
    spark: SparkSession,
    orders: DataFrame,
    zones: DataFrame,
    start: dt.date,
    end: dt.date,
    min_group_size: int = DEFAULT_MIN_GROUP_SIZE,
) -> DataFrame:
    """:func:`zone_day_metrics` through ``spark.sql`` with bound parameters."""
    return spark.sql(
        ZONE_DAY_SQL,
        args={"start_date": start, "end_date": end, "min_group_size": int(min_group_size)},
        orders=orders,
        zones=zones,
    )


def enrich_zones(zone_day: DataFrame, registry: DataFrame) -> DataFrame:
    """Attach registry metadata and keep zone-days meeting the zone's own threshold.

    Grain: (zone, event_date).  Inner join on zone_id: a zone missing from the
    registry has no threshold, so it cannot pass the filter anyway.  The
    threshold is text in the registry; an unparsable one drops the zone.
    Note the threshold is compared with a *daily* total.
    """
    reg = registry.select(*REGISTRY_COLUMNS)
    return attach(zone_day, reg, ["zone_id"]).where(
        F.col("total_orders") >= F.col("min_order_threshold").try_cast("int")
    )
