"""Zone summary over the run window, underserved flags and ranked reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonepulse.config import DEFAULT_DENSITY_PCT, DEFAULT_RATIO_PCT
from zonepulse.functions.exprs import MONEY_SCALE, RATIO_SCALE, exact_avg, round_half_up, rounded_mean
from zonepulse.operators.profile import group_profile
from zonepulse.operators.quantiles import distributed_percentiles
from zonepulse.sources.schemas import REPORT_ZONE_ATTRS

SUMMARY_COLUMNS = REPORT_ZONE_ATTRS + [
    "total_orders",
    "avg_order_value_usd",
    "total_customers",
    "orders_per_device_ratio",
    "peak_hour",
    "top_cuisine",
    "is_underserved",
    "window_start",
    "window_end",
    "customer_days",
    "avg_daily_order_value_usd",
]


def summary_order():
    """Sink order of the summary: most orders first, zone_id breaks ties."""
    return [F.desc("total_orders"), F.asc("zone_id")]


def underserved_flag(density_threshold, ratio_threshold):
    """density >= density_threshold AND ratio < ratio_threshold; unknown -> false.

    NaN compares as the largest value in Spark, so a NaN density counts as high.
    """
    flag = (F.col("device_density_per_km2") >= density_threshold) & (
        F.col("orders_per_device_ratio") < ratio_threshold
    )
    return F.coalesce(flag, F.lit(False))


def thresholds(
    enriched: DataFrame,
    density_pct: float = DEFAULT_DENSITY_PCT,
    ratio_pct: float = DEFAULT_RATIO_PCT,
    approx: bool = False,
) -> DataFrame:
    """One row: density_threshold, ratio_median over the enriched zone-day rows.

    Exact discrete percentiles by default (the first value whose cumulative share reaches
    the percentile; nulls ignored; no rows -> nulls), by one distributed plan for both
    columns at every size, see :func:`distributed_percentiles`.  ``approx=True`` uses a
    fixed-size sketch.
    """
    wanted = {"device_density_per_km2": density_pct, "orders_per_device_ratio": ratio_pct}
    if approx:
        # Bounded-memory sketch; relative rank error 1 / 10000.
        found = enriched.agg(
            *[F.percentile_approx(c, F.lit(p), F.lit(10_000)).cast("double").alias(c) for c, p in wanted.items()]
        )
    else:
        found = distributed_percentiles(enriched, wanted)
    return found.select(
        F.col("device_density_per_km2").alias("density_threshold"), F.col("orders_per_device_ratio").alias("ratio_median")
    )


def zone_summary(
    orders: DataFrame,
    enriched: DataFrame,
    start: dt.date,
    end: dt.date,
    density_pct: float = DEFAULT_DENSITY_PCT,
    ratio_pct: float = DEFAULT_RATIO_PCT,
    approx_quantiles: bool = False,
    approx_distinct: bool = False,
) -> DataFrame:
    """One row per released zone over the window, with the underserved flag.

    From the released zone-days:
      total_orders             sum of daily totals
      customer_days            sum of daily distinct customers
      avg_daily_order_value_usd  mean of the daily means (2 dp)
      orders_per_device_ratio  mean of the daily ratios (4 dp)
    From the orders of the released zone-days (joined on place and day, profiled by zone):
      total_customers          distinct customers over the window
      avg_order_value_usd      mean order value over the window (2 dp)
      peak_hour, top_cuisine   mode over the window, ties -> lowest
    is_underserved = density >= p(density_pct) and ratio < p(ratio_pct), the
    percentiles taken over the zone-day rows; unknown -> false.
    window_start / window_end are the window bounds as text.
    """
    daily = enriched.groupBy(*REPORT_ZONE_ATTRS).agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("distinct_customers").alias("customer_days"),
        round_half_up(exact_avg("avg_order_value_usd", MONEY_SCALE), 2).alias("avg_daily_order_value_usd"),
        round_half_up(exact_avg("orders_per_device_ratio", RATIO_SCALE), 4).alias("orders_per_device_ratio"),
    )

    # Zones of one place may be released on different days, so orders are profiled by zone.
    place_day = ["neighbourhood", "city", "event_date"]
    released_days = enriched.select("zone_id", *place_day)
    window = orders.select(
        "order_id", "event_date", "neighbourhood", "city", "customer_id", "order_value_usd",
        "order_hour", "cuisine_type",
    ).where(F.col("event_date").between(F.lit(start), F.lit(end)))
    per_zone = group_profile(
        window.join(released_days, place_day, "inner"),
        ["zone_id"],
        count_col="order_id",
        value_col="order_value_usd",
        distinct={"total_customers": "customer_id"},
        modes={"peak_hour": "order_hour", "top_cuisine": "cuisine_type"},
        approx_distinct=approx_distinct,
    ).select("zone_id", "total_customers", rounded_mean("value", 2).alias("avg_order_value_usd"), "peak_hour", "top_cuisine")

    # Exactly one row, so broadcasting it is bounded by construction.
    limits = F.broadcast(thresholds(enriched, density_pct, ratio_pct, approx_quantiles))
    return (
        daily.join(per_zone, "zone_id", "left")
        .crossJoin(limits)
        .withColumns(
            {
                "is_underserved": underserved_flag(F.col("density_threshold"), F.col("ratio_median")),
                "window_start": F.lit(start.isoformat()),
                "window_end": F.lit(end.isoformat()),
            }
        )
        .select(*SUMMARY_COLUMNS)
    )


def underserved_report(summary: DataFrame) -> DataFrame:
    """Zones flagged as underserved (high device density, low order coverage)."""
    return summary.where(F.col("is_underserved"))


HOTSPOT_COLUMNS = [
    "city",
    "zone_rank",
    "zone_id",
    "neighbourhood",
    "total_orders",
    "avg_order_value_usd",
    "peak_hour",
    "top_cuisine",
]


def hotspot_report(summary: DataFrame, top_n: int = 3) -> DataFrame:
    """Top ``top_n`` zones per city by total orders (rank with shared ties),
    with their average order value, peak hour and top cuisine."""
    by_city = Window.partitionBy("city").orderBy(F.desc("total_orders"))
    return (
        summary.withColumn("zone_rank", F.rank().over(by_city))
        .where(F.col("zone_rank") <= F.lit(top_n))
        .select(*HOTSPOT_COLUMNS)
    )


def run_metrics(enriched: DataFrame, summary: DataFrame) -> DataFrame:
    """One row of run counters: enriched zone-days, summarised zones, flagged zones.

    Two one-row aggregates instead of separate count() jobs.
    """
    e = enriched.agg(F.count(F.lit(1)).alias("enriched_zone_days"))
    s = summary.agg(
        F.count(F.lit(1)).alias("summary_zones"),
        F.count_if(F.col("is_underserved")).alias("underserved_zones"),
    )
    return e.crossJoin(s)
