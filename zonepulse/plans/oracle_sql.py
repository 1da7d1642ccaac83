"""Independent SQL statements of every named query, for DuckDB.

They run on the driver's tables (views ``events customer nation region``) and
restate the semantics from scratch: adapters, cleaning (row_number dedup),
suppression, modes (count per value, highest count then lowest value),
discrete percentiles.  Dialect notes: DuckDB's dayofweek is 0-based, hour and
rank are BIGINT, sums of BIGINT are HUGEINT; all are cast to Spark's types.
Rounding goes through decimals exactly as in :mod:`zonepulse.functions.exprs`.
"""

from __future__ import annotations

from zonepulse.config import FIXTURE_SPINE, RunConfig, fixture_config

_ORDER_COLS = (
    "order_id, event_date, order_timestamp, customer_id, restaurant_id, cuisine_type, "
    "pickup_lat, pickup_lon, delivery_lat, delivery_lon, order_value_usd, city, neighbourhood"
)
_TIEBREAK = [
    "order_timestamp", "customer_id", "restaurant_id", "cuisine_type", "pickup_lat",
    "pickup_lon", "delivery_lat", "delivery_lon", "order_value_usd", "city", "neighbourhood",
]
_REPORT_ATTRS = (
    "zone_id, neighbourhood, city, state, zone_type, study_id, campaign_id, "
    "device_density_per_km2, zone_area_km2"
)


def r2(x: str) -> str:
    return f"CAST(ROUND(CAST(({x}) AS DECIMAL(38,6)), 2) AS DOUBLE)"


def r4(x: str) -> str:
    return f"CAST(ROUND(CAST(({x}) AS DECIMAL(38,8)), 4) AS DOUBLE)"


def avg_money(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(38,6))) AS DOUBLE) / COUNT({c})"


def avg_ratio(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(38,8))) AS DOUBLE) / COUNT({c})"


def _mode(src: str, keys: str, value: str, alias: str) -> str:
    """Per ``keys``: the value with the highest count, ties -> lowest value."""
    return (
        f"SELECT {keys}, first({value} ORDER BY n DESC, {value} ASC) AS {alias} "
        f"FROM (SELECT {keys}, {value}, COUNT(*) AS n FROM {src} "
        f"WHERE {value} IS NOT NULL GROUP BY {keys}, {value}) GROUP BY {keys}"
    )


def order_events_cte() -> str:
    jit = lambda steps: f"CAST(n.n_nationkey AS DOUBLE) + CAST(e.event_id % {steps} AS DOUBLE) / {steps}"
    return f"""order_events AS (
  SELECT CAST(e.event_id AS VARCHAR) AS order_id,
         CAST(e.ts AS DATE) AS event_date,
         e.ts AS order_timestamp,
         CAST(e.user_id AS VARCHAR) AS customer_id,
         json_extract_string(e.props, '$.k') AS restaurant_id,
         e.event_type AS cuisine_type,
         {jit(64)} AS pickup_lat,
         {jit(32)} AS pickup_lon,
         {jit(16)} AS delivery_lat,
         {jit(8)} AS delivery_lon,
         CAST(e.value AS DOUBLE) AS order_value_usd,
         r.r_name AS city,
         n.n_name AS neighbourhood
  FROM events e
  JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def dirty_cte() -> str:
    oid = "CAST(order_id AS BIGINT)"
    return f"""dirty_base AS (
  SELECT * REPLACE (CASE WHEN {oid} % 13 = 0 THEN CAST(NULL AS DOUBLE)
                         WHEN {oid} % 11 = 0 THEN -order_value_usd
                         ELSE order_value_usd END AS order_value_usd)
  FROM order_events),
dirty_sent AS (
  SELECT * FROM dirty_base
  UNION ALL SELECT * FROM dirty_base WHERE {oid} % 7 = 0
  UNION ALL SELECT * REPLACE (order_timestamp + INTERVAL 1 SECOND AS order_timestamp,
                              order_value_usd + 1.0 AS order_value_usd)
            FROM dirty_base WHERE {oid} % 5 = 0),
dirty_text AS (
  SELECT CASE WHEN {oid} % 37 = 0 THEN NULL ELSE order_id END AS order_id,
         CASE WHEN {oid} % 41 = 0 THEN '2024-13-45' ELSE CAST(event_date AS VARCHAR) END AS event_date,
         CASE WHEN {oid} % 17 = 0 THEN 'not a time' ELSE CAST(order_timestamp AS VARCHAR) END AS order_timestamp,
         CASE WHEN {oid} % 31 = 0 THEN NULL ELSE customer_id END AS customer_id,
         restaurant_id, cuisine_type, pickup_lat, pickup_lon, delivery_lat, delivery_lon,
         CASE WHEN {oid} % 43 = 0 THEN 'n/a' WHEN {oid} % 19 = 0 THEN 'NaN'
              WHEN {oid} % 23 = 0 THEN 'Infinity' WHEN {oid} % 29 = 0 THEN '1e40'
              ELSE CAST(order_value_usd AS VARCHAR) END AS order_value_usd,
         city, neighbourhood
  FROM dirty_sent),
dirty AS (
  SELECT * REPLACE (TRY_CAST(event_date AS DATE) AS event_date,
                    TRY_CAST(order_timestamp AS TIMESTAMP) AS order_timestamp,
                    TRY_CAST(order_value_usd AS DOUBLE) AS order_value_usd)
  FROM dirty_text)"""


def clean_cte(src: str, name: str = "clean") -> str:
    order = ", ".join(f"{c} DESC NULLS LAST" for c in _TIEBREAK)
    return f"""{name} AS (
  SELECT {_ORDER_COLS},
         CAST(hour(order_timestamp) AS INTEGER) AS order_hour,
         CAST(dayofweek(order_timestamp) + 1 AS INTEGER) AS day_of_week
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id, event_date ORDER BY {order}) AS rn
        FROM {src} WHERE order_value_usd > 0 AND order_value_usd < 1e18)
  WHERE rn = 1)"""


def _zone_rows(z: int) -> str:
    return f"'ZONE_' || lpad(CAST(n.n_nationkey + {1 + 1000 * z} AS VARCHAR), 4, '0') AS zone_id"


def zones_cte() -> str:
    def part(z: int) -> str:
        return f"""SELECT {_zone_rows(z)},
         n.n_name AS neighbourhood,
         r.r_name AS city,
         substring(r.r_name, 1, 2) AS state,
         CASE n.n_nationkey % 5 WHEN 0 THEN 'riverside' WHEN 1 THEN 'old_town'
              WHEN 2 THEN 'market' WHEN 3 THEN 'campus' ELSE 'station' END AS zone_type,
         CAST(n.n_nationkey AS DOUBLE) AS centre_lat,
         CAST(n.n_regionkey AS DOUBLE) AS centre_lon,
         CAST(COALESCE(cc.n_customers, 0) * {10 + 5 * z} AS DOUBLE) AS device_density_per_km2,
         CAST(n.n_nationkey * 3 + {10 + z} AS DOUBLE) AS avg_dwell_time_min,
         CASE WHEN n.n_nationkey = 7 THEN 0.0::DOUBLE
              ELSE CAST(n.n_nationkey % 8 AS DOUBLE) * 0.5 + {0.5 + 0.5 * z} END AS zone_area_km2
  FROM nation n
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT c_nationkey, COUNT(*) AS n_customers FROM customer GROUP BY c_nationkey) cc
    ON cc.c_nationkey = n.n_nationkey
  WHERE {z} = 0 OR n.n_nationkey % 4 = 0"""

    return f"zones AS (\n  {part(0)}\n  UNION ALL\n  {part(1)})"


def registry_cte(k: int) -> str:
    def part(z: int) -> str:
        return f"""SELECT {_zone_rows(z)},
         'STUDY_' || CAST(n.n_regionkey + 100 AS VARCHAR) AS study_id,
         'CAMP_' || CAST(n.n_nationkey % 7 + 1000 AS VARCHAR) AS campaign_id,
         r.r_name AS target_city,
         CASE WHEN n.n_nationkey = 9 THEN 'unknown'
              ELSE CAST(n.n_nationkey % 5 + {int(k) + 4 * z} AS VARCHAR) END AS min_order_threshold,
         CAST(NULL AS VARCHAR) AS ext1,
         CAST(NULL AS VARCHAR) AS ext2
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE n.n_nationkey % 6 <> 5 AND ({z} = 0 OR n.n_nationkey % 4 = 0)"""

    return f"registry AS (\n  {part(0)}\n  UNION ALL\n  {part(1)})"


def _window(cfg: RunConfig) -> str:
    return f"DATE '{cfg.start.isoformat()}' AND DATE '{cfg.end.isoformat()}'"


def zone_day_ctes(cfg: RunConfig) -> str:
    attrs = ("zone_id, neighbourhood, city, state, zone_type, device_density_per_km2, "
             "avg_dwell_time_min, zone_area_km2")
    return f"""zd_join AS (
  SELECT z.zone_id, z.neighbourhood, z.city, z.state, z.zone_type, z.device_density_per_km2,
         z.avg_dwell_time_min, z.zone_area_km2, o.event_date, o.order_id, o.customer_id,
         o.restaurant_id, o.order_value_usd, o.cuisine_type,
         CAST(hour(o.order_timestamp) AS INTEGER) AS hr
  FROM clean o JOIN zones z ON o.neighbourhood = z.neighbourhood AND o.city = z.city
  WHERE o.event_date BETWEEN {_window(cfg)}),
zd_agg AS (
  SELECT {attrs}, event_date,
         COUNT(order_id) AS total_orders,
         COUNT(DISTINCT customer_id) AS distinct_customers,
         COUNT(DISTINCT restaurant_id) AS distinct_restaurants,
         {r2(avg_money("order_value_usd"))} AS avg_order_value_usd,
         CAST(ROUND(SUM(CAST(order_value_usd AS DECIMAL(38,6))), 2) AS DOUBLE) AS total_order_value_usd
  FROM zd_join
  GROUP BY {attrs}, event_date
  HAVING COUNT(order_id) >= {int(cfg.min_group_size)}),
zd_hour AS ({_mode("zd_join", "zone_id, event_date", "hr", "peak_hour")}),
zd_cuisine AS ({_mode("zd_join", "zone_id, event_date", "cuisine_type", "top_cuisine")}),
zone_day AS (
  SELECT a.zone_id, a.neighbourhood, a.city, a.state, a.zone_type, a.device_density_per_km2,
         a.avg_dwell_time_min, a.zone_area_km2, a.total_orders, a.distinct_customers,
         a.distinct_restaurants, a.avg_order_value_usd, a.total_order_value_usd,
         h.peak_hour, c.top_cuisine,
         {r4("CAST(a.total_orders AS DOUBLE) / NULLIF(a.device_density_per_km2 * a.zone_area_km2, 0)")}
           AS orders_per_device_ratio,
         a.event_date
  FROM zd_agg a
  LEFT JOIN zd_hour h ON a.zone_id = h.zone_id AND a.event_date = h.event_date
  LEFT JOIN zd_cuisine c ON a.zone_id = c.zone_id AND a.event_date = c.event_date),
enriched AS (
  SELECT zd.*, rg.study_id, rg.campaign_id, rg.target_city, rg.min_order_threshold, rg.ext1, rg.ext2
  FROM zone_day zd JOIN registry rg ON zd.zone_id = rg.zone_id
  WHERE zd.total_orders >= TRY_CAST(rg.min_order_threshold AS INTEGER))"""


def _base(cfg: RunConfig) -> str:
    return ",\n".join(
        [order_events_cte(), clean_cte("order_events"), zones_cte(), registry_cte(cfg.min_group_size),
         zone_day_ctes(cfg)]
    )


def thresholds_cte(cfg: RunConfig) -> str:
    return f"""limits AS (
  SELECT quantile_disc(device_density_per_km2, {cfg.density_pct}) AS density_threshold,
         quantile_disc(orders_per_device_ratio, {cfg.ratio_pct}) AS ratio_median
  FROM enriched)"""


def summary_ctes(cfg: RunConfig) -> str:
    return f"""{thresholds_cte(cfg)},
s_daily AS (
  SELECT {_REPORT_ATTRS},
         CAST(SUM(total_orders) AS BIGINT) AS total_orders,
         CAST(SUM(distinct_customers) AS BIGINT) AS customer_days,
         {r2(avg_money("avg_order_value_usd"))} AS avg_daily_order_value_usd,
         {r4(avg_ratio("orders_per_device_ratio"))} AS orders_per_device_ratio
  FROM enriched GROUP BY {_REPORT_ATTRS}),
s_orders AS (
  SELECT d.zone_id, o.customer_id, o.order_value_usd, o.order_hour, o.cuisine_type
  FROM clean o
  JOIN (SELECT DISTINCT zone_id, neighbourhood, city, event_date FROM enriched) d
    ON o.neighbourhood = d.neighbourhood AND o.city = d.city AND o.event_date = d.event_date
  WHERE o.event_date BETWEEN {_window(cfg)}),
s_zone AS (
  SELECT zone_id, COUNT(DISTINCT customer_id) AS total_customers,
         {r2(avg_money("order_value_usd"))} AS avg_order_value_usd
  FROM s_orders GROUP BY zone_id),
s_hour AS ({_mode("s_orders", "zone_id", "order_hour", "peak_hour")}),
s_cuisine AS ({_mode("s_orders", "zone_id", "cuisine_type", "top_cuisine")}),
summary AS (
  SELECT d.zone_id, d.neighbourhood, d.city, d.state, d.zone_type, d.study_id, d.campaign_id,
         d.device_density_per_km2, d.zone_area_km2, d.total_orders, z.avg_order_value_usd,
         z.total_customers, d.orders_per_device_ratio, h.peak_hour, c.top_cuisine,
         COALESCE(d.device_density_per_km2 >= t.density_threshold
                  AND d.orders_per_device_ratio < t.ratio_median, false) AS is_underserved,
         '{cfg.start.isoformat()}' AS window_start,
         '{cfg.end.isoformat()}' AS window_end,
         d.customer_days, d.avg_daily_order_value_usd
  FROM s_daily d
  LEFT JOIN s_zone z ON d.zone_id = z.zone_id
  LEFT JOIN s_hour h ON d.zone_id = h.zone_id
  LEFT JOIN s_cuisine c ON d.zone_id = c.zone_id
  CROSS JOIN limits t)"""


def build(cfg: RunConfig) -> dict[str, str]:
    base = _base(cfg)
    with_summary = f"{base},\n{summary_ctes(cfg)}"
    spine_lo, spine_hi = FIXTURE_SPINE
    zd_cols = ("zone_id, neighbourhood, city, state, zone_type, device_density_per_km2, "
               "avg_dwell_time_min, zone_area_km2, total_orders, distinct_customers, "
               "distinct_restaurants, avg_order_value_usd, total_order_value_usd, peak_hour, "
               "top_cuisine, orders_per_device_ratio, event_date")
    zone_day_sql = f"WITH {base}\nSELECT {zd_cols} FROM zone_day"
    grid_sql = f"""WITH {base},
ez AS (SELECT DISTINCT {_REPORT_ATTRS} FROM enriched),
g AS (
  SELECT ez.*, o.order_id, o.order_value_usd, o.customer_id, o.restaurant_id, o.cuisine_type,
         o.order_hour, o.day_of_week
  FROM clean o JOIN ez ON o.neighbourhood = ez.neighbourhood AND o.city = ez.city
  WHERE o.event_date BETWEEN {_window(cfg)}),
g_agg AS (
  SELECT {_REPORT_ATTRS}, order_hour, day_of_week,
         COUNT(order_id) AS order_count,
         {r2(avg_money("order_value_usd"))} AS avg_order_value_usd,
         COUNT(DISTINCT customer_id) AS distinct_customers,
         COUNT(DISTINCT restaurant_id) AS distinct_restaurants
  FROM g GROUP BY {_REPORT_ATTRS}, order_hour, day_of_week
  HAVING COUNT(order_id) >= {int(cfg.min_cell_size)}),
g_cuisine AS ({_mode("g", "zone_id, order_hour, day_of_week", "cuisine_type", "top_cuisine")})
SELECT a.zone_id, a.neighbourhood, a.city, a.state, a.zone_type, a.study_id, a.campaign_id,
       a.device_density_per_km2, a.zone_area_km2, a.order_hour, a.day_of_week, a.order_count,
       a.avg_order_value_usd, a.distinct_customers, a.distinct_restaurants, c.top_cuisine,
       CAST(rank() OVER (PARTITION BY a.city ORDER BY a.order_count DESC) AS INTEGER) AS city_rank
FROM g_agg a
LEFT JOIN g_cuisine c ON a.zone_id = c.zone_id
  AND a.order_hour IS NOT DISTINCT FROM c.order_hour
  AND a.day_of_week IS NOT DISTINCT FROM c.day_of_week"""
    return {
        "clean_orders": f"WITH {order_events_cte()},\n{dirty_cte()},\n{clean_cte('dirty')}\nSELECT * FROM clean",
        "missing_days": f"""WITH {order_events_cte()},
spine AS (
  SELECT CAST(d AS DATE) AS event_date
  FROM generate_series(DATE '{spine_lo.isoformat()}', DATE '{spine_hi.isoformat()}', INTERVAL 1 DAY) g(d))
SELECT s.event_date FROM spine s
WHERE NOT EXISTS (SELECT 1 FROM order_events o WHERE o.event_date = s.event_date)""",
        "zone_day_metrics": zone_day_sql,
        "zone_day_metrics_sql": zone_day_sql,
        "enrich_zones": f"WITH {base}\nSELECT {zd_cols}, study_id, campaign_id, target_city, "
                        "min_order_threshold, ext1, ext2 FROM enriched",
        "hourly_demand_grid": grid_sql,
        "thresholds": f"WITH {base},\n{thresholds_cte(cfg)}\nSELECT density_threshold, ratio_median FROM limits",
        "zone_summary": f"WITH {with_summary}\nSELECT * FROM summary",
        "underserved_report": f"WITH {with_summary}\nSELECT * FROM summary WHERE is_underserved",
        "hotspot_report": f"""WITH {with_summary}
SELECT city, zone_rank, zone_id, neighbourhood, total_orders, avg_order_value_usd, peak_hour, top_cuisine
FROM (SELECT *, CAST(rank() OVER (PARTITION BY city ORDER BY total_orders DESC) AS INTEGER) AS zone_rank
      FROM summary)
WHERE zone_rank <= {int(cfg.top_n)}""",
        "run_metrics": f"""WITH {with_summary}
SELECT (SELECT COUNT(*) FROM enriched) AS enriched_zone_days,
       COUNT(*) AS summary_zones,
       CAST(COUNT(*) FILTER (WHERE is_underserved) AS BIGINT) AS underserved_zones
FROM summary""",
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for every named query; the same text at every scale."""
    return build(fixture_config())
