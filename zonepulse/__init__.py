"""zonepulse — privacy-aware zone demand analytics on Spark DataFrames.

Row-level order events are cleaned into date-partitioned Parquet, joined to
a zone dimension and aggregated to zone x day metrics that are released only
above a minimum group size.  From those come an hour-by-weekday demand grid
with per-city ranks, a zone summary with quantile-based underserved flags and
ranked zone reports.  Every step is a lazy DataFrame transformation built
from Spark's own expressions; actions happen at sinks only.
"""

from zonepulse.config import RunConfig
from zonepulse.operators.ingest import clean_orders, day_spine, missing_days
from zonepulse.operators.zones import enrich_zones, zone_day_metrics, zone_day_metrics_sql
from zonepulse.operators.grid import hourly_demand_grid
from zonepulse.operators.profile import group_profile
from zonepulse.operators.quantiles import distributed_percentiles
from zonepulse.operators.summary import (
    hotspot_report,
    run_metrics,
    thresholds,
    underserved_report,
    zone_summary,
)
from zonepulse.plans.run import RunPaths, run_window

__all__ = [
    "RunConfig",
    "clean_orders",
    "day_spine",
    "missing_days",
    "zone_day_metrics",
    "zone_day_metrics_sql",
    "enrich_zones",
    "hourly_demand_grid",
    "thresholds",
    "zone_summary",
    "underserved_report",
    "hotspot_report",
    "run_metrics",
    "group_profile",
    "distributed_percentiles",
    "RunPaths",
    "run_window",
]
