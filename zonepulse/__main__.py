"""``python -m zonepulse``: one run window from the command line."""

from __future__ import annotations

import argparse
import datetime as dt

from zonepulse.config import RunConfig
from zonepulse.plans.run import RunPaths, run_window
from zonepulse.session import tuned_builder


def main() -> None:
    p = argparse.ArgumentParser(prog="zonepulse", description="Runs one window; the default is the weekly one.")
    p.add_argument("--start", type=dt.date.fromisoformat)
    p.add_argument("--end", type=dt.date.fromisoformat)
    p.add_argument("--min-group-size", type=int)
    p.add_argument("--orders", required=True, help="folder of orders_YYYY-MM-DD.csv")
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--zones", help="zone table CSV")
    source.add_argument("--zone-day", help="zone x day aggregate CSV delivered by another party")
    p.add_argument("--registry", required=True, help="zone registry CSV")
    p.add_argument("--interim", required=True, help="root of the cleaned orders")
    p.add_argument("--output", required=True, help="root of all deliverables")
    p.add_argument("--allow-missing-days", action="store_true")
    p.add_argument("--restage", type=dt.date.fromisoformat, nargs="*", default=[], help="days to load again")
    a = p.parse_args()
    if (a.start is None) != (a.end is None):
        p.error("--start and --end go together")
    chosen = {} if a.min_group_size is None else {"min_group_size": a.min_group_size}
    cfg = RunConfig(a.start, a.end, **chosen) if a.start else RunConfig.default_window(**chosen)
    paths = RunPaths(a.orders, a.zones, a.registry, a.interim, a.output, a.zone_day)
    spark = tuned_builder().getOrCreate()
    try:
        result = run_window(spark, cfg, paths, a.allow_missing_days, a.restage)
        print({k: v for k, v in vars(result).items()})
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
