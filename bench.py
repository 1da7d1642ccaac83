"""Benchmark: every named query on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is built and fully executed (noop sink, all rows and columns
computed); one warm-up round, then the median of $BENCH_RUNS rounds.  Prints
one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from zonepulse.plans.catalog import QUERIES  # noqa: E402
from zonepulse.session import tuned_builder  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark: SparkSession = tuned_builder(f"local[{cpus}]", cpus, scratch).config("spark.driver.memory", "16g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    names = [q for q in QUERIES if not only or q in only]

    def run_once(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    errors: dict[str, str] = {}

    def attempt(name: str) -> float | None:
        if name in errors:
            return None
        try:
            return run_once(name)
        except Exception as exc:  # keep measuring the others; report the failure
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
            return None

    for name in names:  # warm-up: JIT, file listing caches
        attempt(name)
    times: dict[str, list[float]] = {n: [] for n in names}
    for _ in range(runs):
        for name in names:
            t = attempt(name)
            if t is not None:
                times[name].append(t)
    med = {n: (round(statistics.median(v), 3) if v and n not in errors else None) for n, v in times.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(v for v in med.values() if v is not None), 3),
        "unit": "sec",
        "queries": med,
        "sf": sf,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
