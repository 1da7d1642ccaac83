"""The distributed exact percentile equals Spark's percentile_disc."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from zonepulse.operators.quantiles import distributed_percentiles
from zonepulse.operators.summary import thresholds


def _disc(df, column, pct):
    return df.agg(F.expr(f"percentile_disc({pct}) WITHIN GROUP (ORDER BY {column})").alias("v")).first().v


@pytest.mark.parametrize("n,seed", [(1, 1), (2, 2), (10, 4), (257, 5), (3000, 6)])
def test_matches_percentile_disc(spark, n, seed):
    rnd = random.Random(seed)
    hot = rnd.uniform(0, 100)

    def value():
        r = rnd.random()
        return None if r < 0.05 else hot if r < 0.4 else round(rnd.uniform(-100, 100), 1)

    df = spark.createDataFrame([(value(), value()) for _ in range(n)], "x double, y double")
    for p, q in ((0.0, 1.0), (0.5, 0.25), (0.75, 0.9)):
        for buckets in (2, 64):
            got = distributed_percentiles(df, {"x": p, "y": q}, buckets=buckets).first()
            assert (got.x, got.y) == (_disc(df, "x", p), _disc(df, "y", q)), (n, p, q, buckets)


def test_empty_and_all_null(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "x double, y double")
    assert tuple(distributed_percentiles(df, {"x": 0.5, "y": 0.5}).first()) == (None, 1.0)
    assert tuple(distributed_percentiles(df.limit(0), {"x": 0.5, "y": 0.5}).first()) == (None, None)


def test_thresholds(spark):
    df = spark.createDataFrame([(float(v), v / 100.0) for v in range(1, 11)],
                               "device_density_per_km2 double, orders_per_device_ratio double")
    exact, sketch = thresholds(df).first(), thresholds(df, approx=True).first()
    assert tuple(exact) == tuple(sketch) == (8.0, 0.05)
