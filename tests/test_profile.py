"""group_profile must equal Spark's own count / count(DISTINCT) / mode on any input."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from zonepulse.functions.exprs import exact_sum
from zonepulse.operators.profile import group_profile


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_builtin_aggregates(spark, seed):
    rnd = random.Random(seed)
    def maybe(v):
        return None if rnd.random() < 0.1 else v
    rows = [
        (maybe(rnd.choice("ab")), rnd.randint(0, 2), maybe(f"o{i}"), maybe(rnd.choice(["x", "y", "z"])),
         maybe(rnd.randint(0, 5)), maybe(rnd.choice(["p", "q", "r", "s"])), maybe(round(rnd.uniform(-5, 50), 2)))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "k1 string, k2 int, oid string, cust string, hour int, cat string, v double")
    keys = ["k1", "k2"]
    got = group_profile(df, keys, "oid", "v", {"dc": "cust"}, {"mh": "hour", "mc": "cat"})
    want = df.groupBy(*keys).agg(
        F.count("oid").alias("_n"), exact_sum("v").alias("_value_sum"), F.count("v").alias("_value_n"),
        F.count_distinct("cust").alias("dc"), F.mode("hour", True).alias("mh"), F.mode("cat", True).alias("mc"),
    )
    cols = keys + ["_n", "_value_sum", "_value_n", "dc", "mh", "mc"]
    norm = lambda d: sorted((tuple(repr(x) for x in r) for r in d.select(*cols).collect()))
    assert norm(got) == norm(want)


def test_approx_distinct_path(spark):
    df = spark.createDataFrame([("a", f"c{i % 37}", "x") for i in range(500)], "k string, cust string, cat string")
    row = group_profile(df, ["k"], "cust", None, {"dc": "cust"}, {"mc": "cat"}, approx_distinct=True).first()
    assert row._n == 500 and abs(row.dc - 37) <= 2 and row.mc == "x"
    row = group_profile(df, ["k"], "cust", None, {"dc": "cust"}, approx_distinct=True).first()
    assert abs(row.dc - 37) <= 2
