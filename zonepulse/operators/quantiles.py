"""Exact discrete percentiles without a single-task merge.

``percentile_disc(p)`` is the first value, in ascending order, whose cumulative share of the
non-null rows reaches ``p``: the value at 1-based rank ``max(1, ceil(p * n))``.  Spark's
aggregate keeps a map of every distinct value and merges it in one task.
:func:`distributed_percentiles` gives the same values with bounded work per task, for several
columns together:

1. one aggregate counts each column's values and sketches (fixed size) two values on either
   side of the wanted one, ``1 / buckets`` of the rows away, ten times the sketch's error;
2. rows below and above the two are only counted; between them the distinct values are counted
   (partial aggregation collapses hot values map-side);
3. a running count over these, about ``2 / buckets`` of the rows at most, finds the rank.

The counts are exact, so the result is; should the rank fall outside the two values, the query
fails instead of giving a wrong one.  Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SKETCH_ACCURACY = 10_000
BUCKETS = 1024

BELOW, BETWEEN, ABOVE = 0, 1, 2


def distributed_percentiles(df: DataFrame, wanted: dict[str, float], buckets: int = BUCKETS) -> DataFrame:
    """One row with the exact ``percentile_disc`` of each column of ``wanted`` (name ->
    percentile), under the column's name (nulls ignored; null when there is no value)."""
    accuracy = F.lit(max(SKETCH_ACCURACY, 10 * buckets))
    values = df.select(*[F.col(c).cast("double").alias(c) for c in wanted])
    bounds = []
    for i, (c, p) in enumerate(wanted.items()):
        near = F.array(F.lit(max(0.0, p - 1 / buckets)), F.lit(min(1.0, p + 1 / buckets)))
        bounds += [
            F.greatest(F.lit(1), F.ceil(F.lit(float(p)) * F.count(c))).alias(f"_target{i}"),
            F.percentile_approx(c, near, accuracy).alias(f"_near{i}"),
        ]
    # One row with two numbers a column and side: broadcasting it is bounded by construction.
    located = values.crossJoin(F.broadcast(values.agg(*bounds)))

    def place(i: int, c: str):
        value, near = F.col(c), F.col(f"_near{i}")
        side = F.when(value < near[0], BELOW).when(value > near[1], ABOVE).otherwise(BETWEEN)
        return F.struct(
            F.lit(i).alias("c"), F.col(f"_target{i}").alias("target"), side.alias("side"),
            F.when(side == BETWEEN, value).alias("v"), value.isNotNull().alias("counts"),
        )

    counted = (
        located.select(F.explode(F.array(*[place(i, c) for i, c in enumerate(wanted)])).alias("x")).select("x.*")
        .where("counts").groupBy("c", "target", "side", "v").agg(F.count(F.lit(1)).alias("n"))
    )
    running = Window.partitionBy("c", "target").orderBy("side", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = counted.withColumn("last", F.sum("n").over(running)).where(
        (F.col("last") >= F.col("target")) & (F.col("last") - F.col("n") < F.col("target"))
    )
    outside = F.raise_error(F.lit("the wanted rank lies outside its sketched bounds")).cast("double")
    found = F.when(F.col("side") == BETWEEN, F.col("v")).otherwise(outside)
    return reached.agg(*[F.min(F.when(F.col("c") == i, found)).alias(c) for i, c in enumerate(wanted)])
