"""Ingest: clean raw order events; find the days that still need staging."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from zonepulse.functions.exprs import coerce
from zonepulse.sources.schemas import ORDER_COLUMNS

DEDUP_KEYS = ["order_id", "event_date"]

# An order value must be finite, positive and below this bound: sums of 10**13 such values
# still fit the decimals in which they are added.
MAX_ORDER_VALUE = 1e18


def _typed(raw: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    src_types = {f.name: f.dataType for f in raw.schema.fields}
    return raw.select(*[coerce(name, src_types[name], t).alias(name) for name, t in ORDER_COLUMNS], *also)


def _valid_value():
    # NaN compares as the largest value, so the upper bound drops it together with Infinity.
    return (F.col("order_value_usd") > 0) & (F.col("order_value_usd") < F.lit(MAX_ORDER_VALUE))


def latest(orders: DataFrame, keys: list[str]) -> DataFrame:
    """One row per ``keys``: the one with the latest ``order_timestamp``; remaining ties are
    broken on the other columns, so the result does not depend on row order.

    An aggregate (``max`` of a struct), not a window: partial aggregation collapses copies
    map-side, so a key that holds a large share of the rows still ships one row per map task.
    """
    rest = [name for name, _ in ORDER_COLUMNS if name not in DEDUP_KEYS]
    chosen = orders.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
    return chosen.select(*keys, *[F.col(f"_row.{n}").alias(n) for n in rest])


def clean_orders(raw: DataFrame, also: tuple[str, ...] = (), counters: Observation | None = None) -> DataFrame:
    """Project and type the 13 order columns, drop corrupt rows, deduplicate.

    Grain of the output: one row per (order_id, event_date) and the columns of ``also``,
    which are kept as they are.

    * Casts of outside text use ``try_cast``; a malformed value becomes null.
    * ``0 < order_value_usd < MAX_ORDER_VALUE`` runs *before* the dedup (it also drops nulls,
      NaN and infinities), so a corrupt re-delivery can never hide a valid order.
    * Of the rows of one key the latest stays, see :func:`latest`.
    * ``order_hour`` = hour of the timestamp, ``day_of_week`` 1 = Sunday .. 7.

    ``counters`` gets the counts of :func:`rejected_orders` from the same pass over the rows.
    """
    typed = _typed(raw, also)
    if counters is not None:
        typed = typed.observe(counters, *_reject_counts())
    kept = latest(typed.where(_valid_value()), [*DEDUP_KEYS, *also])
    return with_derived(kept, also)


def with_derived(orders: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """The order columns in their order, and the hour and weekday of the timestamp."""
    return orders.select(
        *[n for n, _ in ORDER_COLUMNS],
        F.hour("order_timestamp").alias("order_hour"),
        F.dayofweek("order_timestamp").alias("day_of_week"),
        *also,
    )


def _reject_counts() -> list[Column]:
    value = F.col("order_value_usd")
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(value.isNull()).alias("no_value"),
        F.count_if(value <= 0).alias("not_positive"),
        F.count_if(value >= F.lit(MAX_ORDER_VALUE)).alias("not_finite_or_too_large"),
        F.count_if(_valid_value() & F.col("event_date").isNull()).alias("undated"),
    ]


def rejected_orders(raw: DataFrame) -> DataFrame:
    """One row: how many raw rows ``clean_orders`` drops for their value, by reason, and how
    many valid ones have no date."""
    return _typed(raw).agg(*_reject_counts())


def day_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive; empty if start > end."""
    s, e = F.lit(start), F.lit(end)
    days = F.when(s <= e, F.sequence(s, e, F.expr("INTERVAL 1 DAY"))).otherwise(
        F.array().cast("array<date>")
    )
    return spark.range(1).select(F.explode(days).alias("event_date"))


def missing_days(spine: DataFrame, staged: DataFrame) -> DataFrame:
    """Days of ``spine`` that have no row in ``staged`` (a left-anti join on event_date).

    ``staged`` is any frame with an ``event_date`` column, typically the interim
    Parquet root, where only the partition column is read.
    """
    present = staged.select("event_date").distinct()
    return spine.join(present, "event_date", "left_anti")
