"""Adapters from the driver's star-schema tables to the engine's three inputs.

The driver ships no order or zone table; ``events`` is the closest order feed.
Each adapter is a projection and a join over whole tables, so its cost grows
with the data it maps:

* order events   = events ⨝ customer ⨝ nation ⨝ region
* zone dimension = one zone per nation, two in some, density from the customers per nation
* zone registry  = one entry per zone, some left out, thresholds around k

The derivation rules below are the fixed values every oracle query repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.config import FIXTURE_WINDOW

# Zone types by n_nationkey % 5, in this order.
ZONE_TYPES = ["riverside", "old_town", "market", "campus", "station"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation ⨝ region: neighbourhood = nation name, city = region name."""
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "inner").drop("r_regionkey")


def _jitter(nationkey: Column, event_id: Column, steps: int) -> Column:
    # Powers of two, so the value is exact in every engine.
    return nationkey.cast("double") + (event_id % steps).cast("double") / steps


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events with the 13 typed columns of the order feed."""
    ev = _table(spark, sf_dir, "events")
    cust = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # Join sizes are left to Spark's statistics: the geography is a handful of
    # rows (broadcast), customer is broadcast only while its files are small and
    # shuffle-joined beyond that; AQE splits a hot user_id partition.
    src = ev.join(cust, ev.user_id == cust.c_custkey, "inner").join(
        _geography(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "inner"
    )
    nk, eid = F.col("n_nationkey"), F.col("event_id")
    day = F.col("ts").cast("date")
    outside = F.raise_error(F.lit("an event lies outside the fixture window"))
    in_window = day.isNull() | day.between(*[F.lit(d) for d in FIXTURE_WINDOW])
    return src.select(
        eid.cast("string").alias("order_id"),
        F.when(in_window, day).otherwise(outside.cast("date")).alias("event_date"),
        F.col("ts").cast("timestamp_ntz").alias("order_timestamp"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.get_json_object("props", "$.k").alias("restaurant_id"),
        F.col("event_type").alias("cuisine_type"),
        _jitter(nk, eid, 64).alias("pickup_lat"),
        _jitter(nk, eid, 32).alias("pickup_lon"),
        _jitter(nk, eid, 16).alias("delivery_lat"),
        _jitter(nk, eid, 8).alias("delivery_lon"),
        F.col("value").cast("double").alias("order_value_usd"),
        F.col("r_name").alias("city"),
        F.col("n_name").alias("neighbourhood"),
    )


def dirty_order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events as delivered text, with corrupt values and re-delivered rows, for clean_orders.

    Fixed rules (on the numeric order id):
      * % 13 = 0 -> value null;  else % 11 = 0 -> value negated
      * % 7 = 0  -> the row is delivered twice, identical
      * % 5 = 0  -> a later correction is delivered too: timestamp + 1 second,
                    value + 1 (the dedup must keep it)
    and then, on the text: value "n/a" (% 43 = 0), "NaN" (% 19 = 0), "Infinity" (% 23 = 0) or
    "1e40" (% 29 = 0), the first that applies; timestamp "not a time" (% 17 = 0); date
    "2024-13-45" (% 41 = 0); no customer (% 31 = 0); no order id (% 37 = 0).
    """
    base = order_events(spark, sf_dir)
    oid = F.col("order_id").cast("bigint")
    v = F.col("order_value_usd")
    corrupt = F.when(oid % 13 == 0, F.lit(None).cast("double")).when(oid % 11 == 0, -v).otherwise(v)
    # One scan: every order is emitted 1-3 times (0 = original, 1 = identical
    # re-delivery, 2 = later correction) by a generator, not by a union of scans.
    copies = F.array_compact(
        F.array(F.lit(0), F.when(oid % 7 == 0, F.lit(1)), F.when(oid % 5 == 0, F.lit(2)))
    )
    fanned = base.withColumn("order_value_usd", corrupt).withColumn("_copy", F.explode(copies))
    correction = F.col("_copy") == 2
    sent = fanned.withColumns(
        {
            "order_timestamp": F.when(correction, F.col("order_timestamp") + F.expr("INTERVAL 1 SECOND"))
            .otherwise(F.col("order_timestamp")),
            "order_value_usd": F.when(correction, v + F.lit(1.0)).otherwise(v),
        }
    ).drop("_copy")
    text = sent.select(*[F.col(c).cast("string").alias(c) for c in sent.columns])
    nothing = F.lit(None).cast("string")
    return text.withColumn("_oid", oid).withColumns(
        {
            "order_value_usd": F.when(F.col("_oid") % 43 == 0, "n/a").when(F.col("_oid") % 19 == 0, "NaN")
            .when(F.col("_oid") % 23 == 0, "Infinity").when(F.col("_oid") % 29 == 0, "1e40")
            .otherwise(F.col("order_value_usd")),
            "order_timestamp": F.when(F.col("_oid") % 17 == 0, "not a time").otherwise(F.col("order_timestamp")),
            "event_date": F.when(F.col("_oid") % 41 == 0, "2024-13-45").otherwise(F.col("event_date")),
            "customer_id": F.when(F.col("_oid") % 31 == 0, nothing).otherwise(F.col("customer_id")),
            "order_id": F.when(F.col("_oid") % 37 == 0, nothing).otherwise(F.col("order_id")),
        }
    ).drop("_oid")


def staged_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event dates of ``order_events``.  (user, date) pairs are collapsed before the users
    are looked up, so no event row is joined."""
    pairs = _table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("date").alias("event_date")).distinct()
    users = _table(spark, sf_dir, "customer").join(
        _geography(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi"
    )
    return pairs.join(users, pairs.user_id == users.c_custkey, "left_semi").select("event_date").distinct()


def _per_zone(geo: DataFrame) -> DataFrame:
    """One row per zone: nations with n_nationkey % 4 = 0 have a second zone (``z`` = 1)."""
    zones = F.when(F.col("n_nationkey") % 4 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return geo.withColumn("z", F.explode(zones)).withColumn(
        "zone_id", F.concat(F.lit("ZONE_"), F.lpad((F.col("n_nationkey") + 1 + 1000 * F.col("z")).cast("string"), 4, "0"))
    )


def geo_zone_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones; density = 10 (15 in a second zone) x customers of the nation; nation 7 has no area."""
    customers = (
        _table(spark, sf_dir, "customer")
        .groupBy("c_nationkey")
        .agg(F.count(F.lit(1)).alias("n_customers"))
    )
    geo = _geography(spark, sf_dir)
    nk, z = F.col("n_nationkey"), F.col("z")
    zone_type = F.element_at(F.array(*[F.lit(t) for t in ZONE_TYPES]), (nk % 5 + 1).cast("int"))
    counted = geo.join(customers, geo.n_nationkey == customers.c_nationkey, "left")
    area = (nk % 8).cast("double") * 0.5 + 0.5 + z.cast("double") * 0.5
    return _per_zone(counted).select(
        "zone_id",
        F.col("n_name").alias("neighbourhood"),
        F.col("r_name").alias("city"),
        F.substring("r_name", 1, 2).alias("state"),
        zone_type.alias("zone_type"),
        nk.cast("double").alias("centre_lat"),
        F.col("n_regionkey").cast("double").alias("centre_lon"),
        (F.coalesce(F.col("n_customers"), F.lit(0)) * (10 + 5 * z)).cast("double").alias("device_density_per_km2"),
        (nk * 3 + 10 + z).cast("double").alias("avg_dwell_time_min"),
        F.when(nk == 7, F.lit(0.0)).otherwise(area).alias("zone_area_km2"),
    )


def zone_registry(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    """Registry, all text.  Nations with n_nationkey % 6 = 5 are unregistered; thresholds are
    k + n_nationkey % 5, and 4 more in a second zone, so some exceed the release gate k; that
    of nation 9 is no number."""
    nk, z = F.col("n_nationkey"), F.col("z")
    return (
        _per_zone(_geography(spark, sf_dir))
        .where(nk % 6 != 5)
        .select(
            "zone_id",
            F.concat(F.lit("STUDY_"), (F.col("n_regionkey") + 100).cast("string")).alias("study_id"),
            F.concat(F.lit("CAMP_"), (nk % 7 + 1000).cast("string")).alias("campaign_id"),
            F.col("r_name").alias("target_city"),
            F.when(nk == 9, F.lit("unknown")).otherwise((nk % 5 + F.lit(k) + 4 * z).cast("string")).alias("min_order_threshold"),
            F.lit(None).cast("string").alias("ext1"),
            F.lit(None).cast("string").alias("ext2"),
        )
    )
