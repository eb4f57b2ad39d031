"""Loading the driver's parquet tables and shaping them into the engine's
input schemas (FIXTURES.md).

The driver ships no gauge data, so each function here only renames and
casts columns of a given table into the schema an operator expects; none of
them does an operator's work. Row counts grow with the given tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _coord(key: Column, mult: int, modulus: int, base: float) -> Column:
    """Deterministic pseudo coordinate from an integer key."""
    return F.lit(base) + ((key * mult) % modulus).cast("double") / F.lit(100.0)


def station_lat(key: Column) -> Column:
    return _coord(key, 7919, 600, 47.0)


def station_lon(key: Column) -> Column:
    return _coord(key, 104729, 900, 6.0)


def raw_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gauge measurement rows (FIXTURES §1) from ``events``: one gauge per
    user, hourly stamps, the event time as ingestion time."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("station_id"),
        F.concat(F.lit("STATION "), F.col("user_id").cast("string")).alias("station_name"),
        F.lit("W").alias("timeseries_name"),
        F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("timestamp_utc"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("value") * 5 - 100).alias("value"),
        F.lit("cm").alias("unit"),
        station_lat(F.col("user_id")).alias("latitude"),
        station_lon(F.col("user_id")).alias("longitude"),
        F.col("ts").alias("ingestion_ts_utc"),
        F.col("event_type").alias("source"),
        F.sha2(F.col("event_id").cast("string"), 256).alias("source_record_hash"),
        F.concat(F.lit("file:///events/"), F.col("event_type")).alias("source_url"),
    )


def raw_type_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same as ``raw_measurements`` but one gauge per event type, which gives
    series long enough for 72-row leads."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("T_"), F.col("event_type")).alias("station_id"),
        F.upper(F.col("event_type")).alias("station_name"),
        F.lit("W").alias("timeseries_name"),
        F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("timestamp_utc"),
        F.col("value").alias("value"),
        F.lit("cm").alias("unit"),
        F.col("ts").alias("ingestion_ts_utc"),
        F.sha2(F.col("event_id").cast("string"), 256).alias("source_record_hash"),
    )


def raw_weather(spark: SparkSession, sf_dir: str, n_stations: int = 20) -> DataFrame:
    """Hourly weather observation rows (FIXTURES §2) from ``events``: the
    station is ``user_id mod n_stations`` within each ``10 n_stations`` users;
    some measures are missing."""
    e = table(spark, sf_dir, "events")
    sid = F.col("user_id") % n_stations + F.floor(F.col("user_id") / (10 * n_stations)) * n_stations
    v = F.col("value")
    return e.select(
        F.concat(F.lit("D"), F.lpad(sid.cast("string"), 5, "0")).alias("dwd_station_id"),
        F.concat(F.lit("WX "), sid.cast("string")).alias("dwd_station_name"),
        F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("timestamp_utc"),
        station_lat(sid + 1000).alias("latitude"),
        station_lon(sid + 1000).alias("longitude"),
        F.when(F.col("event_id") % 3 == 0, F.lit(None).cast("double")).otherwise(v / 20 - 5).alias("temperature_c"),
        F.when(F.col("event_type") == "click", v / 100).otherwise(F.lit(0.0)).alias("precipitation_mm"),
        F.when(F.col("event_id") % 4 == 0, F.lit(None).cast("double")).otherwise(v / 50).alias("wind_speed_ms"),
        (F.lit(990.0) + v / 10).alias("pressure_hpa"),
        F.when(F.col("event_id") % 5 == 0, F.lit(None).cast("double")).otherwise(v / 5).alias("relative_humidity_pct"),
        F.col("ts").alias("ingestion_ts_utc"),
        F.sha2(F.col("event_id").cast("string"), 256).alias("source_record_hash"),
    )


def site_table(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """Point sites with coordinates: ``supplier`` or ``customer`` rows."""
    if which == "supplier":
        t = table(spark, sf_dir, "supplier")
        k, name = F.col("s_suppkey"), F.col("s_name")
    else:
        t = table(spark, sf_dir, "customer")
        k, name = F.col("c_custkey"), F.col("c_name")
    return t.select(k.cast("string").alias("site_id"), name.alias("site_name"),
                    station_lat(k).alias("latitude"), station_lon(k).alias("longitude"))
