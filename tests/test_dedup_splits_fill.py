"""Dedup / upsert properties, splits, proxy fill, time conversion."""

import datetime as dt

from pyspark.sql import functions as F

from gaugeflow.functions.scalars import local_to_utc, normalize_name, pad_id
from gaugeflow.operators import dedup as DD
from gaugeflow.operators.splits import time_splits, walkforward_folds
from gaugeflow.plans import fill as PL

T0 = dt.datetime(2024, 1, 1)


def test_latest_per_key_prefers_newest_then_highest_hash(spark):
    df = spark.createDataFrame([
        ("s", T0, 1.0, T0 + dt.timedelta(minutes=1), "a"),
        ("s", T0, 2.0, T0 + dt.timedelta(minutes=2), "a"),
        ("s", T0, 3.0, T0 + dt.timedelta(minutes=2), "b"),
        ("t", T0, 9.0, None, "z"),
    ], "station_id string, ts timestamp_ntz, value double, ing timestamp_ntz, h string")
    got = {r.station_id: r.value for r in DD.latest_per_key(df, ["station_id", "ts"], ["ing", "h"]).collect()}
    assert got == {"s": 3.0, "t": 9.0}


def test_upsert_is_idempotent_and_null_keys_never_match(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k long, v string")
    upd = spark.createDataFrame([(2, "B", 1), (2, "BB", 2), (3, "c", 1), (None, "m", 1)], "k long, v string, o long")
    once = DD.upsert(tgt, upd, ["k"], ["o"])
    twice = DD.upsert(once, upd, ["k"], ["o"])
    rows = sorted(once.collect(), key=lambda r: (r.k is None, r.k or 0, r.v))
    assert [(r.k, r.v) for r in rows] == [(1, "a"), (2, "BB"), (3, "c"), (None, "m"), (None, "n")]
    # a second run replaces matched keys again; only the null-key insert repeats
    assert once.where("k is not null").exceptAll(twice.where("k is not null")).count() == 0


def test_time_splits_disjoint_and_gapped(spark):
    rows = [("s", "W", T0 + dt.timedelta(hours=h), float(h), float(h) if h < 90 else None) for h in range(100)]
    df = spark.createDataFrame(rows, "station_name string, timeseries_name string, timestamp_utc timestamp_ntz, "
                                     "value double, label double")
    out = time_splits(df, "label", gap_hours=5, production_required=["value"]).collect()
    lab = [r for r in out if r.split_name != "production"]
    assert len(lab) == 90 and len({r.timestamp_utc for r in lab}) == 90
    b = lab[0]
    # n = 90 distinct labelled stamps: cut ranks round(63) and round(76.5) = 77
    assert b.train_end_utc == T0 + dt.timedelta(hours=62) and b.validation_end_utc == T0 + dt.timedelta(hours=76)
    for r in lab:
        t = r.timestamp_utc
        if r.split_name == "train":
            assert t < b.train_end_utc
        elif r.split_name == "validation":
            assert b.validation_start_utc <= t < b.validation_end_utc
        elif r.split_name == "test":
            assert t >= b.test_start_utc
        else:
            assert r.gap_reason in ("train_validation_gap", "validation_test_gap")
    prod = [r for r in out if r.split_name == "production"]
    assert len(prod) == 1 and prod[0].timestamp_utc == T0 + dt.timedelta(hours=99)


def test_walkforward_folds(spark):
    rows = [(T0 + dt.timedelta(days=d),) for d in range(40)]
    df = spark.createDataFrame(rows, "timestamp_utc timestamp_ntz")
    f = walkforward_folds(df, min_train_days=10, step_days=7, horizon_hours=24).orderBy("fold").collect()
    assert [r.forecast_origin_utc for r in f] == [T0 + dt.timedelta(days=d) for d in (10, 17, 24, 31, 38)]
    assert [r.train_rows for r in f] == [10, 17, 24, 31, 38]
    assert [r.test_rows for r in f] == [7, 7, 7, 7, 2]


def test_proxy_fill_rules(spark):
    obs = spark.createDataFrame([
        ("T", T0, None, None), ("P1", T0, 10.0, 1.0), ("P2", T0, 20.0, 2.0),
        ("T", T0 + dt.timedelta(hours=1), None, None), ("P1", T0 + dt.timedelta(hours=1), None, 5.0),
        ("P2", T0 + dt.timedelta(hours=1), 40.0, None),
    ], "dwd_station_id string, timestamp_utc timestamp_ntz, temperature_c double, wind_speed_ms double")
    cands = spark.createDataFrame([
        ("T", "air_temperature", "P1", 1.0), ("T", "air_temperature", "P2", 2.0),
        ("T", "wind", "P1", 1.0), ("T", "wind", "P2", 2.0),
    ], "target_station_id string, variable string, proxy_station_id string, distance_km double")
    vars_ = {"air_temperature": "temperature_c", "wind": "wind_speed_ms"}
    fills = PL.proxy_fill(obs, cands, variables=vars_)
    got = {(r._mts, r.variable): (round(r.fill_value, 9), r.fill_method, r.proxy_source_station_id)
           for r in fills.collect()}
    idw = round((10 / 1 + 20 / 4) / (1 + 1 / 4), 9)
    assert got[(T0, "air_temperature")] == (idw, "idw", "P1,P2")
    assert got[(T0, "wind")] == (1.0, "nearest", "P1")          # wind is not an IDW variable
    assert got[(T0 + dt.timedelta(hours=1), "air_temperature")] == (40.0, "nearest", "P2")  # one proxy only
    zero = spark.createDataFrame([("T", "air_temperature", "P1", 0.0), ("T", "air_temperature", "P2", 2.0)],
                                 "target_station_id string, variable string, proxy_station_id string, distance_km double")
    z = [r for r in PL.proxy_fill(obs, zero, variables=vars_).collect() if r._mts == T0][0]
    assert z.fill_value == 10.0 and z.fill_method == "idw"
    filled = PL.apply_fill(obs, fills, variables=vars_).where("dwd_station_id = 'T'").orderBy("timestamp_utc").collect()
    assert filled[0].is_proxy_backfilled and filled[0].temperature_c == idw


def test_local_to_utc_dst_policy(spark):
    df = spark.createDataFrame([("2023-10-29 02:30:00",), ("2023-03-26 02:30:00",), ("2023-07-01 12:00:00",)], "l string")
    out = df.select(local_to_utc(F.col("l"), "Europe/Berlin").alias("u")).collect()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    got = [r.u.strftime("%Y-%m-%d %H:%M") for r in out]
    # ambiguous -> standard time (later instant); gap -> first valid instant
    assert got == ["2023-10-29 01:30", "2023-03-26 01:00", "2023-07-01 10:00"]


def test_names_and_ids(spark):
    df = spark.createDataFrame([(" Köln / Süd ", "7"), ("Straße am Rhein", "1234567")], "n string, i string")
    r = df.select(normalize_name("n", "ascii").alias("a"), normalize_name("n", "compact").alias("c"),
                  normalize_name("n", "dash_slash").alias("d"), pad_id("i", 5).alias("p")).collect()
    assert (r[0].a, r[0].c, r[0].d, r[0].p) == ("KOELN-SUED", "KOELNSUED", "KÖLN---SÜD", "00007")
    assert (r[1].a, r[1].p) == ("STRASSE-AM-RHEIN", "1234567")
