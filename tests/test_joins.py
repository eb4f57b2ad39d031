"""As-of, distance, band and fallback joins against brute force."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from gaugeflow.functions.scalars import haversine_km
from gaugeflow.operators import joins as J
from gaugeflow.operators.asof import asof_nearest

T0 = dt.datetime(2024, 1, 1)


def _brute_asof(left, right, tol_s):
    out = {}
    for lid, lk, lt in left:
        best = None
        for rk, rt, rv in right:
            if rk != lk:
                continue
            d = abs((rt - lt).total_seconds())
            if d > tol_s:
                continue
            key = (d, rt)  # nearest, then earlier
            if best is None or key < best[0]:
                best = (key, rt, rv)
        out[lid] = (best[1], best[2]) if best else (None, None)
    return out


def test_asof_matches_brute_force_with_ties_and_edges(spark):
    rnd = random.Random(7)
    left = [(i, f"s{i % 3}", T0 + dt.timedelta(minutes=rnd.randint(0, 3000))) for i in range(150)]
    right_set = {}
    for _ in range(120):
        k = f"s{rnd.randint(0, 3)}"
        t = T0 + dt.timedelta(minutes=rnd.randint(0, 3000))
        right_set[(k, t)] = float(rnd.randint(0, 100))
    # exact edge cases: 30 min away (inside), 31 min away (outside), equal distance both sides
    left += [(1000, "e", T0 + dt.timedelta(hours=10)), (1001, "f", T0 + dt.timedelta(hours=10)),
             (1002, "g", T0 + dt.timedelta(hours=10)), (1003, "none", T0)]
    right_set[("e", T0 + dt.timedelta(hours=10, minutes=30))] = 1.0
    right_set[("f", T0 + dt.timedelta(hours=10, minutes=31))] = 2.0
    right_set[("g", T0 + dt.timedelta(hours=9, minutes=50))] = 3.0
    right_set[("g", T0 + dt.timedelta(hours=10, minutes=10))] = 4.0
    right = [(k, t, v) for (k, t), v in right_set.items()]
    ldf = spark.createDataFrame(left, "id long, k string, t timestamp_ntz")
    rdf = spark.createDataFrame(right, "k string, rt timestamp_ntz, v double")
    got = {r.id: (r.matched_ts, r.v) for r in
           asof_nearest(ldf, rdf, ["k"], "t", "rt", 30 * 60, ["v"], bucket_seconds=3600).collect()}
    exp = _brute_asof(left, right, 30 * 60)
    assert got == exp
    assert got[1000][1] == 1.0 and got[1001] == (None, None) and got[1002][1] == 3.0 and got[1003] == (None, None)


def test_grid_distance_join_equals_cross_join(spark):
    rnd = random.Random(11)
    pts_a = [(f"a{i}", rnd.uniform(-89.9, 89.9), rnd.uniform(-180, 180)) for i in range(120)]
    pts_a += [("pole", 89.5, 10.0), ("dateline", 10.0, 179.9), ("nullpt", None, 1.0)]
    pts_b = [(f"b{i}", rnd.uniform(-89.9, 89.9), rnd.uniform(-180, 180)) for i in range(300)]
    pts_b += [("pole_b", 88.9, -170.0), ("dateline_b", 10.0, -179.9), ("same", 10.0, 179.9)]
    a = spark.createDataFrame(pts_a, "aid string, alat double, alon double")
    b = spark.createDataFrame(pts_b, "bid string, blat double, blon double")
    km = 900.0
    got = {(r.aid, r.bid) for r in J.grid_distance_join(a, b, km, ("alat", "alon"), ("blat", "blon")).collect()}
    exp = {(r.aid, r.bid) for r in a.crossJoin(b)
           .where(haversine_km("alat", "alon", "blat", "blon") <= km).collect()}
    assert got == exp
    assert ("dateline", "dateline_b") in got and ("pole", "pole_b") in got and ("dateline", "same") in got


def test_band_join_rules(spark):
    bands = spark.createDataFrame([
        ("DEFAULT", 1, None, 80.0, "low", "Low", "high"),
        ("DEFAULT", 2, 81.0, None, "ok", "OK", "normal"),
        ("KAUB", 1, None, 100.0, "k_low", "Kaub low", "high"),
        ("KAUB", 2, 50.0, None, "k_ok", "Kaub ok", "normal"),
    ], "station_name string, band_order int, min_cm double, max_cm double, band_id string, band_label string, severity string")
    facts = spark.createDataFrame([("X", 10.0), ("X", 80.0), ("X", 80.5), ("X", 500.0), (" kaub ", 60.0), ("KAUB", 60.0), ("KAUB", 200.0), ("X", None)],
                                  "station_name string, value double")
    got = sorted((r.station_name, r.value, r.band_id) for r in J.band_join(facts, bands, "value").collect()
                 if r.value is not None)
    assert got == [(" kaub ", 60.0, "k_low"), ("KAUB", 60.0, "k_low"), ("KAUB", 200.0, "k_ok"), ("X", 10.0, "low"), ("X", 80.0, "low"), ("X", 80.5, None),
                   ("X", 500.0, "ok")]


def test_ranked_fallback_prefers_primary_then_backups(spark):
    facts = spark.createDataFrame([("g1", T0), ("g1", T0 + dt.timedelta(hours=1)), ("g2", T0)],
                                  "station_id string, timestamp_utc timestamp_ntz")
    mapping = spark.createDataFrame([("g1", "P", "B1", "B2"), ("g2", "P", None, None)],
                                    "station_id string, primary_dwd_station_id string, backup1_dwd_station_id string, "
                                    "backup2_dwd_station_id string")
    obs = spark.createDataFrame([
        ("P", T0, None), ("B1", T0, 2.0), ("B2", T0, 3.0),
        ("B2", T0 + dt.timedelta(hours=1), 30.0),
    ], "dwd_station_id string, timestamp_utc timestamp_ntz, temperature_c double")
    out = J.ranked_fallback_join(facts, obs, mapping, ["temperature_c"]).collect()
    got = sorted((r.station_id, r.timestamp_utc, r.temperature_c, r.weather_source_used) for r in out)
    assert got == [("g1", T0, 2.0, "backup1"), ("g1", T0 + dt.timedelta(hours=1), 30.0, "backup2"),
                   ("g2", T0, None, None)]


def test_exact_actuals_rejects_duplicates(spark):
    import pytest
    preds = spark.createDataFrame([(1,), (2,)], "k long")
    dup = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k long, a double")
    with pytest.raises(Exception):
        J.exact_actuals(preds, dup, ["k"]).collect()
    ok = spark.createDataFrame([(1, 1.0)], "k long, a double")
    assert sorted((r.k, r.a) for r in J.exact_actuals(preds, ok, ["k"]).collect()) == [(1, 1.0), (2, None)]


def test_haversine_zero_and_known_distance(spark):
    r = spark.range(1).select(haversine_km(F.lit(50.0), F.lit(8.0), F.lit(50.0), F.lit(8.0)).alias("z"),
                              haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("d")).first()
    assert r.z == 0.0 and math.isclose(r.d, 2 * math.pi * 6371.0 / 360, rel_tol=1e-12)


def _brute_nearest(a, b, k, max_km, skip_self=False, decimals=None, group=None):
    def km(x, y):
        p, q, dl = map(math.radians, (x[1], y[1], y[2] - x[2]))
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(dl / 2) ** 2
        return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))

    out = set()
    for x in a:
        groups = {}
        for y in b:
            if None in (*x[1:3], *y[1:3]) or skip_self and x[0] == y[0] or group and group(x) != group(y):
                continue
            d = km(x, y)
            if d <= max_km:
                groups.setdefault(group and group(y), []).append((round(d, decimals) if decimals else d, y[0]))
        for near in groups.values():
            out |= {(x[0], i) for _, i in sorted(near)[:k]}
    return out


def _points(rnd, n, name):
    spots = [(rnd.uniform(-80, 80), rnd.uniform(-180, 180), rnd.choice([0.05, 1, 8])) for _ in range(6)]
    out = []
    for i in range(n):
        la, lo, w = rnd.choice(spots)
        out.append((f"{name}{i:04d}", max(-90.0, min(90.0, rnd.gauss(la, w))), (rnd.gauss(lo, w) + 180) % 360 - 180, f"g{i % 3}"))
    out += [(f"{name}p{i}", 89.5 * (-1) ** i, rnd.uniform(-180, 180), "g0") for i in range(12)]
    out += [(f"{name}d{i}", rnd.uniform(-2, 2), 179.9 if i % 2 else -179.9, "g1") for i in range(12)]
    return out + [(f"{name}n", None, 5.0, "g0"), (f"{name}e", 10.0, 20.0, "g0"), (f"{name}f", 10.0, 20.0, "g0")]


def test_nearest_k_equals_brute_force(spark):
    rnd = random.Random(17)
    a, b = _points(rnd, 150, "a"), _points(rnd, 220, "b")
    b += [(f"bx{i}", *a[i][1:3], "g2") for i in range(40)]  # points on top of one another
    left = spark.createDataFrame(a, "a_id string, a_lat double, a_lon double, g string")
    right = spark.createDataFrame(b, "b_id string, b_lat double, b_lon double, g string")
    cols = dict(left_cols=("a_lat", "a_lon"), right_cols=("b_lat", "b_lon"))
    for k, km in ((3, 250.0), (1, 30.0), (5, 3000.0), (4, 21000.0)):
        got = J.nearest_k(left.drop("g"), right.drop("g"), "a_id", "b_id", k, km, **cols).collect()
        assert {(r.a_id, r.b_id) for r in got} == _brute_nearest(a, b, k, km) and len(got) == len({(r.a_id, r.b_id) for r in got})
    got = J.nearest_k(left, right, "a_id", "b_id", 2, 900.0, on=["g"], decimals=2, **cols).collect()
    assert {(r.a_id, r.b_id) for r in got} == _brute_nearest(a, b, 2, 900.0, decimals=2, group=lambda x: x[3])
    same = right.select(F.col("b_id").alias("a_id"), F.col("b_lat").alias("a_lat"), F.col("b_lon").alias("a_lon"))
    got = J.nearest_k(same, right.drop("g"), "a_id", "b_id", 3, 400.0, skip_self=True, **cols).collect()
    assert {(r.a_id, r.b_id) for r in got} == _brute_nearest(b, b, 3, 400.0, skip_self=True)
    assert J.nearest_k(left.limit(0), right, "a_id", "b_id", 3, 400.0, on=["g"], **cols).count() == 0


def test_nearest_k_meets_far_fewer_pairs_than_the_radius_holds(spark):
    n = 4000
    grid = spark.range(n).select(F.col("id").alias("i"), (F.col("id") % 63 * 0.04 + 45).alias("la"),
                                 (F.floor(F.col("id") / 63) * 0.04 + 8).alias("lo"))
    right = grid.toDF("j", "la2", "lo2")
    out = J.nearest_k(grid, right, "i", "j", 3, 250.0, ("la", "lo"), ("la2", "lo2"), skip_self=True)
    out.count()
    met = J.nearest_k(grid, right, "i", "j", 10 ** 6, 250.0, ("la", "lo"), ("la2", "lo2"), skip_self=True)  # k of all: the whole radius
    assert out.count() == 3 * n and met.where("i < 20").count() > 20 * 2000
    rows = J.nearest_k(grid.where("i = 2000"), right, "i", "j", 3, 250.0, ("la", "lo"), ("la2", "lo2"), skip_self=True).collect()
    assert max(r.distance_km for r in rows) < 6
