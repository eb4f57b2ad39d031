"""The k nearest where many rows share a place."""

import pytest

from gaugeflow.operators import joins as J


@pytest.mark.parametrize("skip_self", [False, True])
def test_nearest_k_meets_a_place_no_more_often_than_k_needs(spark, skip_self):
    rows = [(f"s{i:03d}", 50.0, 7.0) for i in range(200)] + [("t1", 50.2, 7.0), ("t2", 50.4, 7.0)]
    left = spark.createDataFrame(rows, "a_id string, a_lat double, a_lon double")
    right = spark.createDataFrame(rows + [("s000", 50.0, 7.0)], "b_id string, b_lat double, b_lon double")
    at = dict(left_cols=("a_lat", "a_lon"), right_cols=("b_lat", "b_lon"))
    got = J.nearest_k(left, right, "a_id", "b_id", 3, 500.0, skip_self=skip_self, **at)
    best = {}
    for r in J.grid_distance_join(left, right, 500.0, **at).collect():
        if not (skip_self and r.a_id == r.b_id):
            best.setdefault(r.a_id, []).append((r.distance_km, r.b_id))
    want = sorted((a, *p) for a, ps in best.items() for p in sorted(ps)[:3])
    assert sorted((r.a_id, r.distance_km, r.b_id) for r in got.collect()) == want
    place = J._first_of_place(right, ["b_lat", "b_lon"], "b_id", 3, skip_self)
    assert place.where("b_lat = 50.0").count() == (5 if skip_self else 3)
