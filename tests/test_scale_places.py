"""Pairs within a distance go by places; copies are not multiplied out."""

from pyspark.sql import functions as F

from gaugeflow.operators import joins as J


def test_sites_that_share_a_place_are_one_class(spark):
    a = spark.createDataFrame([(f"a{i}", 50.0, 7.0) for i in range(50)] + [("x", 60.0, 7.0), ("n", None, 7.0)],
                              "a_id string, a_lat double, a_lon double")
    b = spark.createDataFrame([(f"b{i}", 50.1, 7.0) for i in range(50)] + [("y", 50.0, 7.5), ("far", 0.0, 0.0)],
                              "b_id string, b_lat double, b_lon double")
    at = (("a_lat", "a_lon"), ("b_lat", "b_lon"))
    out = J.distance_classes(a, b, "a_id", "b_id", 100.0, *at).cache()
    pairs = out.where("kind = 'pair'")
    assert sorted((r.left_class, r.right_class) for r in pairs.collect()) == [("a0", "b0"), ("a0", "y")]
    member = lambda kind: out.where(F.col("kind") == kind).select(f"{kind}_class", F.col("member_id").alias(f"{kind}_id"))
    full = pairs.drop("member_id").join(member("left"), "left_class").join(member("right"), "right_class")
    plain = J.grid_distance_join(a, b, 100.0, *at).select("a_id", "b_id", "distance_km").collect()
    assert sorted((r.left_id, r.right_id, r.distance_km) for r in full.collect()) == sorted(tuple(r) for r in plain)
    assert len(plain) == 50 * 51
