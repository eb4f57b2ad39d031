"""All pairs of sites, copies of a place included."""

import __spark_entry__ as E
from pyspark.sql import functions as F

from gaugeflow.operators import joins as J

AT = (("a_lat", "a_lon"), ("b_lat", "b_lon"))


def test_every_pair_of_rows_is_listed(spark, monkeypatch):
    monkeypatch.setattr(J, "PLACE_ROWS", 4)
    a = spark.createDataFrame([(f"a{i}", 50.0, 7.0) for i in range(9)] + [("a0", 50.0, 7.0), (None, 50.0, 7.0), ("x", 60.0, 7.0), ("n", None, 7.0)],
                              "a_id string, a_lat double, a_lon double")
    b = spark.createDataFrame([(f"b{i}", 50.1, 7.0) for i in range(10)] + [("y", 50.0, 7.5), ("far", 0.0, 0.0)],
                              "b_id string, b_lat double, b_lon double")
    got = [tuple(r) for r in J.distance_pairs(a, b, "a_id", "b_id", 100.0, *AT).collect()]
    want = [tuple(r) for r in J.grid_distance_join(a, b, 100.0, *AT).select("a_id", "b_id", "distance_km").collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) == 11 * 11


def test_nearest_sites_gives_a_row_for_each_pair(spark, tmp_path):
    keys = spark.range(1, 5)
    keys.selectExpr("id AS s_suppkey", "'s' AS s_name").write.parquet(str(tmp_path / "supplier.parquet"))
    spark.range(1, 9).selectExpr("id % 4 + 1 + 1800 * (id % 2) AS c_custkey", "'c' AS c_name").write.parquet(str(tmp_path / "customer.parquet"))
    out = E.queries()["nearest_sites"](spark, str(tmp_path))
    assert out.columns == ["a_id", "b_id", "distance_km"]
    at_zero = out.where(F.col("distance_km") == 0)
    # a customer's key is a supplier's, or 1,800 more, which is the same place
    assert at_zero.count() == 8 and at_zero.where("b_id % 1800 != a_id").count() == 0
