"""Physical-plan properties the scale design relies on."""

import re

import __spark_entry__ as E
from pyspark.sql import functions as F

from conftest import SMOKE
from gaugeflow import tables as T
from gaugeflow.operators.clean import date_window


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_distance_join_is_an_equi_join(spark):
    p = _plan(E.queries()["nearest_sites"](spark, SMOKE))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_date_window_reaches_the_scan(spark):
    df = date_window(T.table(spark, SMOKE, "orders"), "o_orderdate", "1996-03-01", "1997-06-30")
    scan = [line for line in _plan(df).split("\n") if "FileScan" in line][0]
    pushed = scan[scan.index("PushedFilters:"):]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed


def test_projection_is_pruned(spark):
    df = E.queries()["floor_time"](spark, SMOKE)
    scan = [line for line in _plan(df).split("\n") if "FileScan" in line][0]
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", scan).group(1)
    assert schema == "struct<event_id:bigint,ts:timestamp_ntz>"


def test_asof_needs_one_shuffle(spark):
    p = _plan(E.queries()["asof_nearest"](spark, SMOKE))
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1
    assert "SinglePartition" not in p


def test_top_k_uses_group_limit(spark):
    p = _plan(E.queries()["rank_top3"](spark, SMOKE))
    assert "WindowGroupLimit" in p


def test_no_single_partition_exchange_in_feature_plans(spark):
    for name in ("supervised_flagship", "gauge_features", "time_splits"):
        df = E.queries()[name](spark, SMOKE)
        df.write.format("noop").mode("overwrite").save()
        p = _plan(df)
        big = [line for line in p.split("\n") if "Exchange SinglePartition" in line]
        # the only single-partition steps allowed are over per-partition / per-fold stats tables
        assert all("_tb" not in line and "value" not in line for line in big), name


def test_dedup_is_a_partial_aggregate(spark):
    p = _plan(E.queries()["dedup_latest"](spark, SMOKE))
    assert "partial_max_by" in p or re.search(r"HashAggregate\(keys=.*functions=\[partial_max_by", p) or "ObjectHashAggregate" in p


def test_registered_fits_use_all_iterations_and_features(spark, monkeypatch):
    from gaugeflow import catalog as C

    seen = {}

    def stop(name):
        def run(*args, **named):
            seen[name] = named["max_iter"], next(len(a) for a in args if a is C.ML_NUMERIC)
            raise StopIteration
        return run

    monkeypatch.setattr(C.ML, "fit_model", stop("gbt_fit_score"))
    monkeypatch.setattr(C.ML, "cluster_models", stop("cluster_models"))
    monkeypatch.setattr(C.ML, "station_clusters", lambda *a, **k: None)
    monkeypatch.setattr(C, "_ml_frame", lambda *a: spark.createDataFrame([], "timestamp_utc timestamp_ntz"))
    monkeypatch.setattr(C, "curated_series", lambda *a: None)
    for run in (C.q_gbt_fit_score, C.q_cluster_models):
        try:
            run(spark, SMOKE)
        except StopIteration:
            pass
    assert seen == {"gbt_fit_score": (300, 50), "cluster_models": (250, 50)}


def test_segment_labels_from_decision_and_support_gauges(spark):
    import datetime as dt

    from gaugeflow.plans.features import segment_labels_24h

    t = dt.datetime(2024, 1, 1, 5, 30)
    series = spark.createDataFrame([("A", t, 100.004), ("B", t, 50.0), ("C", t, None), ("D", t, 10.0), ("B", t + dt.timedelta(hours=1), 99.0)],
                                   "station_name string, timestamp_utc timestamp_ntz, value double")
    segs = spark.createDataFrame([("S1", "A", "decision"), ("S1", "B", "support"), ("S1", "B", "support"), ("S2", "B", "decision"),
                                  ("S2", "C", "support"), ("S3", "D", "support")], "segment_id string, station_name string, role string")
    limits = spark.createDataFrame([("A", 50.0), ("B", 49.9), ("D", 500.0)], "station_name string, threshold_cm double")
    got = {(r.segment_id, r.timestamp_utc): tuple(r)[2:] for r in segment_labels_24h(series, segs, limits).collect()}
    assert got == {("S1", "2024-01-01 05:30"): (50.0, 100.0, 75.0, 2, 1), ("S1", "2024-01-01 06:30"): (99.0, 99.0, 99.0, 1, 0),
                   ("S2", "2024-01-01 05:30"): (50.0, 50.0, 50.0, 1, 0), ("S2", "2024-01-01 06:30"): (99.0, 99.0, 99.0, 1, 0),
                   ("S3", "2024-01-01 05:30"): (10.0, 10.0, 10.0, 1, 0)}
