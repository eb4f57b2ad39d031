"""Metrics, data-quality and health edge cases."""

import datetime as dt

from pyspark.sql import functions as F

from gaugeflow.ml import models as ML
from gaugeflow.operators import health as HL
from gaugeflow.operators import metrics as MT


def test_regression_metrics_values_and_ape(spark):
    df = spark.createDataFrame([("s", 0.0, 1.0), ("s", 2.0, 1.0), ("s", 4.0, 1.0), ("t", None, 1.0)],
                               "station_name string, actual_value double, prediction double")
    r = MT.regression_metrics(df).first()
    assert r.rows_evaluated == 3 and abs(r.mae - 5 / 3) < 1e-12 and abs(r.bias - 1.0) < 1e-12
    assert abs(r.mape - (0.5 + 0.75) / 2) < 1e-12  # actual = 0 has no APE
    # p90 with linear interpolation over |e| = [1, 1, 3]: position 1.8 -> 1 + 0.8 * 2
    assert abs(r.p90_abs_error - 2.6) < 1e-12
    empty = MT.regression_metrics(df.where("false")).first()
    assert empty.rows_evaluated == 0 and empty.mae is None and empty.p90_abs_error is None


def test_event_metrics_zero_and_null_cases(spark):
    df = spark.createDataFrame([("a", 5.0, 50.0, 10.0), ("a", 50.0, 50.0, 10.0), ("b", 5.0, 5.0, None)],
                               "m string, actual_value double, prediction double, threshold double")
    got = {r.m: r for r in MT.event_metrics(df, ["m"]).collect()}
    assert got["a"].tp == 0 and got["a"].fn == 1 and got["a"].event_precision == 0.0 and got["a"].event_f1 == 0.0
    assert "b" not in got  # no rows with a threshold -> no event group


def test_daily_health_status_vocabulary(spark):
    t = dt.datetime(2024, 1, 1, 5)
    runs = spark.createDataFrame([(t, "SUCCESS", 10.0, 1, 2, 3), (t, "Failed", 20.0, 5, None, 1), (t, "running", None, None, 1, 1)],
                                 "started_at_utc timestamp, status string, duration_seconds double, rows_ingested long, "
                                 "rows_predicted long, stations_processed long")
    r = HL.daily_health(runs).first()
    assert (r.total_runs, r.successful_runs, r.failed_runs, r.average_duration_seconds) == (3, 1, 1, 15.0)


def test_dq_training_input_empty_is_failure(spark):
    df = spark.createDataFrame([], "split_name string, v double, timestamp_utc timestamp")
    rows = {r.metric_name: r for r in HL.dq_training_input(df, "train", ["v"], "timestamp_utc", "2024-01-01 00:00:00").collect()}
    assert rows["training_missing_fraction"].metric_value == 1.0
    assert all(r.status == "fail" for r in rows.values())


def test_rank_models_skips_bad_json_and_breaks_ties(spark):
    reg = spark.createDataFrame([
        ("v1", "staging", '{"rmse": 2.0, "mae": 1.0}', dt.datetime(2024, 1, 2), None, None),
        ("v2", "staging", '{"rmse": 2.0, "mae": 0.5}', dt.datetime(2024, 1, 3), None, None),
        ("v3", "prod", '{"rmse": 3.0, "mae": 0.1}', dt.datetime(2024, 1, 1), None, None),
        ("v4", "staging", "not json", dt.datetime(2024, 1, 1), None, None),
    ], "model_version string, status string, evaluation_metrics_json string, trained_at_utc timestamp, "
       "promoted_at_utc timestamp, notes string")
    ranked = [r.model_version for r in ML.rank_models(reg).orderBy("rank").collect()]
    assert ranked == ["v2", "v1", "v3"]
    out = {r.model_version: r.status for r in ML.promote(reg, "2024-02-01 00:00:00").collect()}
    assert out == {"v1": "staging", "v2": "prod", "v3": "staging", "v4": "staging"}


def test_latest_by_keeps_one_row_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, t long, v string")
    got = sorted((r.k, r.v) for r in HL.latest_by(df, ["k"], "t").collect())
    assert got == [("a", "y"), ("b", "z")]


def test_fit_and_score_with_categorical_mode_fill(spark):
    rows = [(f"s{i % 6}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), float(i % 11), float((i + 3) % 11),
             None if i % 5 == 0 else ("g1" if i % 3 else "g2")) for i in range(240)]
    df = spark.createDataFrame(rows, "station_name string, timestamp_utc timestamp_ntz, target_value double, "
                                     "target_value_t_plus_24h double, grp string")
    model = ML.fit_model(df, "target_value_t_plus_24h", ["grp"], ["target_value"], max_iter=3, min_instances=2)
    assert model.fill == {"grp": "g1"}
    out = ML.score_latest(df, model, 24, "m1", "r1", ["target_value"]).collect()
    assert len(out) == 6 and all(r.prediction is not None for r in out)
    assert all(r.forecast_timestamp_utc - r.timestamp_utc == dt.timedelta(hours=24) for r in out)


RUNS = "run_id string, job_type string, status string, started_at_utc timestamp_ntz, duration_seconds double"
METRICS = ("run_id string, metric_name string, metric_scope string, metric_value double, threshold_value double, "
           "status string, measured_at_utc timestamp_ntz")
STAGES = "stage_name string, status string, started_at_utc timestamp_ntz, duration_seconds double"
EVALS = "model_version string, split_name string, evaluated_at_utc timestamp_ntz, mae double, rmse double"


def _audit(spark, runs=(), metrics=(), stages=(), evals=()):
    at = lambda d: dt.datetime(2024, 1, d)
    return (spark.createDataFrame([(f"r{i}", j, s, at(d), 1.239) for i, (j, s, d) in enumerate(runs)], RUNS),
            spark.createDataFrame([(r, n, c, 1.0, 2.0, s, at(d)) for r, n, c, s, d in metrics], METRICS),
            spark.createDataFrame([(n, s, at(d), 2.0) for n, s, d in stages], STAGES),
            spark.createDataFrame([(m, p, d and at(d), a, b) for m, p, d, a, b in evals], EVALS))


def _checks(tables, **limits):
    return {r.check_name: (r.status, r.reason, r.checked, r.failed)
            for r in HL.watchdog(*tables, "2024-02-01 00:00:00", **limits).collect()}


def test_watchdog_judges_the_newest_row_of_every_job_metric_and_stage(spark):
    good = dict(runs=[("daily", "FAILED", 1), ("daily", " Succeeded ", 2), ("train", "ok", 1)],
                metrics=[("a", "rows", "x", "fail", 1), ("a", "rows", "x", "Passed", 2), ("a", "rows", None, "ok", 1)],
                stages=[("load", "error", 1), ("load", "success", 3)],
                evals=[("m1", "test", 1, 9.0, 9.0), ("m1", "test", 30, 2.345, None), ("m2", "test", 3, 99.0, 99.0)])
    assert _checks(_audit(spark, **good), max_mae=5, max_rmse=5) == {
        "pipeline_health": ("pass", None, 2, 0), "data_quality_health": ("pass", None, 2, 0),
        "stage_health": ("pass", None, 1, 0), "validation_evaluation_health": ("pass", None, 1, 0)}
    status = HL.system_status(*_audit(spark, **good)).first()
    assert (status.status, status.pipeline_status, status.stage_status, status.evaluation_status) == (
        "degraded", "pass", "pass", "available")  # run a has a failed metric, though a later value passed
    assert status.data_quality_status == "fail" and status.quality_run_id == "a"
    # an old run of one job, a running stage, a null state, an old evaluation
    bad = dict(runs=good["runs"] + [("train", "failed", 2)], metrics=good["metrics"] + [("b", "rows", None, None, 9)],
               stages=good["stages"] + [("load", "running", 4)], evals=[("m1", "test", 1, 1.0, 1.0)])
    assert {k: v[0] for k, v in _checks(_audit(spark, **bad), max_evaluation_age_hours=24).items()} == dict.fromkeys(
        ("pipeline_health", "data_quality_health", "stage_health", "validation_evaluation_health"), "fail")
    status = HL.system_status(*_audit(spark, **bad)).first()
    assert (status.pipeline_status, status.stage_status, status.data_quality_status) == ("unknown", "unknown", "unknown")


def test_watchdog_and_status_without_rows(spark):
    empty = _audit(spark)
    assert _checks(empty) == {
        "pipeline_health": ("fail", "no_pipeline_health_rows", 0, 0),
        "data_quality_health": ("fail", "no_quality_health_rows", 0, 0),
        "stage_health": ("fail", "no_stage_health_rows", 0, 0),
        "validation_evaluation_health": ("pass", "no_evaluation_health_rows", 0, 0)}
    assert _checks(empty, fail_on_missing_evaluation=True)["validation_evaluation_health"][0] == "fail"
    assert tuple(HL.system_status(*empty).first()) == ("degraded", "unknown", "unknown", "unknown", "unknown", None)
    # an evaluation of unknown age and errors passes
    unknown = _audit(spark, evals=[("m", "s", None, None, None)])
    assert _checks(unknown, max_mae=0)["validation_evaluation_health"] == ("pass", None, 1, 0)
    fine = _audit(spark, runs=[("j", "ok", 1)], metrics=[("a", "n", "c", "pass", 1)], stages=[("s", "ok", 1)],
                  evals=[("m", "s", 1, 1.0, 1.0)])
    assert HL.system_status(*fine).first().status == "ok"
