"""Evaluation job: maturity, matching, idempotent merge; ordered results."""

import datetime as dt

import pytest

import __spark_entry__ as E
from conftest import SMOKE
from gaugeflow.ml import walkforward as WF
from gaugeflow.plans import evaluation as EV

T0 = dt.datetime(2024, 1, 10)
PRED = ("run_id string, model_version string, split_name string, station_name string, forecast_timestamp_utc timestamp_ntz, "
        "prediction_ready_utc timestamp_ntz, prediction double")


def _h(hours):
    return T0 + dt.timedelta(hours=hours)


def _frames(spark):
    preds = spark.createDataFrame(
        [("r1", "m", "production", "koeln ", _h(1), T0, 10.0), ("r1", "m", "production", "KOELN", _h(2), T0, 10.0),
         ("r1", "m", "production", "MAINZ", _h(1), T0, 5.0), ("r1", "m", "production", "MAINZ", _h(99), T0, 5.0),
         ("r1", "m", "production", None, _h(1), T0, 5.0), ("r2", "m", "test", "MAINZ", _h(1), T0, 7.0),
         ("r3", "m", "test", "MAINZ", _h(1), _h(1), 8.0)], PRED)
    acts = spark.createDataFrame(
        [("koeln ", _h(1) - dt.timedelta(minutes=10), 12.0), ("koeln ", _h(1) + dt.timedelta(minutes=10), 99.0),
         ("KOELN", _h(2) + dt.timedelta(minutes=31), 1.0), ("MAINZ", _h(1), 3.0), ("MAINZ", _h(1), 4.0), ("MAINZ", _h(1), None),
         ("MAINZ", _h(99), 1.0)], "station_name string, timestamp_utc timestamp_ntz, value double")
    limits = spark.createDataFrame([(" Koeln", 11.0)], "station_name string, threshold_cm double")
    return preds, acts, limits


def test_production_matches_the_nearest_actual_of_matured_forecasts(spark):
    preds, acts, limits = _frames(spark)
    got = {r.station_name: r for r in EV.evaluate_predictions(preds, acts, limits, "production", "2024-01-11 00:00:00").collect()}
    assert set(got) == {"KOELN", "MAINZ"}  # 31 minutes are too far, the forecast of hour 99 is not due
    k, m = got["KOELN"], got["MAINZ"]
    assert (k.actual_value, k.error, k.actual_event_low_water, k.pred_event_low_water) == (12.0, 2.0, False, True)
    assert (m.actual_value, m.threshold, m.actual_event_low_water, m.ape) == (4.0, None, None, 0.25)


def test_other_splits_match_their_newest_run_exactly(spark):
    preds, _, limits = _frames(spark)
    target = spark.createDataFrame([("test", "MAINZ", _h(1), 6.0), ("production", "MAINZ", _h(1), 1.0)],
                                   "split_name string, station_name string, timestamp_utc timestamp_ntz, y double")
    rows = EV.evaluate_predictions(preds, target, limits, "test", "2024-01-11 00:00:00", target_column="y").collect()
    assert [(r.run_id, r.actual_value, r.error) for r in rows] == [("r3", 6.0, -2.0)]
    with pytest.raises(Exception, match="not unique"):
        EV.evaluate_predictions(preds, target.union(target), limits, "test", "2024-01-11 00:00:00", target_column="y").collect()


def test_running_the_job_again_replaces_its_rows(spark):
    preds, acts, limits = _frames(spark)
    none = EV.evaluate_predictions(preds.limit(0), acts, limits, "production", "2024-01-11 00:00:00")
    first, new, summary = EV.evaluation_job(preds, acts, none, limits, "production", "2024-01-11 00:00:00")
    assert summary.first().duplicate_rows_removed == 0 and summary.first().total_evaluation_rows_after_merge == 2
    again, _, summary = EV.evaluation_job(preds, acts, first, limits, "production", "2024-02-11 00:00:00")
    s = summary.first()
    assert (s.new_evaluation_rows, s.total_evaluation_rows_after_merge, s.duplicate_rows_removed) == (3, 3, 2)  # hour 99 is due now
    assert again.where("evaluated_at_utc < '2024-02-01'").count() == 0
    assert EV.evaluation_job(preds.limit(0), acts, first, limits, "production", "2024-01-11 00:00:00")[2].first().rows_evaluated == 0


@pytest.mark.parametrize("name,key", [("stations_by_rmse", lambda r: (-r.rmse, r.station_name)), ("station_list", lambda r: r.station_name),
                                      ("model_metrics", lambda r: (r.rmse, r.model_version)),
                                      ("coverage_by_size", lambda r: (-r.total_rows, r.station_name))])
def test_ordered_results_come_in_order(spark, name, key):
    rows = E.queries()[name](spark, SMOKE).collect()
    assert len(rows) > 2 and rows == sorted(rows, key=key)


def _series(spark, days):
    rows = [(f"STATION {s}", T0 + dt.timedelta(hours=h), 100.0 + 10 * s + h % 24, 101.0 + 10 * s + h % 24, None if h % 5 else 1.0 * h, f"g{s % 2}")
            for s in range(4) for h in range(24 * days)]
    return spark.createDataFrame(rows, "station_name string, timestamp_utc timestamp_ntz, target_value double, y24 double, f double, grp string")


def test_walkforward_model_learns_each_fold_from_the_rows_before_it(spark):
    df = _series(spark, 20)
    limits = spark.createDataFrame([("STATION 0", 105.0)], "station_name string, threshold double")
    folds, scored = WF.walkforward_model(df, "y24", ["grp"], ["target_value", "f"], limits, min_train_days=10, step_days=4,
                                         max_iter=5, min_instances=2)
    rows = folds.orderBy("fold").collect()
    assert [r.fold for r in rows] == [1, 2, 3] and [r.train_rows for r in rows] == [960, 1344, 1728]
    assert all(r.train_end < r.forecast_origin_utc == r.test_start <= r.test_end and r.train_start == T0 for r in rows)
    # the change is one everywhere: the model knows it, persistence does not
    assert all(abs(r.persist_mae - 1) < 1e-9 and r.model_mae < 1e-6 and r.event_f1 == 1.0 for r in rows)
    assert scored.count() == sum(r.test_rows for r in rows)
    s = WF.walkforward_summary(folds).first()
    assert (s.folds, s.rows_scored) == (3, scored.count()) and abs(s.mean_model_vs_persist_rmse_gain - 1) < 1e-6
    none, empty = WF.walkforward_model(df, "y24", ["grp"], ["f"], limits, min_train_days=300, max_iter=2)
    assert none.count() == 0 and empty.count() == 0


def test_binned_features_have_a_bin_for_missing_values(spark):
    df = spark.createDataFrame([(1.0, None, "a"), (2.0, None, None), (None, None, "b"), (9.0, None, "a")], "x double, z double, c string")
    rows = WF.binned_features(df, ["c"], ["x", "z"], bins=4).collect()
    bins = {r.x: (r.features[1], r.features[2]) for r in rows}
    assert bins[None][0] > bins[9.0][0] >= bins[2.0][0] >= bins[1.0][0] and len({b[1] for b in bins.values()}) == 1
