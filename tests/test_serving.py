"""Serving rules: segment choice, forecast-time windows, risk from bands, refreshed history."""

from datetime import datetime

from gaugeflow.operators import joins as J
from gaugeflow.operators import metrics as MT
from gaugeflow.operators import serving as SV
from gaugeflow.plans.history import refresh_history

SEGMENTS = [("S1", "Upper Part", "A", "decision"), ("S1", "Upper Part", "B", "support"), ("S2", "Lower", "B", "decision")]
NOW = "2024-01-31 00:00:00"


def segments(spark):
    return spark.createDataFrame(SEGMENTS, "segment_id string, segment_label string, station_name string, role string")


def predictions(spark):
    t = datetime(2024, 1, 30)
    return spark.createDataFrame(
        [("a ", t, "production"), ("B", t, "production"), ("C", t, "production"), ("A", t, "test"),
         ("A", datetime(2023, 1, 1), "production"), (None, t, "production")],
        "station_name string, prediction_ready_utc timestamp, split_name string")


def names(df):
    return sorted((r.station_name or "-") for r in df.collect())


def test_history_takes_production_rows_and_segments_by_id_or_label(spark):
    p, s = predictions(spark), segments(spark)
    assert names(SV.history(p, NOW, 7, segments=s)) == ["-", "B", "C", "a "]
    assert names(SV.history(p, NOW, 7, segment="s1", segments=s)) == ["B", "a "]
    assert names(SV.history(p, NOW, 7, segment="LOWER", segments=s)) == ["B"]
    assert names(SV.history(p, NOW, 7, segment="nowhere", segments=s)) == ["-", "B", "C", "a "]
    assert names(SV.history(p, NOW, 7, station="A", segments=s)) == ["a "]


def test_stations_without_segment_get_empty_arrays(spark):
    got = {r.station_name: (r.segment_ids, r.is_decision_gauge)
           for r in J.attach_segments(predictions(spark), segments(spark)).collect()}
    assert got == {"a ": (["S1"], True), "A": (["S1"], True), "B": (["S1", "S2"], True), "C": ([], False), None: ([], False)}


def test_evaluation_windows_filter_the_forecast_time(spark):
    ev = spark.createDataFrame(
        [("Alpha", datetime(2024, 1, 30), datetime(2024, 1, 31), 2.0), ("Alpha", datetime(2023, 12, 1), datetime(2024, 1, 31), 9.0),
         ("Beta", datetime(2024, 1, 30), datetime(2023, 12, 1), 1.0)],
        "station_name string, forecast_timestamp_utc timestamp, evaluated_at_utc timestamp, error double")
    assert names(SV.evaluation_history(ev, NOW, 7)) == ["Alpha", "Beta"]
    assert names(SV.evaluation_history(ev, NOW, 7, station="LPH")) == ["Alpha"]
    assert {r.station_name: (r.n, r.mae) for r in MT.served_metrics(ev, NOW, 7).collect()} == {"Alpha": (1, 2.0), "Beta": (1, 1.0)}


def test_risk_comes_from_the_band_and_else_from_the_threshold(spark):
    bands = spark.createDataFrame(
        [("DEFAULT", 1, None, 80.0, "low", "Low", " Critical "), ("DEFAULT", 2, 81.0, 150.0, "mid", None, "warning"),
         ("DEFAULT", 3, 151.0, None, "ok", "OK", "normal")],
        "station_name string, band_order int, min_cm double, max_cm double, band_id string, band_label string, severity string")
    thresholds = spark.createDataFrame([("A", 80.2), ("B", 70.0)], "station_name string, threshold_cm double")
    rows = [("A", 80.0), ("A", 100.0), ("A", 200.0), ("A", 80.1), ("B", 80.5), ("C", 80.5), ("A", None)]
    facts = spark.createDataFrame(rows, "station_name string, prediction double")
    got = {(r.station_name, r.prediction): (r.band_label, r.severity, r.risk_level)
           for r in SV.operational_status(facts, bands, thresholds, "prediction").collect()}
    assert got == {
        ("A", 80.0): ("Low", "critical", "high"), ("A", 100.0): ("mid", "warning", "elevated"),
        ("A", 200.0): ("OK", "normal", "normal"), ("A", 80.1): ("High", "high", "high"),
        ("B", 80.5): ("Elevated", "elevated", "elevated"), ("C", 80.5): ("Unclassified", "unknown", "unknown"),
        ("A", None): ("Unknown", "unknown", "unknown")}


def test_history_refreshes_its_own_output(spark):
    def at(hour, day=1):
        return datetime(2024, 1, day, hour)

    def preds(*rows):
        return spark.createDataFrame(rows, "station_name string, forecast_timestamp_utc timestamp, model_version string, "
                                           "prediction_ready_utc timestamp, run_id string, prediction double")

    def actuals(*rows):
        return spark.createDataFrame(rows, "station_name string, actual_ts timestamp, actual_level double")

    def shown(df):
        return sorted((r.station_name or "-", r.forecast_timestamp_utc.hour, r.prediction, r.actual_if_available,
                       r.actual_available_now) for r in df.collect())

    legacy = spark.createDataFrame(
        [(None, at(1), "m", at(0), "r0", 1.0, 9.0, True), ("", at(2), "m", at(0), "r0", 2.0, None, False)],
        "station_name string, forecast_timestamp_utc timestamp, model_version string, prediction_ready_utc timestamp, "
        "run_id string, prediction double, actual_if_available double, actual_available_now boolean")
    first = refresh_history(legacy, preds(("A", at(5), "m", at(0), "r1", 5.0), ("A", at(6), "m", at(0), "r1", 6.0)),
                            actuals(("A", at(5), 50.0), ("", at(2), 20.0)))
    assert shown(first) == [("-", 1, 1.0, 9.0, True), ("A", 5, 5.0, 50.0, True)]
    second = refresh_history(first, preds(("A", at(6), "m", at(0), "r1", 6.0), ("A", at(5), "m", at(0), "r1", 5.0)),
                             actuals(("A", at(6), 60.0)))
    assert shown(second) == [("-", 1, 1.0, 9.0, True), ("A", 5, 5.0, 50.0, True), ("A", 6, 6.0, 60.0, True)]
    third = refresh_history(second, preds(), actuals(("A", at(5), 51.0)))
    assert [r[3] for r in shown(third)] == [9.0, 51.0, 60.0]
