"""Evaluation of stored predictions.

Only matured predictions are matched: those whose forecast time has passed.
Production forecasts meet the nearest actual within a tolerance, other splits
the exact target of their newest run. Evaluations are merged idempotently:
running the job again replaces its rows instead of adding to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.asof import asof_nearest
from ..operators.dedup import latest_per_key, union_latest
from ..operators.joins import exact_actuals, with_params
from ..operators.metrics import event_metrics, regression_metrics
from ..session import ensure_checkpoint_dir

# The columns of an evaluation, and those that name it.
KEY_COLUMNS = ("split_name", "run_id", "station_name", "forecast_timestamp_utc", "model_version")
EVALUATION_COLUMNS = (
    "run_id", "model_version", "split_name", "station_name", "timeseries_name", "unit", "prediction_unit", "source",
    "timestamp_utc", "forecast_timestamp_utc", "prediction_ready_utc", "prediction_horizon_hours", "target_mode",
    "target_column", "prediction", "actual_value", "actual_available", "actual_timestamp_utc",
    "actual_match_tolerance_minutes", "error", "absolute_error", "squared_error", "ape", "threshold",
    "actual_event_low_water", "pred_event_low_water", "evaluated_at_utc")


def final_columns(df: DataFrame) -> DataFrame:
    """An evaluation's columns, as far as they are there."""
    return df.select(*[c for c in EVALUATION_COLUMNS if c in df.columns])


def matched_predictions(predictions: DataFrame, actuals: DataFrame, split_name: str, now: str,
                        tolerance_minutes: int = 30, target_column: str | None = None) -> DataFrame:
    """Matured predictions of a split with ``actual_value`` and
    ``actual_timestamp_utc``; those without an actual are left out.

    ``production``: ``actuals`` has station_name, timestamp_utc, value; of rows
    that share station and time the greatest value stands; the nearest within
    the tolerance is taken, the earlier of two as near. Other splits:
    ``actuals`` has split_name, station_name, timestamp_utc and the target
    column, unique per key; only the rows of the newest ``prediction_ready_utc``
    are evaluated.
    """
    kind = predictions.schema["forecast_timestamp_utc"].dataType
    p = predictions.where((F.col("split_name") == split_name) & F.col("station_name").isNotNull()
                          & F.col("forecast_timestamp_utc").isNotNull())
    if split_name != "production":
        newest = p.agg(F.max("prediction_ready_utc").alias("_ready"))
        p = with_params(p, newest).where(F.col("prediction_ready_utc") == F.col("_ready")).drop("_ready")
    p = p.where(F.col("forecast_timestamp_utc") <= F.lit(now).cast(kind)).drop("actual_value", "actual_timestamp_utc")
    if split_name == "production":
        known = actuals.select("station_name", "timestamp_utc", F.col("value").alias("actual_value")).dropna()
        known = latest_per_key(known, ["station_name", "timestamp_utc"], ["actual_value"])
        out = asof_nearest(p, known, ["station_name"], "forecast_timestamp_utc", "timestamp_utc", tolerance_minutes * 60,
                           ["actual_value"], matched_ts_col="actual_timestamp_utc")
    else:
        target = actuals.where(F.col("split_name") == split_name).select(
            "split_name", "station_name", F.col("timestamp_utc").alias("forecast_timestamp_utc"),
            F.col(target_column).alias("actual_value"))
        out = exact_actuals(p, target, ["split_name", "station_name", "forecast_timestamp_utc"])
        out = out.withColumn("actual_timestamp_utc", F.col("forecast_timestamp_utc"))
    return out.where(F.col("actual_value").isNotNull())


def evaluate_predictions(predictions: DataFrame, actuals: DataFrame, thresholds: DataFrame, split_name: str, now: str,
                         tolerance_minutes: int = 30, target_column: str | None = None) -> DataFrame:
    """The evaluation rows of one run of the job: errors (actual -
    prediction), APE where |actual| > 1e-9, threshold of the station (compared
    by trimmed upper-case name) and whether actual and prediction are
    low-water events, null without a threshold."""
    m = matched_predictions(predictions, actuals, split_name, now, tolerance_minutes, target_column)
    limits = thresholds.select(F.upper(F.trim("station_name")).alias("station_name"), F.col("threshold_cm").alias("threshold"))
    m = m.drop("threshold").withColumn("station_name", F.upper(F.trim("station_name"))).join(limits, "station_name", "left")
    error = F.col("actual_value") - F.col("prediction")
    event = lambda c: F.when(F.col("threshold").isNotNull(), F.col(c) <= F.col("threshold"))
    return final_columns(m.withColumns({
        "actual_available": F.lit(True), "actual_match_tolerance_minutes": F.lit(int(tolerance_minutes)),
        "error": error, "absolute_error": F.abs(error), "squared_error": error * error,
        "ape": F.when(F.abs("actual_value") > 1e-9, F.abs(error) / F.abs("actual_value")),
        "actual_event_low_water": event("actual_value"), "pred_event_low_water": event("prediction"),
        "evaluated_at_utc": F.lit(now).cast(predictions.schema["forecast_timestamp_utc"].dataType)}))


def merge_evaluations(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Stored and new evaluations, the newest of each key (then the latest
    forecast, the greatest prediction and actual)."""
    keys = [c for c in KEY_COLUMNS if c in new.columns]
    return union_latest(final_columns(existing), new, keys,
                        ["evaluated_at_utc", "forecast_timestamp_utc", "prediction", "actual_value"])


def evaluation_summary(existing: DataFrame, new: DataFrame, merged: DataFrame, split_name: str) -> DataFrame:
    """One row for a run of the job: metrics of the new rows, stations, rows
    added, rows held after the merge and duplicates that it removed."""
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    events = event_metrics(new).drop("event_rows", "tp", "fp", "fn")
    out = with_params(regression_metrics(new), events)
    for part in (new.agg(F.count_distinct("station_name").alias("stations_evaluated"), F.count(F.lit(1)).alias("new_evaluation_rows")),
                 n(existing, "_old"), n(merged, "total_evaluation_rows_after_merge")):
        out = with_params(out, part)
    removed = F.col("_old") + F.col("new_evaluation_rows") - F.col("total_evaluation_rows_after_merge")
    return out.withColumn("duplicate_rows_removed", removed).withColumn("split_name", F.lit(split_name)).drop("_old")


def evaluation_job(predictions: DataFrame, actuals: DataFrame, existing: DataFrame, thresholds: DataFrame, split_name: str,
                   now: str, tolerance_minutes: int = 30, target_column: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(merged evaluations, new evaluations, summary row) of one run."""
    new = evaluate_predictions(predictions, actuals, thresholds, split_name, now, tolerance_minutes, target_column)
    ensure_checkpoint_dir(new.sparkSession)
    new = new.checkpoint()  # merged, counted and scored
    merged = merge_evaluations(existing, new)
    return merged, new, evaluation_summary(existing, new, merged, split_name)
