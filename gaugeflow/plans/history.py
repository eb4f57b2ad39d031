"""Prediction history maintenance (C4, C10, J3 batch form)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.asof import asof_nearest
from ..operators.dedup import dedupe_history

HISTORY_KEYS = ["station_name", "forecast_timestamp_utc", "model_version"]
#: Tasks that sort the history, for each shuffle partition: its rows are wide and sorted whole.
HISTORY_SPLIT = 4
HISTORY_ORDER = ["prediction_ready_utc", "run_id", "prediction", "actual_available_now"]


def with_actual_columns(df: DataFrame) -> DataFrame:
    """``actual_if_available`` and ``actual_available_now`` where they are
    missing; a null flag is false."""
    value = F.col("actual_if_available") if "actual_if_available" in df.columns else F.lit(None)
    flag = F.col("actual_available_now") if "actual_available_now" in df.columns else F.lit(False)
    return df.withColumns({"actual_if_available": value.cast("double"),
                           "actual_available_now": F.coalesce(flag, F.lit(False))})


def refresh_history(history: DataFrame, previous: DataFrame, actuals: DataFrame, tolerance_seconds: int = 1800,
                    actual_ts: str = "actual_ts", actual_value: str = "actual_level") -> DataFrame:
    """The stored history and the previous run's predictions, the newest
    prediction per (station, forecast time, model) (rows with a blank station
    pass through, C4), with the nearest actual within the tolerance (D5; ties
    -> earlier), else the actual stored before. Rows that have an actual now
    or had one stay, so the result can be the next run's ``history``.
    """
    stored = with_actual_columns(history).unionByName(with_actual_columns(previous), allowMissingColumns=True)
    tasks = HISTORY_SPLIT * int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stored = stored.repartition(tasks, *HISTORY_KEYS)  # the grouping below keeps this layout
    newest = dedupe_history(stored, HISTORY_KEYS, HISTORY_ORDER, "station_name")
    seen = actuals.where(F.trim("station_name") != "").select(  # a blank station matches nothing
        "station_name", F.col(actual_ts).alias("_seen_at"), F.col(actual_value).alias("_seen"))
    matched = asof_nearest(newest, seen, ["station_name"], "forecast_timestamp_utc", "_seen_at", tolerance_seconds,
                           ["_seen"], matched_ts_col="_matched_at", partitions=tasks)
    now = matched.withColumns({
        "actual_if_available": F.coalesce(F.col("_seen").cast("double"), "actual_if_available"),
        "actual_available_now": F.col("_seen").isNotNull() | F.col("actual_available_now")})
    return now.where("actual_available_now").select(*newest.columns)
