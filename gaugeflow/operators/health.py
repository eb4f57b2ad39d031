"""Run health, data quality and monitoring.

All inputs are audit tables (runs, stage events, DQ metrics, evaluations);
every query is an aggregate, so results are tiny while inputs may be large.
"Now" is always an argument so results are reproducible.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import hours_between
from .joins import with_params

# Status vocabularies of the source's monitoring views.
SUCCESS_STATUSES = ("success", "succeeded", "ok", "pass")
FAILED_STATUSES = ("failed", "failure", "error")
PASS_METRIC_STATUSES = ("pass", "passed", "success", "ok")
FAIL_METRIC_STATUSES = ("fail", "failed", "failure", "error")


def latest_by(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Newest row per key (``max_by`` over the whole row, a partial
    aggregate); with no keys, the newest row overall (none of an
    empty table)."""
    payload = F.struct(*[F.col(c) for c in df.columns])
    order = F.struct(F.col(ts), *[F.col(c) for c in df.columns if c != ts])
    return df.groupBy(*keys).agg(F.max_by(payload, order).alias("_row")).where(F.col("_row").isNotNull()).select("_row.*")


def daily_health(runs: DataFrame, ts: str = "started_at_utc", status: str = "status") -> DataFrame:
    """Per day: total runs, successful and failed by the status
    vocabulary (case-insensitive), average duration rounded to 2, and the
    maxima of rows ingested / predicted / stations processed."""
    s = F.lower(F.col(status))
    return runs.groupBy(F.to_date(ts).alias("execution_date")).agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(s.isin(list(SUCCESS_STATUSES))).alias("successful_runs"),
        F.count_if(s.isin(list(FAILED_STATUSES))).alias("failed_runs"),
        (F.round(F.avg("duration_seconds") * 100) / 100).alias("average_duration_seconds"),
        F.max("rows_ingested").alias("maximum_rows_ingested"),
        F.max("rows_predicted").alias("maximum_rows_predicted"),
        F.max("stations_processed").alias("maximum_stations_processed"))


def run_quality_summary(metrics: DataFrame, run: str = "run_id", status: str = "status",
                        name: str = "metric_name", ts: str = "measured_at_utc") -> DataFrame:
    """E5: per run: metric count, passed, failed, sorted names of failed
    metrics (nulls ignored), last measurement time."""
    s = F.lower(F.col(status))
    failed = s.isin(list(FAIL_METRIC_STATUSES))
    return metrics.groupBy(run).agg(
        F.count(F.lit(1)).alias("metric_count"),
        F.count_if(s.isin(list(PASS_METRIC_STATUSES))).alias("passed_metrics"),
        F.count_if(failed).alias("failed_metrics"),
        F.array_sort(F.collect_list(F.when(failed, F.col(name)))).alias("failed_metric_names"),
        F.max(ts).alias("last_measured_at_utc"))


def _metric_rows(rows: Sequence[Mapping[str, Column]]) -> Column:
    return F.explode(F.array(*[F.struct(*[v.alias(k) for k, v in r.items()]) for r in rows]))


def dq_training_input(df: DataFrame, split: str, required: Sequence[str], ts: str, now: str,
                      min_rows: int = 1000, max_missing_fraction: float = 0.20,
                      max_age_hours: float = 72.0, run_id: str = "run") -> DataFrame:
    """One aggregate pass over the training input, unpivoted to metric
    rows: row count (>= min), fraction of rows with any required column
    missing (1.0 when empty, <= max), and input age in hours (<= max).
    Each row has threshold, status (pass/fail) and JSON details."""
    incomplete = F.lit(False)
    for c in required:
        incomplete = incomplete | F.col(c).isNull()
    a = df.where(F.col("split_name") == split).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(incomplete).alias("bad"), F.max(ts).alias("mx"))
    frac = F.when(F.col("n") == 0, F.lit(1.0)).otherwise(F.col("bad") / F.col("n"))
    age = hours_between(F.lit(now).cast("timestamp"), F.col("mx"))
    details = F.to_json(F.struct(F.lit(split).alias("split_name"), F.col("n").alias("rows"),
                                 F.col("bad").alias("incomplete_rows")))
    rows = [
        {"metric_name": F.lit("training_row_count"), "metric_value": F.col("n").cast("double"),
         "threshold_value": F.lit(float(min_rows)), "ok": F.col("n") >= min_rows},
        {"metric_name": F.lit("training_missing_fraction"), "metric_value": frac,
         "threshold_value": F.lit(max_missing_fraction), "ok": frac <= max_missing_fraction},
        {"metric_name": F.lit("training_input_age_hours"), "metric_value": age,
         "threshold_value": F.lit(max_age_hours), "ok": F.coalesce(age <= max_age_hours, F.lit(False))},
    ]
    out = a.select(details.alias("details_json"), _metric_rows(rows).alias("_m"))
    return out.select(F.lit(run_id).alias("run_id"), "_m.metric_name", F.lit("training_input").alias("metric_scope"),
                      "_m.metric_value", "_m.threshold_value",
                      F.when(F.col("_m.ok"), "pass").otherwise("fail").alias("status"),
                      F.lit(now).cast("timestamp").alias("measured_at_utc"), "details_json")


def dq_predictions(preds: DataFrame, run_id: str, now: str, min_rows: int = 19,
                   station: str = "station_name", model: str = "model_version") -> DataFrame:
    """The run's prediction rows >= min, stations >= 1, exactly one model
    version; rows of other runs are not counted."""
    a = preds.where(F.col("run_id") == run_id).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(station).alias("stations"),
                  F.count_distinct(model).alias("models"))
    details = F.to_json(F.struct(F.col("n").alias("rows"), F.col("stations"), F.col("models")))
    rows = [
        {"metric_name": F.lit("prediction_row_count"), "metric_value": F.col("n").cast("double"),
         "threshold_value": F.lit(float(min_rows)), "ok": F.col("n") >= min_rows},
        {"metric_name": F.lit("prediction_station_count"), "metric_value": F.col("stations").cast("double"),
         "threshold_value": F.lit(1.0), "ok": F.col("stations") >= 1},
        {"metric_name": F.lit("prediction_model_versions"), "metric_value": F.col("models").cast("double"),
         "threshold_value": F.lit(1.0), "ok": F.col("models") == 1},
    ]
    out = a.select(details.alias("details_json"), _metric_rows(rows).alias("_m"))
    return out.select(F.lit(run_id).alias("run_id"), "_m.metric_name", F.lit("predictions").alias("metric_scope"),
                      "_m.metric_value", "_m.threshold_value",
                      F.when(F.col("_m.ok"), "pass").otherwise("fail").alias("status"),
                      F.lit(now).cast("timestamp").alias("measured_at_utc"), "details_json")


def dq_verdict(metrics: DataFrame, run: str = "run_id") -> DataFrame:
    """Per run: passed when every metric passed; sorted failures."""
    bad = F.lower(F.col("status")) != "pass"
    return metrics.groupBy(run).agg(
        (~F.bool_or(bad)).alias("passed"),
        F.array_sort(F.collect_list(F.when(bad, F.col("metric_name")))).alias("failed_metrics"))


def freshness(df: DataFrame, ts: str, required: Sequence[str], now: str, max_hours: float) -> DataFrame:
    """Newest time over complete rows, its age and whether it is fresh."""
    cond = F.lit(True)
    for c in required:
        cond = cond & F.col(c).isNotNull()
    a = df.where(cond).agg(F.max(ts).alias("latest_complete_ts"))
    age = hours_between(F.lit(now).cast("timestamp"), F.col("latest_complete_ts"))
    return a.select("latest_complete_ts", age.alias("age_hours"),
                    F.coalesce(age <= F.lit(max_hours), F.lit(False)).alias("is_fresh"))


def latest_pipeline_health(runs: DataFrame) -> DataFrame:
    """C8 view: newest run of every job, duration rounded to 2."""
    return latest_by(runs, ["job_type"], "started_at_utc").withColumn("duration_seconds", round2("duration_seconds"))


def latest_quality_health(metrics: DataFrame) -> DataFrame:
    """C8 view: newest value of every (metric, scope), rounded to 2."""
    out = latest_by(metrics, ["metric_name", "metric_scope"], "measured_at_utc")
    return out.withColumns({c: round2(c) for c in ("metric_value", "threshold_value")})


def latest_stage_health(stages: DataFrame) -> DataFrame:
    """C8 view: newest event of every stage, duration rounded to 2."""
    return latest_by(stages, ["stage_name"], "started_at_utc").withColumn("duration_seconds", round2("duration_seconds"))


def latest_evaluation_health(evaluations: DataFrame) -> DataFrame:
    """C8 view: newest evaluation of every (split, model), errors rounded to
    2, marked ``available``."""
    out = latest_by(evaluations, ["split_name", "model_version"], "evaluated_at_utc")
    return out.withColumns({c: round2(c) for c in ("mae", "rmse")}).withColumn("evaluation_status", F.lit("available"))


def round2(c: str) -> Column:
    return F.round(F.col(c) * 100) / 100


def _good(words: Sequence[str]) -> Column:
    return F.coalesce(F.lower(F.trim(F.col("status"))).isin(list(words)), F.lit(False))


CHECKS = ("pipeline_health", "data_quality_health", "stage_health")


def watchdog(runs: DataFrame, metrics: DataFrame, stages: DataFrame, evaluations: DataFrame, now: str,
             max_evaluation_age_hours: float = 840.0, max_mae: float = 999_999.0, max_rmse: float = 999_999.0,
             fail_on_missing_evaluation: bool = False) -> DataFrame:
    """One row for each check over the latest-health views.

    Jobs, metrics and stages pass when there is a row and the newest row of
    every one has a good status: running, unknown and null states fail, an old
    failure followed by a good run does not. The newest evaluation passes when
    its age and errors are within the limits, each of them only where known;
    no evaluation at all passes unless ``fail_on_missing_evaluation``.
    Columns: ``check_name``, ``status`` (pass or fail), ``reason`` (where rows
    are missing), ``checked``, ``failed``, ``age_hours``, ``mae``, ``rmse``.
    """
    def rows(view: DataFrame, name: str, words: Sequence[str]) -> DataFrame:
        none = None
        a = view.agg(F.count(F.lit(1)).alias("checked"), F.count_if(~_good(words)).alias("failed"))
        return a.select(F.lit(name).alias("check_name"),
                        F.when((F.col("checked") > 0) & (F.col("failed") == 0), "pass").otherwise("fail").alias("status"),
                        F.when(F.col("checked") == 0, f"no_{name.replace('data_', '')}_rows").alias("reason"),
                        "checked", "failed", *[F.lit(none).cast("double").alias(c) for c in ("age_hours", "mae", "rmse")])

    newest = latest_by(latest_evaluation_health(evaluations), [], "evaluated_at_utc")
    age = hours_between(F.lit(now).cast("timestamp"), F.col("evaluated_at_utc"))
    within = lambda c, most: c.isNull() | (c <= F.lit(float(most)))
    fine = within(age, max_evaluation_age_hours) & within(F.col("mae"), max_mae) & within(F.col("rmse"), max_rmse)
    e = newest.agg(F.count(F.lit(1)).alias("checked"), F.count_if(~fine).alias("failed"), F.max(age).alias("age_hours"),
                   F.max("mae").alias("mae"), F.max("rmse").alias("rmse"))
    missing = F.col("checked") == 0
    e = e.select(F.lit("validation_evaluation_health").alias("check_name"),
                 F.when(missing, "fail" if fail_on_missing_evaluation else "pass")
                  .when(F.col("failed") == 0, "pass").otherwise("fail").alias("status"),
                 F.when(missing, "no_evaluation_health_rows").alias("reason"), "checked", "failed", "age_hours", "mae", "rmse")
    return (rows(latest_pipeline_health(runs), CHECKS[0], SUCCESS_STATUSES)
            .unionByName(rows(latest_quality_health(metrics), CHECKS[1], PASS_METRIC_STATUSES))
            .unionByName(rows(latest_stage_health(stages), CHECKS[2], SUCCESS_STATUSES)).unionByName(e))


def system_status(runs: DataFrame, metrics: DataFrame, stages: DataFrame, evaluations: DataFrame) -> DataFrame:
    """One row. Jobs and stages are ``pass`` when the newest row of every
    one is good, else ``unknown``; data quality is judged on the run measured
    last (``fail`` with a failed metric, ``pass`` when all passed, else
    ``unknown``); an evaluation is ``available`` or ``unknown``. The system is
    ``ok`` when all four are good, otherwise ``degraded``."""
    def all_good(view: DataFrame, alias: str) -> DataFrame:
        return view.agg(F.when((F.count(F.lit(1)) > 0) & (F.count_if(~_good(SUCCESS_STATUSES)) == 0), "pass")
                        .otherwise("unknown").alias(alias))

    last = (run_quality_summary(metrics).orderBy(F.desc("last_measured_at_utc"), F.desc("run_id")).limit(1)
            .agg(F.max("run_id").alias("quality_run_id"), F.max("metric_count").alias("_n"),
                 F.max("passed_metrics").alias("_passed"), F.max("failed_metrics").alias("_failed")))
    quality = last.select("quality_run_id", F.when(F.col("_failed") > 0, "fail")
                          .when((F.col("_n") > 0) & (F.col("_passed") == F.col("_n")), "pass")
                          .otherwise("unknown").alias("data_quality_status"))
    evaluated = evaluations.limit(1).agg(F.when(F.count(F.lit(1)) > 0, "available").otherwise("unknown").alias("evaluation_status"))
    parts = [all_good(latest_pipeline_health(runs), "pipeline_status"), quality,
             all_good(latest_stage_health(stages), "stage_status"), evaluated]
    out = parts[0]
    for part in parts[1:]:  # one row each
        out = with_params(out, part)
    states = ["pipeline_status", "data_quality_status", "stage_status", "evaluation_status"]
    good = F.forall(F.array(*states), lambda x: x.isin("pass", "available"))
    return out.select(F.when(good, "ok").otherwise("degraded").alias("status"), *states, "quality_run_id")
