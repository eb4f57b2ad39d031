"""Serving queries as DataFrame functions.

The source answers these through a REST layer with a post-filter in pandas;
here each is one DataFrame, so the segment filter, day window and station
match are part of the plan and reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import normalize_name, risk_level, severity_risk
from .joins import attach_segments, band_join, threshold_join, with_params


def latest_run(preds: DataFrame, segments: DataFrame, split: str = "production",
               ready: str = "prediction_ready_utc", run: str = "run_id") -> DataFrame:
    """Predictions of the newest run of a split, with segment arrays.
    The newest run id is a one-row aggregate (``max_by``), broadcast."""
    p = preds.where(F.col("split_name") == split)
    newest = p.agg(F.max_by(F.col(run), F.struct(F.col(ready), F.col(run))).alias("_run"))
    out = p.join(F.broadcast(newest), F.col(run) == F.col("_run"), "inner").drop("_run")
    return attach_segments(out, segments)


def _in_segment(df: DataFrame, segments: DataFrame, segment: str) -> DataFrame:
    """Rows whose station belongs to ``segment``, given by id or label in any
    case; all rows where no segment has that id or label."""
    wanted = segment.lower()
    members = (segments.where((F.lower("segment_id") == wanted) | (F.lower("segment_label") == wanted))
                       .select(normalize_name(F.col("station_name")).alias("_k")).distinct())
    known = members.agg((F.count(F.lit(1)) > 0).alias("_known"))
    joined = with_params(df, known).join(members, normalize_name(F.col("station_name")) == F.col("_k"), "left")
    return joined.where(~F.col("_known") | F.col("_k").isNotNull()).select(*df.columns)


def _named_like(df: DataFrame, station: str) -> DataFrame:
    """Rows whose station name contains ``station``, ignoring case."""
    return df.where(F.lower(F.col("station_name")).contains(station.lower()))


def history(preds: DataFrame, now: str, days: int, station: str | None = None, segment: str | None = None,
            segments: DataFrame | None = None, ready: str = "prediction_ready_utc",
            split: str = "production") -> DataFrame:
    """Prediction history of one split over the last ``days`` days before
    ``now``, optionally for stations whose name contains ``station`` (ignoring
    case) and/or that belong to ``segment`` (id or label, ignoring case; an
    unknown one filters nothing). With ``segments``, segment arrays are attached."""
    since = F.lit(now).cast(preds.schema[ready].dataType) - F.expr(f"INTERVAL {int(days)} DAYS")
    out = preds.where((F.col("split_name") == split) & (F.col(ready) >= since))
    if station:
        out = _named_like(out, station)
    if segments is None:
        return out
    return attach_segments(_in_segment(out, segments, segment) if segment else out, segments)


def stations(dim: DataFrame, segments: DataFrame) -> DataFrame:
    """Station list with their segments."""
    return attach_segments(dim, segments)


def segment_list(segments: DataFrame) -> DataFrame:
    """Segments with their decision and support gauges."""
    return segments.groupBy("segment_id", "segment_label").agg(
        F.min(F.when(F.col("role") == "decision", F.col("station_name"))).alias("decision_gauge"),
        F.array_sort(F.collect_list(F.when(F.col("role") == "support", F.col("station_name")))).alias("support_gauges"))


def evaluation_history(evals: DataFrame, now: str, days: int, station: str | None = None,
                       ts: str = "forecast_timestamp_utc") -> DataFrame:
    """Evaluations whose forecast time lies in the last ``days`` days,
    optionally for stations whose name contains ``station`` (ignoring case)."""
    since = F.lit(now).cast(evals.schema[ts].dataType) - F.expr(f"INTERVAL {int(days)} DAYS")
    out = evals.where(F.col(ts) >= since)
    return _named_like(out, station) if station else out


def primary_segment(segments: DataFrame) -> DataFrame:
    """Each station's primary segment: the one where it is the decision
    gauge, else the smallest segment id it belongs to."""
    seg = segments.withColumn("_key", normalize_name(F.col("station_name")))
    pick = seg.groupBy("_key").agg(F.min_by(F.col("segment_id"),
                                            F.struct((F.col("role") != "decision").alias("r"), F.col("segment_id")))
                                   .alias("primary_segment"))
    return pick


def operational_status(df: DataFrame, bands: DataFrame, thresholds: DataFrame, value: str) -> DataFrame:
    """Band, threshold and risk of ``value`` per row.

    A matched band gives label, severity and risk; without one the low-water
    threshold gives the risk, which then is label and severity too. Neither:
    ``Unclassified``; a null value: ``Unknown``; both with unknown severity
    and risk.
    """
    t = threshold_join(band_join(df, bands, value), thresholds)
    v = F.col(value)
    by_threshold = risk_level(value, "threshold_cm")
    banded = v.isNotNull() & F.col("band_id").isNotNull()
    severity = F.when(banded, F.coalesce(F.lower(F.trim("severity")), F.lit("unknown"))).otherwise(by_threshold)
    return t.withColumns({
        "band_label": (F.when(v.isNull(), "Unknown").when(banded, F.coalesce("band_label", "band_id"))
                       .when(F.col("threshold_cm").isNull(), "Unclassified").otherwise(F.initcap(by_threshold))),
        "severity": severity,
        "risk_level": F.when(banded, severity_risk(severity)).otherwise(by_threshold),
        "band_id": F.when(banded, F.col("band_id"))})


def risk_table(preds: DataFrame, bands: DataFrame, thresholds: DataFrame, segments: DataFrame,
               value: str = "prediction") -> DataFrame:
    """Per prediction: operational band, risk (the band's, else by the
    low-water threshold), and primary segment."""
    t = operational_status(preds, bands, thresholds, value)
    ps = primary_segment(segments)
    return t.join(ps, normalize_name(F.col("station_name")) == F.col("_key"), "left").drop("_key")


def risk_counts(risk: DataFrame, by: str = "risk_level") -> DataFrame:
    """Counts by risk level (or by primary segment)."""
    return risk.groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def forecast_series(hist: DataFrame, station: str, ts: str = "forecast_timestamp_utc") -> DataFrame:
    """Actual-vs-forecast long form for one station: one row per
    (time, series) with series 'forecast' or 'actual'."""
    s = hist.where(normalize_name(F.col("station_name")) == station.strip().upper())
    f = s.select(F.col(ts).alias("t"), F.lit("forecast").alias("series"), F.col("prediction").alias("value"))
    a = s.where(F.col("actual_value").isNotNull()).select(F.col(ts).alias("t"), F.lit("actual").alias("series"),
                                                          F.col("actual_value").alias("value"))
    return f.unionByName(a)


def station_map(dim: DataFrame, latest_preds: DataFrame, bands: DataFrame, thresholds: DataFrame,
                segments: DataFrame, segment: str | None = None) -> DataFrame:
    """Station coordinates with the latest prediction's band and risk,
    optionally only the stations of one segment."""
    newest = latest_preds.groupBy("station_name").agg(
        F.max(F.struct("forecast_timestamp_utc", "prediction")).alias("_p"))  # newest; larger value on a tie
    newest = newest.select("station_name", "_p.forecast_timestamp_utc", "_p.prediction")
    j = dim.join(newest, "station_name", "left")
    j = operational_status(j, bands, thresholds, "prediction")
    return _in_segment(j, segments, segment) if segment else j
