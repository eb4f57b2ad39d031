"""Feature and label compositions.

Each function declares its window features once and evaluates them with one
partition/order spec. By default the skew-safe chunked plan of
``with_series_features`` is used (chunks of ``DEFAULT_CHUNK_ROWS`` rows per
series); ``chunk_rows=None`` selects the plain one-shuffle window for inputs
known to have no hot series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import any_at_or_below
from ..operators import windows as W
from ..operators.aggs import segment_agg
from ..operators.clean import curate, drop_sparse_rows
from ..operators.dedup import latest_per_key

GAUGE_KEYS = ("station_name", "timeseries_name")
TS = "timestamp_utc"

# Feature lists of the source's feature scripts.
GAUGE_LAGS = (1, 3, 6)
GAUGE_DIFFS = (1, 3)
GAUGE_ROLLING = ((3, "mean"), (3, "std"), (6, "min"), (6, "max"))
WEATHER_LAGS = {
    "temperature_c": ("temp", (1, 3, 6, 12)),
    "precipitation_mm": ("precip", (1, 3, 6, 12)),
    "wind_speed_ms": ("wind", (1, 3, 6)),
    "pressure_hpa": ("pressure", (1, 3)),
    "relative_humidity_pct": ("humidity", (1,)),
}
WEATHER_ROLLING = {
    "temperature_c": ("temp", ((3, "mean"), (6, "mean"), (12, "mean"))),
    "precipitation_mm": ("precip", ((6, "mean"), (12, "mean"), (6, "sum"), (12, "sum"), (24, "sum"))),
    "wind_speed_ms": ("wind", ((6, "mean"), (12, "mean"))),
    "pressure_hpa": ("pressure", ((6, "mean"), (12, "mean"))),
    "relative_humidity_pct": ("humidity", ((6, "mean"), (12, "mean"))),
}
LOW_WATER_LEADS = (1, 3, 6, 12, 24, 36, 48, 60, 72)


def gauge_feature_list(value: str = "value") -> list[W.Feature]:
    """L1's window features: lags 1/3/6, diffs 1/3, rolling mean/std over 3
    and min/max over 6 previous rows."""
    feats = W.lags(value, GAUGE_LAGS) + W.diffs(value, GAUGE_DIFFS)
    names = {"mean": "rolling_mean", "std": "rolling_std", "min": "rolling_min", "max": "rolling_max"}
    feats += [W.rolling_feature(value, n, fn, f"{names[fn]}_{n}") for n, fn in GAUGE_ROLLING]
    return feats


def gauge_features(curated: DataFrame, keys: Sequence[str] = GAUGE_KEYS, ts: str = TS,
                   value: str = "value", chunk_rows: int | None = W.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """L1: gauge time-series features + calendar columns on rows with a value."""
    base = curated.where(F.col(value).isNotNull())
    out = W.with_series_features(base, keys, [ts], gauge_feature_list(value), chunk_rows=chunk_rows)
    return W.calendar_features(out, ts)


def weather_feature_list(precip_accel_long_minus_short: bool = True) -> list[W.Feature]:
    """L4's weather lags, trailing means/sums, deltas and trends."""
    feats: list[W.Feature] = []
    for col, (short, ks) in WEATHER_LAGS.items():
        feats += W.lags(col, ks, prefix=f"{short}_lag_")
    for col, (short, specs) in WEATHER_ROLLING.items():
        feats += [W.rolling_feature(col, n, fn, f"{short}_roll_{fn}_{n}") for n, fn in specs]
    feats += [W.diff_feature("pressure_hpa", 1, "pressure_delta_1"),
              W.diff_feature("pressure_hpa", 3, "pressure_delta_3"),
              W.lag_change_feature("temperature_c", 1, 3, "temp_change_1_3"),
              W.rolling_sum_change_feature("precipitation_mm", 24, 12, "precip_accel_12_24",
                                           long_minus_short=precip_accel_long_minus_short)]
    return feats


def weather_enriched(joined: DataFrame, keys: Sequence[str] = ("station_id",), ts: str = TS,
                     chunk_rows: int | None = W.DEFAULT_CHUNK_ROWS, precip_accel_long_minus_short: bool = True) -> DataFrame:
    """L4: weather lag / rolling / delta / trend features per station."""
    return W.with_series_features(joined, keys, [ts], weather_feature_list(precip_accel_long_minus_short),
                                  chunk_rows=chunk_rows)


def supervised_24h(joined: DataFrame, keys: Sequence[str] = ("station_id",), ts: str = TS,
                   value: str = "value", horizon_rows: int = 24, chunk_rows: int | None = W.DEFAULT_CHUNK_ROWS,
                   precip_accel_long_minus_short: bool = False) -> DataFrame:
    """Gauge + weather features and the 24-row-ahead label, all from ONE
    window spec (the source recomputes them in two scripts)."""
    feats = gauge_feature_list(value) + weather_feature_list(precip_accel_long_minus_short)
    feats.append(W.lead_feature(value, horizon_rows, f"target_value_t_plus_{horizon_rows}h"))
    out = W.with_series_features(joined.where(F.col(value).isNotNull()), keys, [ts], feats,
                                 chunk_rows=chunk_rows)
    return W.calendar_features(out, ts).withColumnRenamed(value, "target_value")


def supervised_72h(curated: DataFrame, threshold: float, keys: Sequence[str] = GAUGE_KEYS,
                   ts: str = TS, value: str = "value", leads: Sequence[int] = LOW_WATER_LEADS,
                   chunk_rows: int | None = W.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Leads over 72 rows and a low-water flag: 1 when any lead is at or
    below ``threshold`` (missing leads count as not low)."""
    out = W.with_series_features(curated.where(F.col(value).isNotNull()), keys, [ts],
                                 W.leads(value, leads), chunk_rows=chunk_rows)
    return out.withColumn("target_low_water_72h", any_at_or_below([f"lead_{k}" for k in leads], threshold))


def low_water_events(df: DataFrame, thresholds: DataFrame, name_col: str = "station_name",
                     value: str = "value", threshold_col: str = "threshold_cm") -> DataFrame:
    """``low_water_label`` = 1 when the value is at or below the
    station's threshold, 0 otherwise or when the station has none.

    Thresholds have one row per station; the planner picks the join by size."""
    t = thresholds.select(F.col(name_col).alias("_tname"), F.col(threshold_col).alias("_thr"))
    out = df.join(t, F.col(name_col) == F.col("_tname"), "left")
    lab = F.when(F.col("_thr").isNotNull() & (F.col(value) <= F.col("_thr")), 1).otherwise(0)
    return out.withColumn("low_water_label", lab).drop("_tname", "_thr")


def segment_labels_24h(series: DataFrame, segments: DataFrame, thresholds: DataFrame, name_col: str = "station_name",
                       ts: str = "timestamp_utc", value: str = "value", threshold_col: str = "threshold_cm") -> DataFrame:
    """Per (segment, time) the least, greatest and mean level over the
    segment's decision and support gauges, rounded to 2, their number, and
    ``target_low_water_24h`` = 1 when the (unrounded) least level is at or
    below the segment's threshold: that of its decision gauge. A segment
    without one is never low. Times are given to the minute, as text.

    ``segments``: segment_id, station_name, role. A gauge counts in every
    segment that it belongs to, once.
    """
    member = segments.select("segment_id", F.col(name_col).alias("_name")).distinct()
    levels = segment_agg(series.join(member, F.col(name_col) == F.col("_name")), ["segment_id", ts], value)
    own = segments.where(F.col("role") == "decision").select("segment_id", F.col(name_col).alias("_gauge"))
    limits = (own.join(thresholds.select(F.col(name_col).alias("_tname"), threshold_col), F.col("_gauge") == F.col("_tname"))
                 .groupBy("segment_id").agg(F.min(threshold_col).alias("_limit")))
    two = lambda c: F.round(F.col(c) * 100) / 100
    low = F.when(F.col("_limit").isNotNull() & (F.col("min_value") <= F.col("_limit")), 1).otherwise(0)
    return levels.join(limits, "segment_id", "left").select(
        "segment_id", F.date_format(ts, "yyyy-MM-dd HH:mm").alias("timestamp_utc"), two("min_value").alias("segment_min_waterlevel"),
        two("max_value").alias("segment_max_waterlevel"), two("avg_value").alias("segment_avg_waterlevel"),
        F.col("value_count").alias("segment_count"), low.alias("target_low_water_24h"))


def flagship(raw: DataFrame, chunk_rows: int | None = W.DEFAULT_CHUNK_ROWS, horizon_rows: int = 24,
             max_null_fraction: float = 0.35) -> DataFrame:
    """Minimum slice: dedup (newest ingestion, then highest hash) -> curate
    -> gauge features -> 24-row lead label -> drop sparse rows."""
    dedup = latest_per_key(raw, ["station_id", "timeseries_name", TS],
                           ["ingestion_ts_utc", "source_record_hash"])
    cur = curate(dedup)
    feats = gauge_feature_list("value") + [W.lead_feature("value", horizon_rows, "target_value_t_plus_24h")]
    out = W.with_series_features(cur, list(GAUGE_KEYS), [TS], feats, chunk_rows=chunk_rows)
    out = W.calendar_features(out, TS)
    feature_cols = [f.name for f in gauge_feature_list("value")]
    return drop_sparse_rows(out.where(F.col("target_value_t_plus_24h").isNotNull()),
                            feature_cols, max_null_fraction)
