"""Ingest and audit compositions.

Each returns DataFrames; writing them (append / overwrite / upsert target) is
left to the caller through ``sources.sinks`` so a plan stays lazy and
Catalyst sees it whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggs import coalesce_by_key, gap_summary, observed_coverage, station_status, variable_map
from ..operators.clean import date_window, eligible_groups, from_marks_on, high_water_marks, newer_than_table
from ..operators.dedup import latest_per_key, upsert
from ..operators.joins import attach_metadata, outer_delta
from ..sources.readers import (CANONICAL_MEASURES, FILE_NAME, canonical_measures, family_from_path, normalize_archive,
                               prune_files, read_archive_csv, read_product_zip, read_station_payload)
from ..session import ensure_checkpoint_dir
from .fill import VARIABLE_COLUMNS, apply_fill, proxy_candidates, proxy_fill, station_variables

GAUGE_KEYS = ["station_id", "timeseries_name", "timestamp_utc"]
GAUGE_ORDER = ["ingestion_ts_utc", "source_record_hash"]


def gauge_ingest(spark: SparkSession, payload_path: str, target: DataFrame | None,
                 ingestion_ts: str | None = None, mode: str = "incremental") -> DataFrame:
    """Station JSON (A1, hashed) -> newest row per key (C2) -> upsert
    into the target (C3; no target = bootstrap).

    ``incremental`` takes the rows at or after the target's high-water mark of
    their own series (B14); ``backfill`` ignores the marks and takes all rows.
    """
    if mode not in ("incremental", "backfill"):
        raise ValueError(f"unknown ingest mode: {mode}")
    rows = read_station_payload(spark, payload_path, ingestion_ts=ingestion_ts)
    rows = latest_per_key(rows, GAUGE_KEYS, GAUGE_ORDER)
    if target is None:
        return rows
    if mode == "incremental":
        series = ["station_id", "timeseries_name"]
        rows = from_marks_on(rows, series, "timestamp_utc", high_water_marks(target, series, "timestamp_utc"))
    return upsert(target, rows, GAUGE_KEYS, GAUGE_ORDER)


def archive_backfill(spark: SparkSession, csv_path: str, target: DataFrame, start: str, end: str,
                     tz: str = "Europe/Berlin", station_from_path: str = r"station_id=([^/]+)/",
                     ingestion_ts: str | None = None, end_cap: str | None = None) -> DataFrame:
    """Archive CSV (A2, local -> UTC) -> normalised rows (A3) -> date
    window (B13) -> newest per key (C2) -> upsert into the target (C3)."""
    parsed = read_archive_csv(spark, csv_path, tz)
    sid = F.regexp_extract("source_file", station_from_path, 1)
    rows = normalize_archive(parsed, sid, sid, source_url=F.col("source_file"), ingestion_ts=ingestion_ts,
                             ts_col="timestamp_utc", value_col="value")
    rows = date_window(rows, "timestamp_utc", start, end, end_cap)
    rows = latest_per_key(rows, GAUGE_KEYS, GAUGE_ORDER)
    ensure_checkpoint_dir(spark)
    rows = rows.select(*[c for c in target.columns if c in rows.columns]).checkpoint()  # the upsert reads it three times
    return upsert(target, rows, GAUGE_KEYS)


def weather_ingest(spark: SparkSession, zip_root: str, stations_meta: DataFrame, start_date: str | None = None,
                   ids: Sequence[str] | None = None, high_water_mark: DataFrame | None = None,
                   min_complete_ratio: float = 0.80, min_rows: int = 5000, max_proxy_km: float = 175.0,
                   k: int = 3, ingestion_ts: str | None = None) -> dict[str, DataFrame]:
    """Product zips (A4, pruned by file name A6) -> canonical rows per
    family (B5, B6, B8) -> one row per (station, hour) with the first
    non-null of each measure (E6) -> newer than the mark (B14) -> eligible
    stations (B18: enough rows with all five measures, and a large enough share
    of such rows) -> coordinates (D10) -> gaps before (E8) -> proxy fill
    (D14 + L9) -> gaps after (E8) and their delta (E9).

    Returns ``{"observations", "fills", "gaps_before", "gaps_after",
    "gap_delta"}``."""
    flt = prune_files(F.col(FILE_NAME), start_date=start_date, ids=ids)
    raw = read_product_zip(spark, zip_root, file_filter=flt)
    canon = canonical_measures(raw.withColumn("_family", family_from_path(F.col("path"))), F.col("_family"),
                               ingestion_ts=ingestion_ts)
    hourly = coalesce_by_key(canon.where(F.col("timestamp_utc").isNotNull()), ["dwd_station_id", "timestamp_utc"],
                             list(CANONICAL_MEASURES), "ingestion_ts_utc",
                             ["quality_flag", "source", "source_url", "source_record_hash", "ingestion_ts_utc"])
    if high_water_mark is not None:
        hourly = newer_than_table(hourly, "timestamp_utc", high_water_mark, high_water_mark.columns[0])
    ensure_checkpoint_dir(spark)
    hourly = hourly.checkpoint()  # every step below reads it, some twice: the archives are opened and parsed once
    hourly = eligible_groups(hourly, "dwd_station_id", list(CANONICAL_MEASURES), min_complete_ratio, min_rows)
    meta = stations_meta.select(F.col("station_id").alias("dwd_station_id"), "latitude", "longitude")
    hourly = attach_metadata(hourly, meta, "dwd_station_id")
    ms = list(CANONICAL_MEASURES)
    before = gap_summary(hourly, "dwd_station_id", ms, "before_fill")
    cands = proxy_candidates(meta, station_variables(hourly), max_km=max_proxy_km, k=k)
    fills = proxy_fill(hourly, cands)
    filled = apply_fill(hourly, fills)
    after = gap_summary(filled, "dwd_station_id", ms, "after_fill")
    cols = ["rows_with_any_gap", "complete_rows", *[f"{m}_missing" for m in ms]]
    return {"observations": filled, "fills": fills, "gaps_before": before, "gaps_after": after,
            "gap_delta": outer_delta(before, after, "dwd_station_id", cols)}


def station_audit(coverage_rel: DataFrame, obs: DataFrame, roles: DataFrame | None = None,
                  core: float = 0.8, partial: float = 0.4, families: Sequence[str] = tuple(VARIABLE_COLUMNS),
                  key: str = "dwd_station_id", ts: str = "timestamp_utc") -> DataFrame:
    """Variable map (E11) left-joined with observed coverage (E7), then
    core / partial / drop status (E12) from the all-measures ratio."""
    vm = variable_map(coverage_rel, key, "variable", list(families), roles)
    cov = observed_coverage(obs, key, ts, list(CANONICAL_MEASURES))
    return station_status(vm.join(cov, key, "left"), "all_measures_ratio",
                          role_col="role" if roles is not None else None, core=core, partial=partial)
