"""Configuration dimensions from YAML.

Config files are a few kilobytes; they are parsed on the driver and turned
into small DataFrames whose size is known when they are built, so joins
against them may broadcast.
"""

from __future__ import annotations

from typing import Any

import yaml
from pyspark.sql import DataFrame, SparkSession


def _load(text_or_path: str) -> Any:
    if "\n" in text_or_path or ":" in text_or_path.split("/")[-1]:
        return yaml.safe_load(text_or_path)
    with open(text_or_path, encoding="utf-8") as fh:
        return yaml.safe_load(fh)


def _num(v: Any) -> float | None:
    return None if v is None else float(v)


def thresholds_dim(spark: SparkSession, text_or_path: str) -> DataFrame:
    """``{station: threshold_cm}`` mapping (optionally under a top-level key)
    -> (station_name, threshold_cm)."""
    cfg = _load(text_or_path) or {}
    if len(cfg) == 1 and isinstance(next(iter(cfg.values())), dict):
        cfg = next(iter(cfg.values()))
    rows = [(str(k).strip().upper(), float(v)) for k, v in cfg.items() if v is not None]
    return spark.createDataFrame(rows, "station_name string, threshold_cm double")


def bands_dim(spark: SparkSession, text_or_path: str) -> DataFrame:
    """Operational bands -> one row per band with its list position as
    ``band_order``. Read are ``operational_thresholds: {NAME: {bands: [...]}}``
    with ``DEFAULT`` among the names, and a ``default`` list beside
    ``stations`` lists; a band has ``id, label, min_cm, max_cm, severity,
    color``. A text with neither raises."""
    cfg = _load(text_or_path) or {}
    rows = []
    known = ("operational_thresholds", "default", "default_bands", "stations", "station_bands")
    if not any(k in cfg for k in known):
        raise ValueError(f"no bands: none of {', '.join(known)} in the configuration")

    def add(name: str, bands: list) -> None:
        for i, b in enumerate(bands or [], start=1):
            rows.append((name, i, _num(b.get("min_cm")), _num(b.get("max_cm")), str(b.get("id")), b.get("label"),
                         b.get("severity"), b.get("color")))

    for station, entry in (cfg.get("operational_thresholds") or {}).items():
        add(str(station).strip().upper(), entry.get("bands") if isinstance(entry, dict) else entry)
    add("DEFAULT", cfg.get("default") or cfg.get("default_bands") or [])
    for station, bands in (cfg.get("stations") or cfg.get("station_bands") or {}).items():
        add(str(station).strip().upper(), bands)
    return spark.createDataFrame(rows, "station_name string, band_order int, min_cm double, max_cm double, "
                                       "band_id string, band_label string, severity string, color string")


def segments_dim(spark: SparkSession, text_or_path: str) -> DataFrame:
    """Segments with a decision gauge and support gauge(s) -> one row per
    (segment, station, role)."""
    cfg = _load(text_or_path) or {}
    segs = cfg.get("segments", cfg)
    rows = []
    for seg in segs if isinstance(segs, list) else [dict(v, id=k) for k, v in segs.items()]:
        sid, label = str(seg.get("id")), seg.get("label")
        dec = seg.get("decision_gauge")
        if dec:
            rows.append((sid, label, str(dec).strip().upper(), "decision"))
        sup = seg.get("support_gauge") or seg.get("support_gauges") or []
        for s in [sup] if isinstance(sup, str) else sup:
            rows.append((sid, label, str(s).strip().upper(), "support"))
    return spark.createDataFrame(rows, "segment_id string, segment_label string, station_name string, role string")
