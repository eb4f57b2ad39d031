"""Column -> Column helpers (section I of the inventory and the scalar parts
of B). All are built-in Spark expressions, so they stay inside whole-stage
codegen."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- casts

def safe_cast(col: str | Column, type_name: str) -> Column:
    """Bad values become null instead of raising (ANSI mode stays on)."""
    return _c(col).try_cast(type_name)


def round_half_away_to_long(col: str | Column) -> Column:
    """Float -> integer with rounding (half away from zero), as the source
    dialect's CAST(x AS INT64); Spark's cast would truncate."""
    return F.floor(F.abs(_c(col)) + F.lit(0.5)).cast("long") * F.signum(_c(col)).cast("long")


# ---------------------------------------------------------------- names

def normalize_name(col: str | Column, mode: str = "upper_trim") -> Column:
    """Station-name keys.

    * ``upper_trim``: upper case, outer blanks removed;
    * ``dash``: upper_trim, spaces to ``-``;
    * ``dash_slash``: upper_trim, spaces and ``/`` to ``-``;
    * ``ascii``: upper case, umlauts folded (Ä->AE, Ö->OE, Ü->UE, ß->SS),
      other accents stripped, runs of non-alphanumerics to one ``-``,
      leading/trailing ``-`` removed;
    * ``compact``: ``ascii`` with the dashes removed.
    """
    c = F.upper(F.trim(_c(col)))
    if mode == "upper_trim":
        return c
    if mode == "dash":
        return F.regexp_replace(c, " ", "-")
    if mode == "dash_slash":
        return F.regexp_replace(c, "[ /]", "-")
    if mode in ("ascii", "compact"):
        a = F.replace(F.replace(F.replace(F.replace(c, F.lit("Ä"), F.lit("AE")), F.lit("Ö"), F.lit("OE")),
                                F.lit("Ü"), F.lit("UE")), F.lit("ß"), F.lit("SS"))
        a = F.replace(a, F.lit("ẞ"), F.lit("SS"))
        a = F.translate(a, "ÀÁÂÃÅÈÉÊËÌÍÎÏÒÓÔÕØÙÚÛÝÇÑ", "AAAAAEEEEIIIIOOOOOUUUYCN")
        a = F.regexp_replace(a, "[^A-Z0-9]+", "-")
        a = F.regexp_replace(a, "^-+|-+$", "")
        return F.regexp_replace(a, "-", "") if mode == "compact" else a
    raise ValueError(f"unknown mode {mode}")


def umlaut_variants(col: str | Column) -> Column:
    """Array of the upper-cased name and its spellings with OE as Ö, UE as Ü
    and AE as Ä, each replaced alone (B12)."""
    c = F.upper(_c(col))
    return F.array_distinct(F.array(c, *[F.replace(c, F.lit(a), F.lit(b)) for a, b in (("OE", "Ö"), ("UE", "Ü"), ("AE", "Ä"))]))


def pad_id(col: str | Column, width: int = 5) -> Column:
    """Trim and left-pad with zeros; longer ids are kept whole (Spark's
    ``lpad`` alone would cut them)."""
    t = F.trim(_c(col).cast("string"))
    return F.when(F.length(t) >= width, t).otherwise(F.lpad(t, width, "0"))


# ---------------------------------------------------------------- time

def floor_time(col: str | Column, unit: str = "hour") -> Column:
    """Truncate to second / minute / hour / day."""
    return F.date_trunc(unit, _c(col))


def parse_hour_stamp(col: str | Column) -> Column:
    """``yyyyMMddHH`` text -> timestamp; bad text -> null."""
    return F.try_to_timestamp(_c(col).cast("string"), F.lit("yyyyMMddHH"))


def parse_any_timestamp(col: str | Column, formats: Sequence[str]) -> Column:
    """First format that parses wins; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(_c(col), F.lit(f)) for f in formats])


def local_to_utc(col: str | Column, tz: str, policy: str = "archive") -> Column:
    """Wall-clock time in ``tz`` -> UTC instant.

    ``policy="zone_default"`` is Spark's ``to_utc_timestamp``.
    ``policy="archive"``: an ambiguous wall time (autumn) is read as standard
    time, i.e. the later instant; a wall time inside the spring gap is
    shifted forward to the first valid instant. Valid for zones whose
    offset changes by one hour on the hour.
    """
    local = _c(col).cast("timestamp")
    u = F.to_utc_timestamp(local, tz)
    if policy == "zone_default":
        return u
    u2 = u + F.expr("INTERVAL 1 HOUR")
    return (F.when(F.from_utc_timestamp(u2, tz) == local, u2)
             .when(F.from_utc_timestamp(u, tz) != local, F.date_trunc("hour", u))
             .otherwise(u))


def hours_between(later: str | Column, earlier: str | Column) -> Column:
    """Age in hours between two timestamps (double)."""
    return (F.unix_micros(_c(later).cast("timestamp")) - F.unix_micros(_c(earlier).cast("timestamp"))) / F.lit(3.6e9)


# ---------------------------------------------------------------- geo

def haversine_km(lat1: str | Column, lon1: str | Column, lat2: str | Column, lon2: str | Column,
                 radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = p2 - p1
    dl = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2.0 * radius_km) * F.asin(F.sqrt(a))


def max_lon_delta_deg(lat: str | Column, max_km: float | Column, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Largest longitude difference (degrees) of any point within
    ``max_km`` of a point at ``lat``; 180 near the poles."""
    ang = (max_km if isinstance(max_km, Column) else F.lit(float(max_km))) / radius_km
    s = F.sin(ang) / F.cos(F.radians(_c(lat)))
    return F.when(F.abs(_c(lat)) + F.degrees(ang) >= 89.999, F.lit(180.0)) \
            .when(s >= 1.0, F.lit(180.0)) \
            .otherwise(F.degrees(F.asin(s)))


# ---------------------------------------------------------------- hashing

def record_hash(cols: Sequence[str]) -> Column:
    """SHA-256 of the record as JSON with keys in sorted order and null
    values kept."""
    ordered = sorted(cols)
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in ordered]),
                            {"ignoreNullFields": "false"}), 256)


def short_id(parts: Sequence[str | Column], length: int = 12) -> Column:
    """SHA-256 hex prefix of the ``|``-joined parts (run / model ids)."""
    return F.left(F.sha2(F.concat_ws("|", *[_c(p).cast("string") for p in parts]), 256), F.lit(length))


# ---------------------------------------------------------------- labels

def risk_level(value: str | Column, threshold: str | Column, elevated_margin: float = 20.0) -> Column:
    """High at or below threshold, elevated up to threshold + margin,
    normal above; unknown when either side is null."""
    v, t = _c(value), _c(threshold)
    return (F.when(v.isNull() | t.isNull(), F.lit("unknown"))
             .when(v <= t, F.lit("high"))
             .when(v <= t + F.lit(elevated_margin), F.lit("elevated"))
             .otherwise(F.lit("normal")))


def severity_risk(severity: str | Column) -> Column:
    """Risk of a band's severity: normal; warning and elevated are
    elevated; every other word is high."""
    s = _c(severity)
    return (F.when(s == "normal", F.lit("normal"))
             .when(s.isin("warning", "elevated"), F.lit("elevated"))
             .otherwise(F.lit("high")))


def any_at_or_below(cols: Sequence[str | Column], threshold: float | Column) -> Column:
    """1 when any column is <= threshold (nulls count as false), else 0."""
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.greatest(*[F.coalesce(_c(c) <= t, F.lit(False)) for c in cols]).cast("int")
