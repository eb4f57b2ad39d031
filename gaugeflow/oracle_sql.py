"""DuckDB SQL text for the oracle side of the registered queries.

The stand-in CTEs below mirror ``gaugeflow.tables`` column for column, so
an oracle query sees exactly the rows the Spark query sees.
"""

from __future__ import annotations


def rnd(expr: str) -> str:
    """6-decimal rounding written out as round(x * 1e6) / 1e6 so that both
    engines round the same double the same way (half away from zero); a
    negative zero (from summation noise) is returned as zero."""
    r = f"(round(({expr}) * 1000000.0) / 1000000.0)"
    return f"(CASE WHEN {r} = 0 THEN 0.0 ELSE {r} END)"  # no negative zero


def coord(key: str, mult: int, modulus: int, base: float) -> str:
    return f"({base} + CAST(({key} * {mult}) % {modulus} AS DOUBLE) / 100.0)"


def lat(key: str) -> str:
    return coord(key, 7919, 600, 47.0)


def lon(key: str) -> str:
    return coord(key, 104729, 900, 6.0)


RAW_MEASUREMENTS = f"""
raw AS (
  SELECT 'S' || CAST(user_id AS VARCHAR) AS station_id,
         'STATION ' || CAST(user_id AS VARCHAR) AS station_name,
         'W' AS timeseries_name,
         date_trunc('hour', ts) AS timestamp_utc,
         CASE WHEN event_id % 7 = 0 THEN CAST(NULL AS DOUBLE) ELSE value * 5 - 100 END AS value,
         'cm' AS unit,
         {lat('user_id')} AS latitude,
         {lon('user_id')} AS longitude,
         ts AS ingestion_ts_utc,
         event_type AS source,
         sha256(CAST(event_id AS VARCHAR)) AS source_record_hash,
         'file:///events/' || event_type AS source_url
  FROM events
)"""

RAW_TYPE_MEASUREMENTS = """
raw_t AS (
  SELECT 'T_' || event_type AS station_id,
         upper(event_type) AS station_name,
         'W' AS timeseries_name,
         date_trunc('hour', ts) AS timestamp_utc,
         value AS value,
         'cm' AS unit,
         ts AS ingestion_ts_utc,
         sha256(CAST(event_id AS VARCHAR)) AS source_record_hash
  FROM events
)"""


def raw_weather(n: int = 20) -> str:
    sid = f"(user_id % {n} + user_id // {10 * n} * {n})"
    return f"""
raw_wx AS (
  SELECT 'D' || lpad(CAST({sid} AS VARCHAR), 5, '0') AS dwd_station_id,
         'WX ' || CAST({sid} AS VARCHAR) AS dwd_station_name,
         date_trunc('hour', ts) AS timestamp_utc,
         {lat(f'({sid} + 1000)')} AS latitude,
         {lon(f'({sid} + 1000)')} AS longitude,
         CASE WHEN event_id % 3 = 0 THEN CAST(NULL AS DOUBLE) ELSE value / 20 - 5 END AS temperature_c,
         CASE WHEN event_type = 'click' THEN value / 100 ELSE 0.0 END AS precipitation_mm,
         CASE WHEN event_id % 4 = 0 THEN CAST(NULL AS DOUBLE) ELSE value / 50 END AS wind_speed_ms,
         990.0 + value / 10 AS pressure_hpa,
         CASE WHEN event_id % 5 = 0 THEN CAST(NULL AS DOUBLE) ELSE value / 5 END AS relative_humidity_pct,
         ts AS ingestion_ts_utc,
         sha256(CAST(event_id AS VARCHAR)) AS source_record_hash
  FROM events
)"""


DEDUP = """
dedup AS (
  SELECT * FROM raw
  QUALIFY row_number() OVER (PARTITION BY station_id, timeseries_name, timestamp_utc
                             ORDER BY ingestion_ts_utc DESC, source_record_hash DESC) = 1
)"""

CURATED = """
curated AS (
  SELECT * REPLACE (TRY_CAST(value AS DOUBLE) AS value) FROM dedup
  WHERE TRY_CAST(value AS DOUBLE) IS NOT NULL AND TRY_CAST(value AS DOUBLE) BETWEEN -1000 AND 2000
)"""

WX_HOURLY = """
wx AS (
  SELECT * FROM raw_wx
  QUALIFY row_number() OVER (PARTITION BY dwd_station_id, timestamp_utc
                             ORDER BY ingestion_ts_utc DESC, source_record_hash DESC) = 1
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


GAUGE_FEATURES_COLS = f"""
  lag(value, 1) OVER w AS lag_1,
  lag(value, 3) OVER w AS lag_3,
  lag(value, 6) OVER w AS lag_6,
  value - lag(value, 1) OVER w AS diff_1,
  value - lag(value, 3) OVER w AS diff_3,
  {rnd("avg(value) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)")} AS rolling_mean_3,
  {rnd("stddev_samp(value) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)")} AS rolling_std_3,
  min(value) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS rolling_min_6,
  max(value) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS rolling_max_6"""

CALENDAR_COLS = """
  CAST(hour(timestamp_utc) AS INTEGER) AS hour_utc,
  CAST(dayofweek(timestamp_utc) + 1 AS INTEGER) AS day_of_week,
  CAST(month(timestamp_utc) AS INTEGER) AS month"""


def haversine(lat1: str, lon1: str, lat2: str, lon2: str, r: float = 6371.0) -> str:
    return (f"(2 * {r} * asin(sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))))")


GAUGE_FEATURES = f"""
gf AS (
  SELECT *, {GAUGE_FEATURES_COLS},
         {CALENDAR_COLS}
  FROM curated WHERE value IS NOT NULL
  WINDOW w AS (PARTITION BY station_name, timeseries_name ORDER BY timestamp_utc)
)"""


def name_bonus_case(g: str, s: str, pairs) -> str:
    parts = [f"WHEN regexp_matches(upper({g}), '{gp}') AND regexp_matches(upper({s}), '{sp}') THEN 1"
             for gp, sp in pairs]
    return "CAST(CASE " + " ".join(parts) + " ELSE 0 END AS BIGINT)"


def weather_map_ctes(pairs, max_km: float = 250.0) -> list[str]:
    """The rule of the map, gauge by gauge: an ordered list of the stations in
    reach (name bonus, distance, id), of which the first three count, with
    inverse-square weights that add up to one."""
    km = haversine("gauge.latitude", "gauge.longitude", "site.latitude", "site.longitude")
    slots = []
    for place, prefix in enumerate(("primary_", "backup1_", "backup2_"), 1):
        pick = f"chosen[{place}]"
        slots += [f"{pick}.id AS {prefix}dwd_station_id", f"{pick}.label AS {prefix}dwd_station_name",
                  f"{pick}.km AS {prefix}distance_km", f"-{pick}.minus_bonus AS {prefix}name_bonus",
                  f"weights[{place}] / list_sum(weights) AS {prefix}blend_weight"]
    return [
        f"""reach AS (
  SELECT gauge.station_id, min(gauge.station_name) AS station_name,
         list_sort(list({{'minus_bonus': -{name_bonus_case('gauge.station_name', 'site.dwd_station_name', pairs)},
                         'km': {km}, 'id': site.dwd_station_id, 'label': site.dwd_station_name}}))[1:3] AS chosen
  FROM (SELECT DISTINCT station_id, station_name, latitude, longitude FROM curated) gauge
  JOIN (SELECT DISTINCT dwd_station_id, dwd_station_name, latitude, longitude FROM raw_wx) site ON {km} <= {max_km}
  GROUP BY gauge.station_id)""",
        """wmap AS (
  SELECT station_id, station_name, """ + ", ".join(slots) + """, len(chosen) AS matched_station_count
  FROM (SELECT *, [CASE WHEN c.km = 0 THEN 1e9 ELSE 1.0 / (c.km * c.km) END FOR c IN chosen] AS weights FROM reach))""",
    ]


MEASURES = ("temperature_c", "precipitation_mm", "wind_speed_ms", "pressure_hpa", "relative_humidity_pct")


def weather_join_cte(src: str = "gf") -> str:
    """One long lookup: every gauge hour meets its up to three places' weather
    rows; each measure takes the first place that has it."""
    places = ((1, "p_", "primary"), (2, "b1_", "backup1"), (3, "b2_", "backup2"))
    at_place = ", ".join(f"max({m}) FILTER (WHERE place = {n}) AS {p}{m}" for n, p, _ in places for m in MEASURES)
    first = ", ".join(f"arg_min({m}, place) FILTER (WHERE {m} IS NOT NULL) AS {m}{tail}"
                      for tail in ("", "_blend") for m in MEASURES)
    named = " ".join(f"WHEN {n} THEN '{word}'" for n, _, word in places)
    listed = ", ".join(f"{word}_dwd_station_id" for *_, word in places)
    return f"""
seats AS (
  SELECT station_id, unnest([{listed}]) AS weather_id, unnest([1, 2, 3]) AS place FROM wmap),
lookup AS (
  SELECT seats.station_id AS at_station, wx.timestamp_utc AS at_hour,
         max(wx.timestamp_utc) FILTER (WHERE place = 1) AS weather_timestamp_utc, {at_place}, {first},
         CASE min(place) FILTER (WHERE temperature_c IS NOT NULL) {named} END AS weather_source_used
  FROM seats JOIN wx ON wx.dwd_station_id = seats.weather_id GROUP BY ALL),
wj AS (
  SELECT {src}.*, wmap.* EXCLUDE (station_id, station_name), lookup.* EXCLUDE (at_station, at_hour)
  FROM {src} LEFT JOIN wmap USING (station_id)
  LEFT JOIN lookup ON at_station = {src}.station_id AND at_hour = date_trunc('hour', {src}.timestamp_utc)
  WHERE {src}.timeseries_name = 'W'
)"""
