"""Gauge -> weather station map (L2) and the weather join (L3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggs import pivot_rank
from ..operators.joins import nearest_k, ranked_fallback_join
from ..operators.windows import share_of_total, top_k_per_group
from ..session import ensure_checkpoint_dir

# Fixed values: (gauge-name pattern, weather-station-name pattern) pairs that
# earn a name bonus of 1, in the source's order.
NAME_BONUS_PAIRS = (
    ("KÖLN|KOELN|COLOGNE", "KÖLN|KOELN|COLOGNE"),
    ("MAINZ", "MAINZ"),
    ("MANNHEIM", "MANNHEIM"),
    ("KOBLENZ", "KOBLENZ|BENDORF"),
    ("BONN", "BONN|KÖNIGSWINTER|KOENIGSWINTER"),
    ("DUISBURG|RUHRORT", "DUISBURG|ESSEN"),
    ("EMMERICH|REES|WESEL", "WESEL|EMMERICH|DÜSSELDORF|DUESSELDORF"),
    ("BASEL|RHEINWEILER|BREISACH|RUST|OTTENHEIM|KEHL|IFFEZHEIM|MAXAU|PHILIPPSBURG|PLITTERSDORF|SPEYER|WORMS",
     "KARLSRUHE|MANNHEIM|FREIBURG|OFFENBURG|BASEL|KONSTANZ"),
    ("KONSTANZ", "KONSTANZ"),
)
WEATHER_MEASURES = ("temperature_c", "precipitation_mm", "wind_speed_ms", "pressure_hpa", "relative_humidity_pct")
RANK_PREFIXES = ("primary_", "backup1_", "backup2_")
ZERO_DISTANCE_WEIGHT = 1e9


def with_pattern(df: DataFrame, name: str, side: int, pairs=NAME_BONUS_PAIRS) -> DataFrame:
    """Rows with each pair of patterns whose ``side`` their name matches."""
    upper = F.upper(F.col(name))
    fits = F.array(*[F.when(upper.rlike(pair[side]), F.lit(i)) for i, pair in enumerate(pairs)])
    return df.withColumn("_pattern", F.explode(F.array_compact(fits)))


def weather_map(gauges: DataFrame, stations: DataFrame, max_km: float = 250.0, k: int = 3,
                radius_km: float = 6371.0) -> DataFrame:
    """L2: for each gauge, its k best weather stations within ``max_km``:
    ranked by name bonus (desc), distance, station id; inverse-square
    weights (distance 0 -> 1e9) normalised per gauge; pivoted to primary /
    backup1 / backup2 columns with the matched count.

    ``gauges``: station_id, station_name, latitude, longitude.
    ``stations``: dwd_station_id, dwd_station_name, latitude, longitude.
    """
    g = gauges.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()) \
              .select("station_id", "station_name", "latitude", "longitude").distinct()
    s = stations.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()) \
                .select("dwd_station_id", "dwd_station_name",
                        F.col("latitude").alias("_slat"), F.col("longitude").alias("_slon")).distinct()
    # both have one row a station and come from whole fact tables: written once, as the search reads them several times
    ensure_checkpoint_dir(g.sparkSession)
    g, s = g.checkpoint(), s.checkpoint()
    at = dict(k=k, max_km=max_km, right_cols=("_slat", "_slon"), radius_km=radius_km)
    near = nearest_k(g, s, "station_id", "dwd_station_id", **at).withColumn("name_bonus", F.lit(0).cast("long"))
    # the best k by (bonus, distance) are among the k nearest of all and the k nearest that share a name pattern
    named = nearest_k(with_pattern(g, "station_name", 0), with_pattern(s, "dwd_station_name", 1), "station_id",
                      "dwd_station_id", on=["_pattern"], **at).drop("_pattern").withColumn("name_bonus", F.lit(1).cast("long"))
    both = near.unionByName(named).groupBy(*near.drop("name_bonus").columns).agg(F.max("name_bonus").alias("name_bonus"))
    top = top_k_per_group(both, ["station_id"],
                          [F.col("name_bonus").desc(), F.col("distance_km").asc(), F.col("dwd_station_id").asc()],
                          k, rank_col="station_rank")
    weighted = top.withColumn("raw_weight", F.when(F.col("distance_km") == 0, F.lit(ZERO_DISTANCE_WEIGHT))
                              .otherwise(1.0 / F.pow(F.col("distance_km"), 2)))
    normed = share_of_total(weighted, ["station_id"], "raw_weight", "blend_weight")
    cols = ["dwd_station_id", "dwd_station_name", "distance_km", "name_bonus", "blend_weight"]
    out = pivot_rank(normed, "station_id", "station_rank", cols, RANK_PREFIXES[:k],
                     any_cols=["station_name"], count_alias="matched_station_count")
    return out


def weather_join(gauge_features: DataFrame, obs: DataFrame, mapping: DataFrame,
                 measures: Sequence[str] = WEATHER_MEASURES, series: str | None = "W",
                 hours: DataFrame | None = None) -> DataFrame:
    """L3: gauge rows (series 'W' only) + ranked fallback weather. ``hours``:
    see ``ranked_fallback_join``."""
    g = gauge_features.where(F.col("timeseries_name") == series) if series else gauge_features
    m = mapping.drop("station_name")
    out = ranked_fallback_join(g, obs, m, measures, source_measure="temperature_c", hours=hours)
    return out.withColumns({
        "dwd_station_id": F.col("primary_dwd_station_id"),
        "dwd_station_name": F.col("primary_dwd_station_name"),
        "distance_km": F.col("primary_distance_km"),
    })
