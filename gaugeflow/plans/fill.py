"""Proxy candidates (D14) and neighbour gap filling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import nearest_k
from ..session import ensure_checkpoint_dir

# Measure columns per variable family, and the families filled
# by inverse-distance weighting when at least two proxies have a value.
VARIABLE_COLUMNS = {
    "air_temperature": "temperature_c",
    "precipitation": "precipitation_mm",
    "wind": "wind_speed_ms",
    "pressure": "pressure_hpa",
}
IDW_VARIABLES = ("air_temperature", "precipitation")


def station_variables(obs: DataFrame, station: str = "dwd_station_id",
                      variables: Mapping[str, str] = VARIABLE_COLUMNS) -> DataFrame:
    """Which variable families each station actually reports (any non-null
    value), from the full observation relation: (station, variable)."""
    aggs = [F.count(F.col(c)).alias(v) for v, c in variables.items()]
    per = obs.groupBy(station).agg(*aggs)
    stack = F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).alias("n")) for v in variables]))
    return per.select(station, stack.alias("_v")).where(F.col("_v.n") > 0).select(station, "_v.variable")


def proxy_candidates(stations: DataFrame, has_var: DataFrame, targets: Sequence[str] | None = None,
                     variables: Sequence[str] = tuple(VARIABLE_COLUMNS), max_km: float = 175.0, k: int = 3,
                     only_missing: bool = False, station: str = "dwd_station_id") -> DataFrame:
    """For each target station and variable, up to ``k`` other stations
    reporting that variable within ``max_km``, nearest first (distance
    rounded to 2 decimals, then station id).

    ``stations``: station, name, latitude, longitude; ``has_var``: (station,
    variable). With ``only_missing`` only variables the target lacks get
    candidates (the source's rule); otherwise every variable does, so gaps
    inside a reported variable can be filled too.
    """
    # one row a station (and variable) each, from whole fact tables: written once, as the search reads them several times
    ensure_checkpoint_dir(stations.sparkSession)
    st = stations.select(station, "latitude", "longitude").distinct().checkpoint()
    has_var = has_var.select(station, "variable").distinct().checkpoint()
    tg = st if targets is None else st.where(F.col(station).isin(list(targets)))
    tg = tg.select(F.col(station).alias("target_station_id"), F.col("latitude").alias("_tlat"),
                   F.col("longitude").alias("_tlon"))
    px = st.select(F.col(station).alias("proxy_station_id"), F.col("latitude").alias("_plat"),
                   F.col("longitude").alias("_plon"))
    hv = has_var.select(F.col(station).alias("_hs"), "variable")
    wanted = tg.withColumn("variable", F.explode(F.array(*[F.lit(v) for v in variables])))
    if only_missing:
        wanted = wanted.join(hv, (F.col("target_station_id") == F.col("_hs")) & wanted["variable"].eqNullSafe(hv["variable"]), "left_anti")
    offers = px.join(hv, F.col("proxy_station_id") == F.col("_hs")).drop("_hs").where(F.col("variable").isin(list(variables)))
    top = nearest_k(wanted, offers, "target_station_id", "proxy_station_id", k, max_km, ("_tlat", "_tlon"),
                    ("_plat", "_plon"), on=["variable"], skip_self=True, decimals=2)
    return top.select("target_station_id", "variable", "proxy_station_id", "distance_km")


def proxy_fill(obs: DataFrame, candidates: DataFrame, station: str = "dwd_station_id",
               ts: str = "timestamp_utc", variables: Mapping[str, str] = VARIABLE_COLUMNS,
               idw_variables: Sequence[str] = IDW_VARIABLES) -> DataFrame:
    """Fill missing measures of target stations from their proxies at the
    same timestamp.

    For each missing (station, time, variable): the proxies with a value
    there are the candidates. An IDW variable with >= 2 candidates gets the
    inverse-distance-squared mean (a candidate at 0 km wins outright),
    otherwise the nearest candidate's value. Lineage columns record the
    proxy ids (comma list, nearest first), the variable, the smallest
    distance and the method actually used.

    Plan: missing cells are exploded to (target, time, variable), joined to
    their <= k candidates and then to the proxies' observations on (proxy,
    time); a partial aggregate per missing cell computes both fill rules; the
    fills are pivoted per (station, time) and left-joined back. Every
    intermediate is bounded by missing cells x k.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(c).alias("v"))
                                for v, c in variables.items()]))
    long_obs = obs.select(F.col(station).alias("_sid"), F.col(ts).alias("_ts"), cells.alias("_c")) \
                  .select("_sid", "_ts", F.col("_c.variable").alias("variable"), F.col("_c.v").alias("v"))
    missing = long_obs.where(F.col("v").isNull()).select(
        F.col("_sid").alias("target_station_id"), F.col("_ts").alias("_mts"), "variable")
    with_cand = missing.join(candidates, ["target_station_id", "variable"], "inner")
    present = long_obs.where(F.col("v").isNotNull()).select(
        F.col("_sid").alias("proxy_station_id"), F.col("_ts").alias("_mts"), F.col("variable").alias("_pvar"), "v")
    vals = with_cand.join(present, ["proxy_station_id", "_mts"], "inner").where(F.col("variable") == F.col("_pvar"))
    d = F.col("distance_km")
    w = F.when(d > 0, 1.0 / (d * d))
    g = vals.groupBy("target_station_id", "_mts", "variable").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("v") * w).alias("_wv"), F.sum(w).alias("_w"),
        F.min_by(F.col("v"), F.struct(d, F.col("proxy_station_id"))).alias("_nearest"),
        F.min(F.when(d == 0, F.struct(F.col("proxy_station_id"), F.col("v")))).alias("_zero"),
        F.min(d).alias("proxy_source_distance_km"),
        F.sort_array(F.collect_list(F.struct(d.alias("d"), F.col("proxy_station_id").alias("p")))).alias("_ids"))
    idw = F.col("variable").isin(list(idw_variables)) & (F.col("n") >= 2)
    g = g.select(
        "target_station_id", "_mts", "variable", "proxy_source_distance_km",
        F.when(idw & F.col("_zero").isNotNull(), F.col("_zero.v"))
         .when(idw, F.col("_wv") / F.col("_w")).otherwise(F.col("_nearest")).alias("fill_value"),
        F.when(idw, F.lit("idw")).otherwise(F.lit("nearest")).alias("fill_method"),
        F.when(idw, F.array_join(F.transform("_ids", lambda x: x["p"]), ","))
         .otherwise(F.col("_ids")[0]["p"]).alias("proxy_source_station_id"),
        F.col("n").alias("proxy_count"))
    return g


def apply_fill(obs: DataFrame, fills: DataFrame, station: str = "dwd_station_id", ts: str = "timestamp_utc",
               variables: Mapping[str, str] = VARIABLE_COLUMNS) -> DataFrame:
    """Write the fills back into the wide observation rows with lineage.

    When several variables of one row are filled, the lineage columns
    describe the last variable in ``variables`` order (as the source, which
    overwrites them variable by variable)."""
    order = {v: i for i, v in enumerate(variables)}
    fills = fills.withColumn("_ord", F.element_at(F.create_map(*[x for v, i in order.items()
                                                                  for x in (F.lit(v), F.lit(i))]), F.col("variable")))
    piv = fills.groupBy("target_station_id", "_mts").agg(
        *[F.max(F.when(F.col("variable") == v, F.col("fill_value"))).alias(f"_fill_{v}") for v in variables],
        F.max_by(F.struct("proxy_source_station_id", F.col("variable").alias("proxy_source_variable"),
                          "proxy_source_distance_km", F.col("fill_method").alias("proxy_fill_method")),
                 F.col("_ord")).alias("_lin"))
    out = obs.join(piv, (F.col(station) == F.col("target_station_id")) & (F.col(ts) == F.col("_mts")), "left")
    filled = {c: F.coalesce(F.col(c), F.col(f"_fill_{v}")) for v, c in variables.items()}
    filled.update({
        "is_proxy_backfilled": F.col("_lin").isNotNull(),
        "proxy_source_station_id": F.col("_lin.proxy_source_station_id"),
        "proxy_source_variable": F.col("_lin.proxy_source_variable"),
        "proxy_source_distance_km": F.col("_lin.proxy_source_distance_km"),
        "proxy_fill_method": F.col("_lin.proxy_fill_method"),
    })
    out = out.withColumns(filled)
    return out.drop("target_station_id", "_mts", "_lin", *[f"_fill_{v}" for v in variables])
