"""Join operators (section D).

Broadcast policy: an explicit ``broadcast()`` hint is only used for sides
whose size is fixed by construction (literal config dimensions, one-row
parameter frames, a ``limit(n)`` result). Every other side is left to the
planner: AQE measures the real shuffle output at runtime and converts a
sort-merge join into a broadcast hash join only when that side is below
``spark.sql.adaptive.autoBroadcastJoinThreshold``; beyond it the join stays
a shuffle join (with skewed partitions split by AQE's skew-join rule).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import EARTH_RADIUS_KM, haversine_km, max_lon_delta_deg, normalize_name
from .windows import top_k_per_group


def join_mapping(facts: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Left equi join, every fact kept."""
    return facts.join(mapping, key, "left")


def hourly_join(facts: DataFrame, obs: DataFrame, fact_id: str, obs_id: str,
                fact_ts: str, obs_ts: str, prefix: str, measures: Sequence[str]) -> DataFrame:
    """Left join on station id and the hour-truncated time."""
    o = obs.select(F.col(obs_id).alias("_oid"), F.date_trunc("hour", F.col(obs_ts)).alias("_ohour"),
                   *[F.col(m).alias(f"{prefix}{m}") for m in measures])
    f = facts.withColumn("_fhour", F.date_trunc("hour", F.col(fact_ts)))
    out = f.join(o, (F.col(fact_id) == F.col("_oid")) & (F.col("_fhour") == F.col("_ohour")), "left")
    return out.drop("_oid", "_ohour", "_fhour")


def ranked_fallback_join(facts: DataFrame, obs: DataFrame, mapping: DataFrame,
                         measures: Sequence[str], station_col: str = "station_id",
                         fact_ts: str = "timestamp_utc", obs_id: str = "dwd_station_id",
                         obs_ts: str = "timestamp_utc",
                         ranks: Sequence[tuple[str, str]] = (("primary", "p_"), ("backup1", "b1_"),
                                                             ("backup2", "b2_")),
                         source_measure: str | None = None, hours: DataFrame | None = None) -> DataFrame:
    """D3: facts + mapping (D1) + per-rank hourly observations (D2), each
    measure = first non-null of primary, backup1, backup2, and the source
    tag from ``source_measure`` only.

    Plan: the weather of a fact depends only on (station, hour). The hours that
    facts have, at most one row a fact, get the few stations of their mapping
    and meet the observations of just these hours, which are pivoted by rank
    with partial aggregates to one row for each (station, hour); the facts are
    joined once. ``hours`` gives the same station and time columns for all
    facts, and perhaps for more, from a cheaper source than ``facts``.
    """
    source_measure = source_measure or measures[0]
    hour = F.date_trunc("hour", F.col(fact_ts))
    cand_cols = [F.struct(F.lit(i).alias("rank"), F.col(f"{name}_dwd_station_id").alias("oid"))
                 for i, (name, _) in enumerate(ranks)]
    asked = (hours if hours is not None else facts).select(F.col(station_col).alias("_asid"), hour.alias("_ahour"))
    asked = asked.where(F.col("_asid").isNotNull() & F.col("_ahour").isNotNull()).distinct()
    places = mapping.select(F.col(station_col).alias("_msid"), F.array(*cand_cols).alias("_places"))
    cands = (asked.join(places, F.col("_asid") == F.col("_msid"))
                  .select("_msid", "_ahour", F.explode("_places").alias("_c")).where(F.col("_c.oid").isNotNull()))
    o = obs.select(F.col(obs_id).alias("_oid"), F.date_trunc("hour", F.col(obs_ts)).alias("_ohour"),
                   *[F.col(m) for m in measures])
    matched = cands.join(o, (F.col("_c.oid") == F.col("_oid")) & (F.col("_ahour") == F.col("_ohour")))
    aggs = []
    for i, (_, pfx) in enumerate(ranks):
        for m in measures:
            aggs.append(F.max(F.when(F.col("_c.rank") == i, F.col(m))).alias(f"{pfx}{m}"))
    ts_type = facts.schema[fact_ts].dataType
    aggs.append(F.max(F.when(F.col("_c.rank") == 0, F.col("_ohour"))).cast(ts_type).alias("weather_timestamp_utc"))
    pivot = matched.groupBy(F.col("_msid").alias("_sid"), F.col("_ohour").alias("_hour")).agg(*aggs)
    out = (facts.withColumn("_fhour", hour)
                .join(mapping, station_col, "left")
                .join(pivot, (F.col(station_col) == F.col("_sid")) & (F.col("_fhour") == F.col("_hour")), "left")
                .drop("_sid", "_hour", "_fhour"))
    coalesced = {m: F.coalesce(*[F.col(f"{p}{m}") for _, p in ranks]) for m in measures}
    coalesced.update({f"{m}_blend": F.coalesce(*[F.col(f"{p}{m}") for _, p in ranks]) for m in measures})
    src = F.lit(None).cast("string")
    for name, p in reversed(list(ranks)):
        src = F.when(F.col(f"{p}{source_measure}").isNotNull(), F.lit(name)).otherwise(src)
    coalesced["weather_source_used"] = src
    return out.withColumns(coalesced)


def grid_distance_join(left: DataFrame, right: DataFrame, max_km: float,
                       left_cols: tuple[str, str] = ("latitude", "longitude"),
                       right_cols: tuple[str, str] = ("latitude", "longitude"),
                       distance_col: str = "distance_km",
                       radius_km: float = EARTH_RADIUS_KM, tasks: int | None = None) -> DataFrame:
    """All (left, right) pairs within ``max_km`` great-circle distance,
    rows with a null coordinate dropped. Column names of the two sides must
    be distinct (rename the right side's coordinates first). ``tasks`` deals the
    cells to that many tasks, however small the two sides are beside their pairs.

    Instead of a nested-loop cross join, space is cut into cells of
    ``max_km`` (latitude bands, equal-angle longitude cells). Each right point
    has one cell; each left point lists every cell that can hold a point
    within range (bands +-1, and the longitude span widened by latitude),
    so an equi-join on the cell finds every candidate exactly once, then the
    exact haversine filter decides. The pair count is bounded by the points
    actually near each other, not by |left| x |right|.
    """
    la, lo = left_cols
    ra, ro = right_cols
    step = math.degrees(max_km / radius_km)  # cell size in degrees
    n_lon = max(1, int(math.floor(360.0 / step)))
    lon_step = 360.0 / n_lon
    n_lat = int(math.floor(180.0 / step)) + 1

    lft = left.where(F.col(la).isNotNull() & F.col(lo).isNotNull())
    rgt = right.where(F.col(ra).isNotNull() & F.col(ro).isNotNull())

    def band(lat: Column) -> Column:
        return F.least(F.floor((lat + F.lit(90.0)) / F.lit(step)), F.lit(n_lat - 1)).cast("int")

    def lon_cell(lon: Column) -> Column:
        return F.pmod(F.floor((lon + F.lit(180.0)) / F.lit(lon_step)).cast("int"), F.lit(n_lon))

    r = rgt.withColumn("_cell", F.struct(band(F.col(ra)).alias("b"), lon_cell(F.col(ro)).alias("c")))
    lat_l = F.col(la)
    dlon = max_lon_delta_deg(lat_l, max_km, radius_km)
    lo_cell = F.floor((F.col(lo) - dlon + F.lit(180.0)) / F.lit(lon_step)).cast("int")
    hi_cell = F.floor((F.col(lo) + dlon + F.lit(180.0)) / F.lit(lon_step)).cast("int")
    hi_cell = F.least(hi_cell, lo_cell + F.lit(n_lon - 1))
    b0 = band(lat_l)
    bands = F.sequence(F.greatest(b0 - 1, F.lit(0)), F.least(b0 + 1, F.lit(n_lat - 1)))
    cells = F.sequence(lo_cell, hi_cell)
    keys = F.array_distinct(F.flatten(F.transform(
        bands, lambda b: F.transform(cells, lambda c: F.struct(b.alias("b"), F.pmod(c, F.lit(n_lon)).alias("c"))))))
    lk = lft.withColumn("_cell", F.explode(keys))
    if tasks:
        lk, r = lk.repartition(tasks, "_cell"), r.repartition(tasks, "_cell")
    joined = lk.join(r, "_cell", "inner").drop("_cell")
    d = haversine_km(F.col(la), F.col(lo), F.col(ra), F.col(ro), radius_km)
    return joined.withColumn(distance_col, d).where(F.col(distance_col) <= F.lit(max_km))


#: Rows of one place that a row of ``distance_pairs`` carries, about.
PLACE_ROWS = 256


def distance_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str, max_km: float,
                   left_cols: tuple[str, str] = ("latitude", "longitude"),
                   right_cols: tuple[str, str] = ("latitude", "longitude"), distance_col: str = "distance_km",
                   radius_km: float = EARTH_RADIUS_KM, shown: Callable[[Column], Column] = lambda d: d) -> DataFrame:
    """(``left_id``, ``right_id``, distance) of all pairs of rows within
    ``max_km``. Rows of one place meet the cells together, some ``PLACE_ROWS``
    in a row, and are dealt out after the distance filter, so that a place's
    distances are worked out once and no task holds its pairs. ``shown`` turns
    a distance that has passed the filter into the one listed.
    """
    def together(df, cols, id_col, ids):
        rows = df.where(F.col(cols[0]).isNotNull() & F.col(cols[1]).isNotNull()).select(id_col, *cols)
        parts = rows.groupBy(*cols).agg(F.ceil(F.count(F.lit(1)) / PLACE_ROWS).alias("_parts"))
        part = F.pmod(F.xxhash64(id_col), F.col("_parts")).alias("_part")
        return (rows.join(parts, list(cols)).groupBy(*cols, part)
                    .agg(F.collect_list(F.struct(id_col)).alias(ids)).drop("_part"))

    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = grid_distance_join(together(left, left_cols, left_id, "_left"), together(right, right_cols, right_id, "_right"),
                             max_km, left_cols, right_cols, distance_col, radius_km, tasks)
    return (met.select(F.inline("_left"), "_right", shown(F.col(distance_col)).alias(distance_col))
               .select(left_id, F.inline("_right"), distance_col))


def _cell_diagonal_km(step_deg: float, radius_km: float) -> float:
    """The farthest that two points of a cell of ``step_deg`` by ``step_deg``
    degrees can lie apart."""
    half = math.radians(min(step_deg, 180.0)) / 2
    return 2 * radius_km * math.asin(min(1.0, math.sqrt(2) * math.sin(half)))


def _first_of_place(df: DataFrame, place: Sequence[str], id_col: str, k: int, skip_self: bool) -> DataFrame:
    """The rows of each place that a search for k can return: rows of one
    place are equally far from anywhere and go by id, so these are its first k;
    where a row's own id is skipped, up to k rows of its first k + 1 ids."""
    if not skip_self:
        return top_k_per_group(df, place, [F.col(id_col).asc()], k)
    df = top_k_per_group(df.where(F.col(id_col).isNotNull()), [*place, id_col], [F.col(place[0]).asc()], k)
    ids = F.dense_rank().over(Window.partitionBy(*place).orderBy(id_col))
    return df.withColumn("_nth", ids).where(F.col("_nth") <= k + 1).drop("_nth")


def distance_classes(left: DataFrame, right: DataFrame, left_id: str, right_id: str, max_km: float,
                     left_cols: tuple[str, str] = ("latitude", "longitude"),
                     right_cols: tuple[str, str] = ("latitude", "longitude"), distance_col: str = "distance_km",
                     radius_km: float = EARTH_RADIUS_KM) -> DataFrame:
    """D4 over places: rows with the same coordinates are a class, named by
    its least id. ``kind`` tells the rows apart: ``pair`` has two classes
    (``left_class``, ``right_class``) within ``max_km`` and their distance,
    ``left`` and ``right`` a row's id (``member_id``) and its class. Every pair
    of rows within range follows from its classes; copies are not multiplied
    out. Rows with a null coordinate take no part.
    """
    def split(df, cols, id_col, cls):
        rows = df.where(F.col(cols[0]).isNotNull() & F.col(cols[1]).isNotNull()).select(id_col, *cols)
        places = rows.groupBy(*cols).agg(F.min(id_col).alias(cls))
        return places, rows.join(places, list(cols)).select(cls, F.col(id_col).alias("member_id"))

    places_l, members_l = split(left, left_cols, left_id, "left_class")
    places_r, members_r = split(right, right_cols, right_id, "right_class")
    pairs = grid_distance_join(places_l, places_r, max_km, left_cols, right_cols, distance_col, radius_km)
    out = pairs.select(F.lit("pair").alias("kind"), "left_class", "right_class", distance_col)
    for kind, members in (("left", members_l), ("right", members_r)):
        out = out.unionByName(members.withColumn("kind", F.lit(kind)), allowMissingColumns=True)
    return out.select("kind", "left_class", "right_class", "member_id", distance_col)


def nearest_k(left: DataFrame, right: DataFrame, left_id: str, right_id: str, k: int, max_km: float,
              left_cols: tuple[str, str] = ("latitude", "longitude"),
              right_cols: tuple[str, str] = ("latitude", "longitude"), distance_col: str = "distance_km",
              on: Sequence[str] = (), skip_self: bool = False, decimals: int | None = None, rings: int = 8,
              radius_km: float = EARTH_RADIUS_KM) -> DataFrame:
    """The ``k`` nearest right rows of every left row within ``max_km``,
    searched in rings as wide as each left row needs.

    Counts of right rows in nested cells (a small aggregate) give each left
    row its ring: the least cell around it with k right rows, whose diagonal no
    k-th neighbour exceeds; ``max_km`` where even the largest holds fewer.
    Then one equi-join on (ring, cell) meets only cells that the ring's reach
    touches, and farther pairs are dropped before the top k. Pairs follow the
    density around a row, not ``max_km``. The cells of a ring are those of
    ``grid_distance_join``: the date line and the poles are inside.

    ``on`` names columns that both sides share and must agree; k is then
    counted within them. ``skip_self`` drops pairs with equal ids. ``decimals``
    rounds distances before they are ranked. Ties go to the smaller
    ``right_id``. Rows with a null coordinate take no part; left rows that share
    an id are ranked together.
    Result: the columns of both sides and the distance.
    """
    la, lo = left_cols
    ra, ro = right_cols
    slack = 0.0 if decimals is None else 2.0 * 10 ** -decimals  # what rounding can move past another
    reaches, counted = [], []  # reach of each ring, and the cell that proves it
    for r in range(rings - 1, 0, -1):
        step = math.degrees(max_km / radius_km) / 2 ** r
        if _cell_diagonal_km(step, radius_km) + slack < max_km:
            counted.append(step)
            reaches.append(_cell_diagonal_km(step, radius_km) * (1 + 1e-9) + slack + 1e-9)
    reaches.append(max_km)
    lft = left.where(F.col(la).isNotNull() & F.col(lo).isNotNull())
    rgt = right.where(F.col(ra).isNotNull() & F.col(ro).isNotNull())
    rgt = _first_of_place(rgt, [ra, ro, *on], right_id, k, skip_self)

    def proof(lat: Column, lon: Column) -> Column:
        return F.explode(F.array(*[F.struct(F.lit(i).alias("ring"), F.floor((lat + 90.0) / s).alias("b"),
                                            F.floor((lon + 180.0) / s).alias("c")) for i, s in enumerate(counted)]))

    need = k + (1 if skip_self else 0)
    held = rgt.select(*on, proof(F.col(ra), F.col(ro)).alias("_p")).groupBy(*on, "_p").count().where(F.col("count") >= need)
    row = [left_id, la, lo, *on]
    ringed = (lft.select(*row, proof(F.col(la), F.col(lo)).alias("_p")).join(held, [*on, "_p"])
                 .groupBy(*row).agg(F.min("_p.ring").alias("_ring")))
    lft = lft.join(ringed, row, "left").withColumn("_ring", F.coalesce("_ring", F.lit(len(counted))))

    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("_ring") + 1)
    steps = [min(math.degrees(x / radius_km), 180.0) for x in reaches]
    lons = [max(1, int(math.floor(360.0 / s))) for s in steps]
    lats = [int(math.floor(180.0 / s)) + 1 for s in steps]
    step, n_lon, n_lat, reach = pick(steps), pick(lons), pick(lats), pick(reaches)

    def band(lat: Column) -> Column:
        return F.least(F.floor((lat + 90.0) / step), n_lat - 1).cast("int")

    def column(lon: Column) -> Column:
        return F.floor((lon + 180.0) / (360.0 / n_lon)).cast("int")

    dlon = max_lon_delta_deg(F.col(la), reach, radius_km)
    first = column(F.col(lo) - dlon)
    last = F.least(column(F.col(lo) + dlon), first + n_lon - 1)
    b0 = band(F.col(la))
    cells = F.array_distinct(F.flatten(F.transform(
        F.sequence(F.greatest(b0 - 1, F.lit(0)), F.least(b0 + 1, n_lat - 1)),
        lambda b: F.transform(F.sequence(first, last), lambda c: F.struct(b.alias("b"), F.pmod(c, n_lon).alias("c"))))))
    lft = lft.withColumn("_cell", F.explode(cells))
    rgt = (rgt.withColumn("_ring", F.explode(F.array(*[F.lit(i) for i in range(len(reaches))])))
              .withColumn("_cell", F.struct(band(F.col(ra)).alias("b"), F.pmod(column(F.col(ro)), n_lon).alias("c"))))
    pairs = lft.join(rgt, [*on, "_ring", "_cell"])
    d = haversine_km(F.col(la), F.col(lo), F.col(ra), F.col(ro), radius_km)
    pairs = pairs.withColumn(distance_col, d).where(F.col(distance_col) <= reach)
    if skip_self:
        pairs = pairs.where(F.col(left_id) != F.col(right_id))
    if decimals is not None:
        pairs = pairs.withColumn(distance_col, F.round(distance_col, decimals))
    return top_k_per_group(pairs.drop("_ring", "_cell"), [left_id, *on], [F.col(distance_col).asc(), F.col(right_id).asc()], k)


def keep_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Semi join on an id set."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def missing_ids(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """H5: ids in ``expected`` that ``present`` lacks."""
    return expected.select(key).distinct().join(present.select(key), key, "left_anti")


def outer_delta(before: DataFrame, after: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Full outer join on the key; for each column ``c``:
    ``c_before``, ``c_after`` (null -> 0) and ``c_delta = after - before``."""
    b = before.select(F.col(key).alias("_kb"), *[F.col(c).alias(f"{c}_before") for c in cols])
    a = after.select(F.col(key).alias("_ka"), *[F.col(c).alias(f"{c}_after") for c in cols])
    j = b.join(a, b["_kb"].eqNullSafe(a["_ka"]), "full")
    out = j.select(F.coalesce("_kb", "_ka").alias(key),
                   *[F.coalesce(F.col(f"{c}_{s}"), F.lit(0)).alias(f"{c}_{s}") for c in cols for s in ("before", "after")])
    return out.withColumns({f"{c}_delta": F.col(f"{c}_after") - F.col(f"{c}_before") for c in cols})


def exact_actuals(preds: DataFrame, actuals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on exact keys; the actual side must be unique per key.

    A duplicate key makes the query fail (``raise_error``) instead of
    silently multiplying prediction rows.
    """
    keys = list(keys)
    dup = actuals.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    checked = (actuals.join(dup, keys, "inner")
                      .withColumn("_ok", F.when(F.col("_n") > 1,
                                                F.raise_error(F.lit("actuals not unique per key")))
                                   .otherwise(F.lit(True)))
                      .where(F.col("_ok")).drop("_n", "_ok"))
    return preds.join(checked, keys, "left")


def with_params(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a one-row parameter / boundary frame (broadcast: one row)."""
    return df.crossJoin(F.broadcast(one_row))


def attach_metadata(df: DataFrame, meta: DataFrame, key: str,
                    coord_cols: Sequence[str] = ("latitude", "longitude")) -> DataFrame:
    """Left join station metadata, coordinates safe-cast to double."""
    m = meta.withColumns({c: F.col(c).try_cast("double") for c in coord_cols if c in meta.columns})
    return df.join(m, key, "left")


def segment_arrays(segments: DataFrame, station_col: str = "station_name") -> DataFrame:
    """Per station: sorted segment ids and labels, and whether it is the
    decision gauge of any of them. ``segments`` has one row per
    (segment, gauge role); the result has one row per station."""
    return (segments.groupBy(station_col)
                    .agg(F.array_sort(F.collect_set("segment_id")).alias("segment_ids"),
                         F.array_sort(F.collect_set("segment_label")).alias("segment_labels"),
                         F.bool_or(F.col("role") == "decision").alias("is_decision_gauge")))


def attach_segments(df: DataFrame, segments: DataFrame, name_col: str = "station_name",
                    mode: str = "upper_trim") -> DataFrame:
    """Station -> arrays of segment ids / labels + decision flag, joined
    on the normalised station name (a station may sit in many segments). A
    station in none gets empty arrays and false."""
    per_station = segment_arrays(segments.withColumn("_key", normalize_name(F.col("station_name"), mode))
                                 .drop("station_name").withColumnRenamed("_key", "station_name"))
    per_station = per_station.withColumnRenamed("station_name", "_seg_key")
    out = df.join(per_station, normalize_name(F.col(name_col), mode) == F.col("_seg_key"), "left")
    no_names = F.array().cast("array<string>")
    return out.withColumns({"segment_ids": F.coalesce("segment_ids", no_names),
                            "segment_labels": F.coalesce("segment_labels", no_names),
                            "is_decision_gauge": F.coalesce("is_decision_gauge", F.lit(False))}).drop("_seg_key")


def threshold_join(df: DataFrame, thresholds: DataFrame, name_col: str = "station_name",
                   threshold_col: str = "threshold_cm", mode: str = "upper_trim") -> DataFrame:
    """Left join thresholds by normalised name; null when none.

    ``thresholds`` is a config dimension; it is reduced to one row per
    normalised name before the join so facts are never multiplied.
    """
    t = (thresholds.select(normalize_name(F.col(name_col), mode).alias("_tkey"), F.col(threshold_col))
                   .groupBy("_tkey").agg(F.min(threshold_col).alias(threshold_col)))
    return df.join(t, normalize_name(F.col(name_col), mode) == F.col("_tkey"), "left").drop("_tkey")


def band_join(df: DataFrame, bands: DataFrame, value_col: str, name_col: str = "station_name",
              default_name: str = "DEFAULT",
              band_cols: Sequence[str] = ("band_id", "band_label", "severity")) -> DataFrame:
    """Non-equi band lookup.

    A row matches a band when ``min_cm <= value`` (or no min) and
    ``value <= max_cm`` (or no max). A station's own bands are used when it
    has any, else the DEFAULT bands; the first matching band in list order
    (``band_order``) wins; no match leaves the band columns null. Names are
    compared normalised.

    ``bands`` is operational config (a literal list of a few dozen rows), so
    each band set is folded into one sorted array and broadcast; the range
    test is an array ``filter`` evaluated in codegen, with no row-id join back.
    """
    fields = ["band_order", "min_cm", "max_cm", *band_cols]
    sets = (bands.groupBy(normalize_name(F.col(name_col)).alias("_bset"))
                 .agg(F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in fields]))).alias("_bands")))
    own = sets.select(F.col("_bset").alias("_own_name"), F.col("_bands").alias("_own"))
    dflt = sets.where(F.col("_bset") == normalize_name(F.lit(default_name))).select(F.col("_bands").alias("_dflt"))  # zero or one row
    out = (df.join(own, normalize_name(F.col(name_col)) == F.col("_own_name"), "left")
             .join(F.broadcast(dflt), F.lit(True), "left"))
    v = F.col(value_col)
    chosen = F.filter(F.coalesce(F.col("_own"), F.col("_dflt")),
                      lambda b: (b["min_cm"].isNull() | (v >= b["min_cm"]))
                      & (b["max_cm"].isNull() | (v <= b["max_cm"])))
    out = out.withColumn("_band", F.get(chosen, 0))
    return out.select(*df.columns, *[F.col(f"_band.{c}").alias(c) for c in band_cols])


def attach_cluster(df: DataFrame, plan: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Attach the cluster plan (left for scoring, inner for training)."""
    return df.join(plan, key, how)
