"""Aggregations (section E, non-metric part).

All aggregates here are algebraic (count / sum / avg / min / max / max_by /
bool_or / count_if), so Spark runs them as partial + final hash aggregates:
each map task ships one partial row per group, and a hot group costs one
row per task in the shuffle. The few holistic statistics (median, mode) go
through ``exact_quantile`` (ranked, skew-safe) or a two-level count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import exact_quantile


def segment_agg(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Min, max, avg and count of the value per key."""
    return df.groupBy(*keys).agg(
        F.min(value).alias("min_value"), F.max(value).alias("max_value"),
        F.avg(value).alias("avg_value"), F.count(value).alias("value_count"))


def coverage(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Total rows and non-null count per column (global or per key)."""
    aggs = [F.count(F.lit(1)).alias("total_rows")] + [F.count(c).alias(f"{c}_non_null") for c in cols]
    return df.groupBy(*keys).agg(*aggs)


def coalesce_by_key(df: DataFrame, keys: Sequence[str], measures: Sequence[str],
                    order: str | Column, last_cols: Sequence[str] = ()) -> DataFrame:
    """Per key, each measure = its first non-null value in ``order``;
    ``last_cols`` (lineage) take the value of the last row in ``order``.
    ``min_by``/``max_by`` with a filter are partial aggregates."""
    o = F.col(order) if isinstance(order, str) else order
    aggs = [F.min_by(F.when(F.col(m).isNotNull(), F.struct(F.col(m).alias("v"))),
                     F.when(F.col(m).isNotNull(), o))["v"].alias(m) for m in measures]
    aggs += [F.max_by(F.col(c), o).alias(c) for c in last_cols]
    return df.groupBy(*keys).agg(*aggs)


def observed_coverage(df: DataFrame, key: str, ts: str, measures: Sequence[str]) -> DataFrame:
    """Per station: rows, first/last time, non-null ratio per measure and
    the share of rows with all measures present."""
    all_present = F.lit(True)
    for m in measures:
        all_present = all_present & F.col(m).isNotNull()
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        *[F.avg(F.col(m).isNotNull().cast("double")).alias(f"{m}_ratio") for m in measures],
        F.avg(all_present.cast("double")).alias("all_measures_ratio"))


def gap_summary(df: DataFrame, key: str, measures: Sequence[str], phase: str) -> DataFrame:
    """Per station (null names are their own group): rows, missing count
    and ratio per measure, rows with any gap, complete rows."""
    any_gap = F.lit(False)
    for m in measures:
        any_gap = any_gap | F.col(m).isNull()
    aggs = [F.count(F.lit(1)).alias("rows")]
    for m in measures:
        aggs.append(F.count_if(F.col(m).isNull()).alias(f"{m}_missing"))
    aggs += [F.count_if(any_gap).alias("rows_with_any_gap"), F.count_if(~any_gap).alias("complete_rows")]
    g = df.groupBy(key).agg(*aggs)
    return g.select(F.lit(phase).alias("phase"), "*",
                    *[F.try_divide(F.col(f"{m}_missing"), F.col("rows")).alias(f"{m}_missing_ratio") for m in measures])


def gap_totals(gaps: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """Global sums over the per-station gap summary."""
    cols = ["rows", *[f"{m}_missing" for m in measures], "rows_with_any_gap", "complete_rows"]
    return gaps.agg(F.count_distinct(key).alias("stations"), *[F.sum(c).alias(f"total_{c}") for c in cols])


def variable_map(coverage_rel: DataFrame, key: str, family_col: str, families: Sequence[str],
                 roles: DataFrame | None = None) -> DataFrame:
    """Station -> sorted distinct families, their count, one ``has_x``
    flag per family and (optionally) the configured role."""
    g = coverage_rel.groupBy(key).agg(F.array_sort(F.collect_set(family_col)).alias("families"))
    g = g.withColumn("family_count", F.size("families"))
    g = g.withColumns({f"has_{f}": F.array_contains("families", f) for f in families})
    if roles is not None:
        g = g.join(roles, key, "left")
    return g


def station_status(df: DataFrame, ratio_col: str, role_col: str | None = None,
                   core: float = 0.8, partial: float = 0.4) -> DataFrame:
    """Proxy role -> proxy_pool; null ratio -> drop; >= core -> core;
    >= partial -> partial; else drop."""
    r = F.col(ratio_col)
    s = F.when(r.isNull(), "drop").when(r >= core, "core").when(r >= partial, "partial").otherwise("drop")
    if role_col:
        s = F.when(F.col(role_col) == "proxy", "proxy_pool").otherwise(s)
    return df.withColumn("status", s)


def mode_per_group(df: DataFrame, keys: Sequence[str], col: str, alias: str | None = None) -> DataFrame:
    """Most frequent non-null value per group, lowest value on ties.

    Two partial aggregates (count per value, then the best (count, -value)
    per group) instead of gathering each group's values."""
    keys = list(keys)
    counts = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(*keys).agg(
        F.min_by(F.col(col), F.struct((-F.col("_n")).alias("n"), F.col(col).alias("v"))).alias(alias or f"{col}_mode"))
    return best


def medians(df: DataFrame, keys: Sequence[str], cols: Sequence[str], suffix: str = "_median") -> DataFrame:
    """Exact medians of several columns per group in ONE ranked pass: the
    columns are stacked to (keys, column, value), ranked once, and pivoted
    back."""
    keys = list(keys)
    stacked = df.select(*keys, F.explode(F.array(*[F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_v"))
                                                   for i, c in enumerate(cols)])).alias("_s")) \
                .select(*keys, "_s._c", "_s._v")
    q = exact_quantile(stacked, [*keys, "_c"], "_v", 0.5, alias="_m")
    return q.groupBy(*keys).agg(*[F.max(F.when(F.col("_c") == i, F.col("_m"))).alias(f"{c}{suffix}")
                                   for i, c in enumerate(cols)])


def station_profile(df: DataFrame, key: str, cols: Sequence[str], median: bool = True) -> DataFrame:
    """Mean, sample std, min, max (and exact median) per column."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"),
                 F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    out = df.groupBy(key).agg(*aggs)
    if median:
        out = out.join(medians(df, [key], cols), key, "left")
    return out


def station_snapshot(df: DataFrame, key: str, ts: str, value: str, mode_cols: Sequence[str]) -> DataFrame:
    """Per station: the most frequent value of each descriptive column
    (lowest on tie), first/last/count of timestamps, value statistics
    (mean, sample std, min, max, median), days covered and value range."""
    stats = df.groupBy(key).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(ts).alias("ts_count"),
        F.avg(value).alias("value_mean"), F.stddev_samp(value).alias("value_std"),
        F.min(value).alias("value_min"), F.max(value).alias("value_max"),
        F.count_distinct(F.to_date(ts)).alias("coverage_days"))
    stats = stats.withColumn("value_range", F.col("value_max") - F.col("value_min"))
    out = stats.join(exact_quantile(df, [key], value, 0.5, alias="value_median"), key, "left")
    for c in mode_cols:
        out = out.join(mode_per_group(df, [key], c, f"{c}_mode"), key, "left")
    return out


def pivot_rank(df: DataFrame, key: str, rank_col: str, cols: Sequence[str],
               prefixes: Sequence[str], any_cols: Sequence[str] = (), count_alias: str = "matched_count") -> DataFrame:
    """``MAX(IF(rank = k, col, NULL))`` for each rank k (1-based, one
    prefix per rank), ``any_value`` of ``any_cols`` and ``COUNT(*)``."""
    aggs = []
    for k, p in enumerate(prefixes, start=1):
        aggs += [F.max(F.when(F.col(rank_col) == k, F.col(c))).alias(f"{p}{c}") for c in cols]
    aggs += [F.min(c).alias(c) for c in any_cols]
    aggs.append(F.count(F.lit(1)).alias(count_alias))
    return df.groupBy(key).agg(*aggs)


def infer_step_hours(df: DataFrame, keys: Sequence[str], ts: str, chunk_rows: int | None = None) -> DataFrame:
    """Median (exact) of consecutive time differences per series, in
    hours, over all series -- one row. The previous-row lookup uses the
    chunked window plan, so a hot series is split across tasks."""
    from .windows import DEFAULT_CHUNK_ROWS, lag_feature, with_series_features
    micros = df.select(*keys, ts, F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"))
    prev = with_series_features(micros, keys, [ts], [lag_feature("_us", 1, "_prev_us")],
                                chunk_rows=chunk_rows or DEFAULT_CHUNK_ROWS)
    diffs = prev.where(F.col("_prev_us").isNotNull()).select(
        ((F.col("_us") - F.col("_prev_us")) / F.lit(3.6e9)).alias("step_hours"))
    return exact_quantile(diffs, [], "step_hours", 0.5, alias="step_hours")


def null_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null share per column, long form (column_name, null_fraction)."""
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_fraction"))
                                           for c in cols])).alias("_p")).select("_p.*")


def fill_log(filled: DataFrame, keys: Sequence[str] = ("target_station_id", "variable")) -> DataFrame:
    """Per (target, variable): the method(s) actually used, the number
    of distinct proxies and the rows filled."""
    return filled.groupBy(*keys).agg(
        F.array_sort(F.collect_set("fill_method")).alias("methods"),
        F.max("proxy_count").alias("max_proxy_count"),
        F.count(F.lit(1)).alias("filled_rows"))


def cluster_coverage(train: DataFrame, plan: DataFrame, key: str = "station_name", cluster: str = "cluster",
                     min_rows: int = 500, min_stations: int = 2) -> DataFrame:
    """Per planned cluster: training rows, stations with training data,
    planned stations and whether it may get its own model."""
    planned = plan.groupBy(cluster).agg(F.count(F.lit(1)).alias("planned_stations"))
    tr = train.join(plan, key, "inner").groupBy(cluster).agg(
        F.count(F.lit(1)).alias("train_rows"), F.count_distinct(key).alias("train_stations"))
    out = planned.join(tr, cluster, "left").fillna(0, ["train_rows", "train_stations"])
    out = out.withColumn("eligible", (F.col("train_rows") >= min_rows) & (F.col("train_stations") >= min_stations))
    return out.select(cluster, "train_rows", "train_stations", "planned_stations", "eligible")
