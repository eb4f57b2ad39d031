"""Row-offset window features.

Every feature here is a ``Feature``: a name, a builder taking the ordered
window spec and returning a ``Column``, and how many rows before/after the
current row it reads. ``with_series_features`` evaluates a list of them with
ONE window spec, so Catalyst plans a single Exchange + Sort for all of them.

Two physical strategies, same results:

* ``chunk_rows=None`` -- plain ``Window.partitionBy(keys).orderBy(order)``.
  One shuffle; a key's whole series lands in one task.
* ``chunk_rows=C`` -- skew-safe. Rows are numbered exactly per key
  (``rank_in_time`` for time orders, else ``rank_within``), cut into chunks
  of C consecutive rows, and each chunk
  gets copies of the ``before`` rows preceding it and the ``after`` rows
  following it. The window then runs per (key, chunk), and only home rows
  are kept. Because every frame is bounded by constants, the halo makes the
  result identical to the plain window while no task holds more than
  C + before + after rows of a key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .ranking import rank_in_time, rank_within

# Rows of one series handled by one task in the chunked plan. A series longer
# than this is split; shorter series cost one chunk.
DEFAULT_CHUNK_ROWS = 1_000_000

ROLLING_FUNCS: dict[str, Callable[[Column], Column]] = {
    "mean": F.avg,
    "avg": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,
    "stddev": F.stddev_samp,
    "count": F.count,
}


@dataclass(frozen=True)
class Feature:
    name: str
    build: Callable[[WindowSpec], Column]
    before: int = 0
    after: int = 0


def lag_feature(col: str, k: int, name: str | None = None) -> Feature:
    return Feature(name or f"lag_{k}", lambda w: F.lag(col, k).over(w), before=k)


def lead_feature(col: str, k: int, name: str | None = None) -> Feature:
    return Feature(name or f"lead_{k}", lambda w: F.lead(col, k).over(w), after=k)


def diff_feature(col: str, k: int, name: str | None = None) -> Feature:
    return Feature(name or f"diff_{k}", lambda w: F.col(col) - F.lag(col, k).over(w), before=k)


def rolling_feature(col: str, n: int, fn: str, name: str | None = None,
                    include_current: bool = False) -> Feature:
    """Aggregate over the ``n`` rows before the current one
    (``ROWS n PRECEDING .. 1 PRECEDING``), or ending at it when
    ``include_current``."""
    agg = ROLLING_FUNCS[fn]
    hi = 0 if include_current else -1
    lo = -(n - 1) if include_current else -n
    return Feature(name or f"rolling_{fn}_{n}",
                   lambda w: agg(F.col(col)).over(w.rowsBetween(lo, hi)), before=-lo)


def lag_change_feature(col: str, near: int, far: int, name: str) -> Feature:
    """``lag(near) - lag(far)`` (e.g. a 1-vs-3 step trend)."""
    return Feature(name, lambda w: F.lag(col, near).over(w) - F.lag(col, far).over(w),
                   before=max(near, far))


def rolling_sum_change_feature(col: str, long_n: int, short_n: int, name: str,
                               long_minus_short: bool = True) -> Feature:
    """Difference of two trailing sums; the sign convention is a parameter
    because the two feature scripts of the source disagree on it."""
    def build(w: WindowSpec) -> Column:
        long_s = F.sum(col).over(w.rowsBetween(-long_n, -1))
        short_s = F.sum(col).over(w.rowsBetween(-short_n, -1))
        return long_s - short_s if long_minus_short else short_s - long_s
    return Feature(name, build, before=max(long_n, short_n))


def lags(col: str, ks: Iterable[int], prefix: str = "lag_") -> list[Feature]:
    return [lag_feature(col, k, f"{prefix}{k}") for k in ks]


def leads(col: str, ks: Iterable[int], prefix: str = "lead_") -> list[Feature]:
    return [lead_feature(col, k, f"{prefix}{k}") for k in ks]


def diffs(col: str, ks: Iterable[int], prefix: str = "diff_") -> list[Feature]:
    return [diff_feature(col, k, f"{prefix}{k}") for k in ks]


def rollings(col: str, specs: Iterable[tuple[int, str]], prefix: str = "rolling_") -> list[Feature]:
    return [rolling_feature(col, n, fn, f"{prefix}{fn}_{n}") for n, fn in specs]


def with_series_features(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                         features: Sequence[Feature], chunk_rows: int | None = DEFAULT_CHUNK_ROWS,
                         partitions: int | None = None, rank_bucket_seconds: int = 86_400) -> DataFrame:
    """Append ``features`` computed over each key's series ordered by ``order``
    (chunked plan by default; ``chunk_rows=None`` for the plain window).

    Series ordered by a time column are numbered with ``rank_in_time``
    (per-day counts, no checkpoint); other orders use ``rank_within``."""
    keys, order = list(keys), list(order)
    if not features:
        return df
    if chunk_rows is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[f.build(w).alias(f.name) for f in features])

    before = max(f.before for f in features)
    after = max(f.after for f in features)
    expanded = chunk_series(df, keys, order, chunk_rows, before, after, partitions, rank_bucket_seconds)
    w = Window.partitionBy(*keys, "_chunk").orderBy("_rank")
    out = expanded.select("*", *[f.build(w).alias(f.name) for f in features])
    return out.where(F.col("_home") == F.col("_chunk")).drop("_home", "_chunk", "_rank")


def chunk_series(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk_rows: int, before: int,
                 after: int, partitions: int | None = None, rank_bucket_seconds: int = 86_400) -> DataFrame:
    """Number each series exactly (``_rank``) and assign every row to its
    home chunk (``_home``) plus copies into the neighbouring chunks whose
    frames reach it (``_chunk``): the ``before`` last rows of a chunk are
    copied into the next chunk, the ``after`` first rows into the previous
    one. A (key, _chunk) group holds at most chunk_rows + before + after rows."""
    keys, order = list(keys), list(order)
    c = max(int(chunk_rows), before, after, 1)
    time_types = ("timestamp", "timestamp_ntz", "date")
    if order and df.schema[order[0]].dataType.simpleString() in time_types:
        ranked = rank_in_time(df, keys, order[0], rank_bucket_seconds, rank_col="_rank", tiebreak=order[1:])
    else:
        ranked = rank_within(df, keys, order, rank_col="_rank", count_col=None, partitions=partitions)
    home = F.floor(F.col("_rank") / c)
    off = F.col("_rank") - home * c
    copies = F.array_distinct(F.array(
        home,
        F.when(off >= c - before, home + 1).otherwise(home),
        F.when(off < after, home - 1).otherwise(home),
    ))
    return ranked.withColumn("_home", home).withColumn("_chunk", F.explode(copies))


def add_lags(df: DataFrame, col: str, ks: Iterable[int], keys: Sequence[str], order: Sequence[str],
             prefix: str = "lag_", chunk_rows: int | None = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """row-offset lags (nulls are not skipped)."""
    return with_series_features(df, keys, order, lags(col, ks, prefix), chunk_rows)


def add_diffs(df: DataFrame, col: str, ks: Iterable[int], keys: Sequence[str], order: Sequence[str],
              prefix: str = "diff_", chunk_rows: int | None = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """value minus its k-row lag."""
    return with_series_features(df, keys, order, diffs(col, ks, prefix), chunk_rows)


def add_rolling(df: DataFrame, col: str, specs: Iterable[tuple[int, str]], keys: Sequence[str],
                order: Sequence[str], prefix: str = "rolling_", chunk_rows: int | None = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """trailing aggregates over the n previous rows, current row excluded."""
    return with_series_features(df, keys, order, rollings(col, specs, prefix), chunk_rows)


def add_leads(df: DataFrame, col: str, ks: Iterable[int], keys: Sequence[str], order: Sequence[str],
              prefix: str = "lead_", chunk_rows: int | None = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """row-offset leads."""
    return with_series_features(df, keys, order, leads(col, ks, prefix), chunk_rows)


def share_of_total(df: DataFrame, keys: Sequence[str], weight: str, alias: str) -> DataFrame:
    """weight / sum(weight) over the key group, null when the sum is 0.

    Computed as an aggregate joined back rather than an unordered window so a
    hot key is pre-aggregated map-side instead of held in one task.
    """
    keys = list(keys)
    totals = df.groupBy(*keys).agg(F.sum(weight).alias("_total"))
    out = df.join(totals, keys, "left")
    return out.withColumn(alias, F.try_divide(F.col(weight), F.col("_total"))).drop("_total")


def rank_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
              alias: str = "rank", one_based: bool = True) -> DataFrame:
    """row number within the key group under ``order`` (skew-safe)."""
    out = rank_within(df, keys, order, rank_col=alias, count_col=None)
    return out.withColumn(alias, F.col(alias) + F.lit(1 if one_based else 0))


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], k: int,
                    rank_col: str | None = None) -> DataFrame:
    """The first ``k`` rows of each group.

    ``row_number() <= k`` lets Catalyst insert a ``WindowGroupLimit`` below
    the shuffle, so each map task forwards at most k rows per key: the
    exchange carries O(k * keys * tasks) rows however hot a key is.
    """
    order_exprs = [F.col(o) if isinstance(o, str) else o for o in order]
    w = Window.partitionBy(*keys).orderBy(*order_exprs)
    name = rank_col or "_rn"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def latest_complete_per_key(df: DataFrame, keys: Sequence[str], ts: str,
                            required: Sequence[str]) -> DataFrame:
    """newest row per key among rows with all ``required`` present."""
    cond = F.lit(True)
    for c in required:
        cond = cond & F.col(c).isNotNull()
    return top_k_per_group(df.where(cond), keys, [F.col(ts).desc()], 1)


def calendar_features(df: DataFrame, ts: str) -> DataFrame:
    """Hour, day of week (1 = Sunday) and month of the timestamp."""
    return df.withColumns({
        "hour_utc": F.hour(ts),
        "day_of_week": F.dayofweek(ts),
        "month": F.month(ts),
    })
