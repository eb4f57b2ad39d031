"""Dedup, upsert and latest-row operators.

"Newest row per key" is expressed as ``max_by(struct(*), order)`` in a
``groupBy``: the aggregate is partial (each map task keeps one candidate
per key), so a hot key costs one row per task in the shuffle instead of
sending the whole group to one window task. Ties on the order columns are
broken by the remaining columns of the ordering struct, so the result is
deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   nulls_keys_group: bool = True) -> DataFrame:
    """One row per key -- the largest under ``order`` (lexicographic,
    all descending). Null order values rank lowest, as ``DESC NULLS LAST``.

    Rows with null keys form their own groups (as a window partition does).
    """
    keys = list(keys)
    cols = df.columns
    payload = F.struct(*[F.col(c) for c in cols])
    order_s = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)])
    best = (df.groupBy(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)])
              .agg(F.max_by(payload, order_s).alias("_row")))
    return best.select("_row.*")


def latest_per_key_window(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """C1 as the textbook ``row_number() = 1`` window (kept for comparison
    and for orders that are not expressible as one struct)."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def rows_at_group_max(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Every row whose ``ts`` equals its group's maximum (ties kept).

    The group maxima are a partial aggregate joined back; no group is ever
    collected in one task.
    """
    keys = list(keys)
    mx = df.groupBy(*keys).agg(F.max(ts).alias("_mx"))
    return (df.join(mx, [df[k].eqNullSafe(mx[k]) for k in keys], "inner")
              .where(F.col(ts) == F.col("_mx"))
              .drop("_mx").drop(*[mx[k] for k in keys]))


def newest_overall(df: DataFrame, order: Sequence[Column], n: int = 1) -> DataFrame:
    """The newest row(s) overall (``ORDER BY .. LIMIT n``); plans as
    ``TakeOrderedAndProject`` -- a per-partition top-n, then a merge of
    n rows per partition."""
    return df.orderBy(*order).limit(n)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           order: Sequence[str | Column] | None = None) -> DataFrame:
    """MERGE semantics as a DataFrame.

    * updates are first reduced to the newest row per key (``order``);
    * a target row whose key matches an update is replaced by it (all
      non-key columns updated); unmatched updates are inserted;
    * NULL keys never match: such target rows stay and such updates are
      inserted as they are;
    * update columns not in the target are ignored, target columns missing
      from the updates become null.
    """
    keys = list(keys)
    missing = [k for k in keys if k not in updates.columns]
    if missing:
        raise ValueError(f"updates lack key columns {missing}")
    has_null_key = F.lit(False)
    for k in keys:
        has_null_key = has_null_key | F.col(k).isNull()
    upd_keyed = updates.where(~has_null_key)
    if order:
        upd_keyed = latest_per_key(upd_keyed, keys, order)

    def to_target(d: DataFrame) -> DataFrame:
        return d.select(*[F.col(c) if c in d.columns else F.lit(None).cast(target.schema[c].dataType).alias(c)
                          for c in target.columns])

    upd_keyed = to_target(upd_keyed)
    upd_nullkey = to_target(updates.where(has_null_key))
    kept = target.join(upd_keyed.select(*keys), keys, "left_anti")
    return kept.unionByName(upd_keyed).unionByName(upd_nullkey)


def union_latest(old: DataFrame, new: DataFrame, keys: Sequence[str],
                 order: Sequence[str | Column]) -> DataFrame:
    """Union by name (columns may differ) and keep the newest row per
    key."""
    u = old.unionByName(new, allowMissingColumns=True)
    return latest_per_key(u, keys, order)


def dedupe_history(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   station_col: str) -> DataFrame:
    """C4: newest row per key among rows with a station; rows whose station
    is blank or null pass through untouched."""
    blank = F.col(station_col).isNull() | (F.trim(F.col(station_col)) == "")
    named = latest_per_key(df.where(~blank), keys, order)
    return named.unionByName(df.where(blank))
