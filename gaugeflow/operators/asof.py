"""Nearest-in-time (as-of) join with tolerance.

Spark has no as-of join. A window over the union of both sides gives the
previous and next right row of every left row in one sort; partitioning
that window by (keys, time bucket) instead of keys alone keeps a hot station
from landing in one task. Right rows within ``tolerance`` of a bucket edge
are copied into the neighbouring bucket, so every left row sees every right
row that could match it: the result equals the unpartitioned as-of join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _micros(c):
    return F.unix_micros(F.col(c).cast("timestamp")) if isinstance(c, str) else F.unix_micros(c.cast("timestamp"))


def asof_nearest(left: DataFrame, right: DataFrame, by: Sequence[str], left_ts: str, right_ts: str,
                 tolerance_seconds: int, right_cols: Sequence[str], prefix: str = "",
                 matched_ts_col: str = "matched_ts", bucket_seconds: int | None = None,
                 partitions: int | None = None) -> DataFrame:
    """For each left row, the right row with the same ``by`` keys whose time
    is nearest, if within ``tolerance_seconds`` (inclusive); ties go to the
    earlier right row. Left rows without a match are kept with nulls.

    Right rows should be unique per (by, time); the right time is returned
    as ``matched_ts_col``. ``bucket_seconds`` (default 8 x tolerance, at
    least one hour) sets the time slice per window partition, ``partitions``
    the number of tasks that sort them (default: the shuffle partitions).
    """
    by = list(by)
    tol_us = int(tolerance_seconds) * 1_000_000
    bucket_us = int(bucket_seconds or max(8 * int(tolerance_seconds), 3600)) * 1_000_000
    bucket_us = max(bucket_us, tol_us, 1)

    lt = _micros(left_ts)
    l = left.select(*[F.col(k).alias(f"_by{i}") for i, k in enumerate(by)],
                    lt.alias("_t"), F.lit(1).alias("_side"),
                    F.floor(lt / F.lit(bucket_us)).alias("_bucket"),
                    F.struct(*[F.col(c) for c in left.columns]).alias("_l"))

    rt = _micros(right_ts)
    home = F.floor(rt / F.lit(bucket_us))
    copies = F.array_distinct(F.array(
        home,
        F.when(rt >= (home + 1) * F.lit(bucket_us) - F.lit(tol_us), home + 1).otherwise(home),
        F.when(rt < home * F.lit(bucket_us) + F.lit(tol_us), home - 1).otherwise(home)))
    payload = F.struct(rt.alias("t"), F.col(right_ts).alias("ts"), *[F.col(c).alias(c) for c in right_cols])
    r = right.where(F.col(right_ts).isNotNull()).select(
        *[F.col(k).alias(f"_by{i}") for i, k in enumerate(by)],
        rt.alias("_t"), F.lit(0).alias("_side"), F.explode(copies).alias("_bucket"),
        payload.alias("_r"))

    u = l.unionByName(r, allowMissingColumns=True)
    keys = [f"_by{i}" for i in range(len(by))] + ["_bucket"]
    if partitions:
        u = u.repartition(partitions, *keys)
    w = Window.partitionBy(*keys).orderBy("_t", "_side")
    back = F.last("_r", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # the next right row is the last one seen in descending time: a running frame,
    # linear in the rows of a partition, on the same shuffle
    back_in_time = Window.partitionBy(*keys).orderBy(F.desc("_t"), "_side")
    fwd = F.last("_r", ignorenulls=True).over(back_in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cand = u.select("_side", "_t", "_l", back.alias("_b"), fwd.alias("_f")).where(F.col("_side") == 1)

    db = F.col("_t") - F.col("_b.t")
    df_ = F.col("_f.t") - F.col("_t")
    b_ok = F.col("_b").isNotNull() & (db <= F.lit(tol_us))
    f_ok = F.col("_f").isNotNull() & (df_ <= F.lit(tol_us))
    chosen = (F.when(b_ok & (~f_ok | (db <= df_)), F.col("_b"))
               .when(f_ok, F.col("_f")))
    out = cand.withColumn("_m", chosen)
    return out.select("_l.*", F.col("_m.ts").alias(matched_ts_col),
                      *[F.col(f"_m.{c}").alias(f"{prefix}{c}") for c in right_cols])

