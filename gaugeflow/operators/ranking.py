"""Exact, skew-safe row numbering.

Spark's ``row_number().over(Window.partitionBy(k).orderBy(t))`` sends every
row of a key to one task; with one station holding a third of the data that
task holds a third of the table, and a window with no ``partitionBy`` holds
all of it. ``rank_within`` gives the same numbers without that:

1. range-partition on (keys, order) so a hot key spans many partitions, sort
   inside each partition and stamp each row with its partition id and a
   position (``monotonically_increasing_id``);
2. count rows per (key, partition) -- a table of at most #keys + #partitions
   rows -- and turn the counts into per-key offsets;
3. rank = offset of (key, partition) + position inside the partition.

The stamped frame is reliably checkpointed (written once to
``spark.checkpoint.dir``) so that both consumers read the same partitioning
and positions, and a lost executor re-reads the checkpoint instead of
recomputing the range shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return int(partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                rank_col: str = "_rank", count_col: str | None = "_group_rows",
                partitions: int | None = None) -> DataFrame:
    """Add a 0-based ``rank_col`` (row number within ``keys`` under ``order``)
    and, optionally, ``count_col`` (rows in the key group).

    ``order`` items are column names or sort columns (``F.col(x).desc()``).
    Ties get distinct, arbitrary-but-consistent numbers, as ``row_number``.
    """
    keys = list(keys)
    order_exprs = [F.col(o) if isinstance(o, str) else o for o in order]
    key_exprs = [F.col(k) for k in keys]
    n = _partitions(df, partitions)
    ensure_checkpoint_dir(df.sparkSession)
    stamped = (df.repartitionByRange(n, *key_exprs, *order_exprs)
                 .sortWithinPartitions(*key_exprs, *order_exprs)
                 .withColumn("_pid", F.spark_partition_id())
                 .withColumn("_pos", F.monotonically_increasing_id())
                 .checkpoint(eager=True))
    stats = stamped.groupBy(*keys, "_pid").agg(
        F.min("_pos").alias("_base"), F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
    if count_col:
        stats = stats.withColumn(count_col, F.sum("__rows").over(Window.partitionBy(*keys)))
    stats = stats.drop("__rows")
    renamed = stats.select(*[F.col(k).alias(f"_k_{i}") for i, k in enumerate(keys)],
                           *[c for c in stats.columns if c not in keys])
    cond = [stamped["_pid"] == renamed["_pid"]]
    cond += [stamped[k].eqNullSafe(renamed[f"_k_{i}"]) for i, k in enumerate(keys)]
    out = stamped.join(renamed, cond, "inner")
    out = out.withColumn(rank_col, F.col("_off") + stamped["_pos"] - F.col("_base"))
    drop = ["_base", "_off", "_pos"] + [f"_k_{i}" for i in range(len(keys))]
    out = out.drop(renamed["_pid"]).drop(*drop).drop("_pid")
    return out


def global_rank(df: DataFrame, order: Sequence[str | Column], rank_col: str = "_rank",
                count_col: str | None = "_total_rows", partitions: int | None = None) -> DataFrame:
    """0-based position of each row in a total order, without a
    single-partition window over the data (the offsets tables have one row
    per day or per partition). A single time column is ranked with per-day
    counts (``rank_in_time``); other orders use ``rank_within``."""
    if len(order) == 1 and isinstance(order[0], str) and \
            df.schema[order[0]].dataType.simpleString() in ("timestamp", "timestamp_ntz", "date"):
        out = rank_in_time(df, [], order[0], rank_col=rank_col)
        if count_col:
            out = out.crossJoin(F.broadcast(df.agg(F.count(F.lit(1)).alias(count_col))))  # one row
        return out
    return rank_within(df, [], order, rank_col=rank_col, count_col=count_col, partitions=partitions)


def _value_slice(value: Column) -> Column:
    """Monotone slice number of a value: about a million slices for each
    factor e, whatever the data, so no job has to look at them first."""
    v = value.cast("double")
    return (F.signum(v) * F.floor(F.log1p(F.abs(v)) * F.lit(float(1 << 20)))).cast("long")


def exact_quantile(df: DataFrame, keys: Sequence[str], value: str, q: float,
                   alias: str | None = None) -> DataFrame:
    """Exact continuous quantile (linear interpolation, as ``percentile`` /
    DuckDB ``quantile_cont``) of ``value`` per key group, nulls ignored.

    Rows become (key, value, count) by a partial aggregate, so a value that
    half of all rows share is one row. Counts are summed by slices of the
    value, running totals over that small table tell which slices hold the two
    bracketing ranks, and only the distinct values of those slices are put in
    order.
    """
    keys = list(keys)
    alias = alias or f"{value}_q{int(round(q * 100))}"
    v = F.col(value).cast("double")
    distinct = (df.where(F.col(value).isNotNull()).groupBy(*keys, (v + F.lit(0.0)).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
                  .withColumn("_s", _value_slice(F.col("_v"))))
    names = [f"_k_{i}" for i in range(len(keys))]
    slices = distinct.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("_s").alias("_s2")).agg(
        F.sum("_n").alias("_sn"))
    whole = Window.partitionBy(*names)
    slices = (slices.withColumn("_upto", F.sum("_sn").over(whole.orderBy("_s2")))
                    .withColumn("_pos", (F.sum("_sn").over(whole) - 1) * F.lit(float(q)))
                    .withColumn("_before", F.col("_upto") - F.col("_sn"))
                    .withColumns({"_lo": F.floor("_pos"), "_hi": F.ceil("_pos")})
                    .where((F.col("_before") <= F.col("_hi")) & (F.col("_lo") < F.col("_upto"))))
    cond = [distinct["_s"] == slices["_s2"]] + [distinct[k].eqNullSafe(slices[n]) for k, n in zip(keys, names)]
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy(*keys, "_s").orderBy("_v"))
    near = (distinct.join(slices, cond).withColumn("_end", upto).withColumn("_begin", F.col("_end") - F.col("_n")))
    holds = lambda rank: (F.col("_begin") <= F.col(rank)) & (F.col(rank) < F.col("_end"))
    agg = near.groupBy(*keys).agg(
        F.max(F.when(holds("_lo"), F.col("_v"))).alias("_vlo"), F.max(F.when(holds("_hi"), F.col("_v"))).alias("_vhi"),
        F.max("_pos").alias("_pos"), F.max("_lo").alias("_lo"))
    return agg.select(*keys, (F.col("_vlo") + (F.col("_pos") - F.col("_lo")) * (F.col("_vhi") - F.col("_vlo"))).alias(alias))


def rank_in_time(df: DataFrame, keys: Sequence[str], ts: str, bucket_seconds: int = 86_400,
                 rank_col: str = "_rank", tiebreak: Sequence[str] = ()) -> DataFrame:
    """0-based row number within ``keys`` ordered by the time column ``ts``
    (then ``tiebreak``), for time series -- without a checkpoint.

    Rows are counted per (key, time bucket) with a partial aggregate; a
    window over that small table (one row per key and bucket) turns the
    counts into offsets; the offsets are joined back on (key, bucket) and
    ``row_number`` runs per (key, bucket), which the join's partitioning
    already satisfies. A hot key is split into its time buckets. Ranks are
    deterministic when (keys, ts, tiebreak) is unique.
    """
    keys = list(keys)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    d = df.withColumn("_tb", F.floor(us / F.lit(int(bucket_seconds) * 1_000_000)).cast("long"))
    counts = d.groupBy(*keys, "_tb").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(*keys).orderBy("_tb").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(*[F.col(k).alias(f"_k_{i}") for i, k in enumerate(keys)], F.col("_tb").alias("_tb2"),
                         F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("_off"))
    cond = [d["_tb"].eqNullSafe(offs["_tb2"])] + [d[k].eqNullSafe(offs[f"_k_{i}"]) for i, k in enumerate(keys)]
    j = d.join(offs, cond, "inner")
    w = Window.partitionBy(*keys, "_tb").orderBy(F.col(ts), *[F.col(c) for c in tiebreak])
    out = j.withColumn(rank_col, F.col("_off") + F.row_number().over(w) - 1)
    return out.drop("_tb", "_tb2", "_off", *[f"_k_{i}" for i in range(len(keys))])
