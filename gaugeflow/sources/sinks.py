"""Sinks and table access.

All writes are Spark writers (each task writes its own files, no data on the
driver). Timestamps are UTC; the session time zone is pinned to UTC.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Columnar snapshot."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines; timestamps as ``yyyy-MM-ddTHH:mm:ss.SSSSSSZ`` (UTC) and
    null fields written out."""
    (df.write.mode(mode).option("ignoreNullFields", "false")
       .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
       .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").json(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Artefact table with a header row."""
    df.write.mode(mode).option("header", "true").csv(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Coerce to a target schema: listed columns safe-cast (bad -> null),
    missing columns null, extra columns dropped."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def append_table(df: DataFrame, path: str, schema: T.StructType | None = None, fmt: str = "parquet",
                 partition_by: Sequence[str] = ()) -> bool:
    """A10: coerce to the table schema and append; an empty frame is skipped.
    Returns whether anything was written. The emptiness probe reads one row."""
    out = conform(df, schema) if schema is not None else df
    if out.isEmpty():
        return False
    w = out.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return True


def replace_table(df: DataFrame, path: str, mode: str = "replace", fmt: str = "parquet") -> None:
    """``replace`` overwrites, ``append`` appends, anything else fails."""
    if mode not in ("replace", "append"):
        raise ValueError(f"unsupported write mode {mode!r}")
    df.write.mode("overwrite" if mode == "replace" else "append").format(fmt).save(path)


def load_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: str | Column | None = None,
               order_by: Sequence[str] | None = None, allow_missing: bool = True, fmt: str = "parquet") -> DataFrame:
    """Tolerant projection: unknown requested columns are dropped (or an
    error when ``allow_missing`` is false); none left -> all columns. The
    projection and filter reach the scan (column pruning, pushed filters)."""
    df = spark.read.format(fmt).load(path)
    if columns:
        present = [c for c in columns if c in df.columns]
        missing = [c for c in columns if c not in df.columns]
        if missing and not allow_missing:
            raise ValueError(f"missing columns {missing}")
        if present:
            df = df.select(*present)
    if where is not None:
        df = df.where(where)
    if order_by:
        df = df.orderBy(*order_by)
    return df


def write_partitioned_by_day(df: DataFrame, path: str, ts: str, cluster_by: Sequence[str] = (),
                             mode: str = "overwrite") -> None:
    """Partition by the event date (readers filter on event time, so
    partition pruning applies) and cluster rows by key inside each file."""
    out = df.withColumn("event_date", F.to_date(ts))
    out = out.repartition("event_date", *cluster_by).sortWithinPartitions(*cluster_by, ts) if cluster_by else out
    out.write.mode(mode).partitionBy("event_date").parquet(path)


RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("job_type", T.StringType()),
    T.StructField("started_at_utc", T.TimestampType()), T.StructField("ended_at_utc", T.TimestampType()),
    T.StructField("duration_seconds", T.DoubleType()), T.StructField("status", T.StringType()),
    T.StructField("error_type", T.StringType()), T.StructField("error_message", T.StringType()),
    T.StructField("rows_ingested", T.LongType()), T.StructField("rows_predicted", T.LongType()),
    T.StructField("stations_processed", T.LongType()),
])
STAGE_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("stage_name", T.StringType()), T.StructField("started_at_utc", T.TimestampType()),
    T.StructField("ended_at_utc", T.TimestampType()), T.StructField("status", T.StringType()),
    T.StructField("rows_read", T.LongType()), T.StructField("rows_written", T.LongType()),
    T.StructField("metadata_json", T.StringType()),
])

# Summary keys that can carry the rows-read count, in priority order.
ROWS_READ_KEYS = ("rows_read", "rows_fetched", "rows_loaded", "rows_ingested", "input_rows")


def stage_rows(summaries: DataFrame) -> DataFrame:
    """Stage-event rows from stage summaries: ``rows_read`` is the first
    non-null of several summary keys; the summary itself is kept as JSON."""
    present = [k for k in ROWS_READ_KEYS if k in summaries.columns]
    rows_read = F.coalesce(*[F.col(k).try_cast("long") for k in present]) if present else F.lit(None).cast("long")
    out = summaries.withColumn("rows_read", rows_read)
    out = out.withColumn("metadata_json", F.to_json(F.struct(*[F.col(c) for c in summaries.columns])))
    return conform(out, STAGE_SCHEMA)
