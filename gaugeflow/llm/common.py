"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and fixes the rows: a lost executor costs a re-read, and
    every later use sees the same values. The files stay until the cluster's
    own retention of ``spark.checkpoint.dir`` removes them.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed_table(df: DataFrame, column: str, name: str) -> DataFrame:
    """``shared_table`` bucketed by ``column``: bringing equal values together
    later needs no shuffle. Buckets grow with the input's partitions. The name
    that bucketing needs in the catalog is given back at once; the files stay."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    table = "llm_" + path.rsplit("-", 1)[-1]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())
    (df.write.option("compression", "zstd").option("path", path).format("parquet")
     .bucketBy(min(buckets, 100_000), column).saveAsTable(table))  # Spark allows no more buckets
    stored = spark.table(table)
    stored.schema  # analysed before the name goes
    spark.sql(f"DROP TABLE {table}")
    return stored


def crc_fold(key: Column, modulus: int) -> Column:
    """crc32 of the key written as text, modulo ``modulus``; a null key is
    fold -1, which belongs to no fold."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % F.lit(modulus), F.lit(-1))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most ``rows`` rows, so that a batch of long texts
    stays a few megabytes in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name (names are
    compared as Spark does, ignoring case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
