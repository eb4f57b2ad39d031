"""Set operations (section H)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def union_by_name(a: DataFrame, b: DataFrame, allow_missing: bool = False) -> DataFrame:
    """H1/H2: UNION ALL matched by column name (missing columns null when
    ``allow_missing``)."""
    return a.unionByName(b, allowMissingColumns=allow_missing)


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """DISTINCT over the given columns (partial aggregation)."""
    return (df.select(*cols) if cols else df).distinct()


def drop_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """H4: ``SELECT * EXCEPT(cols)``."""
    return df.drop(*cols)


def ordered(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """The rows in a total order, for results that are read in it. Spark
    range-partitions on the order and sorts each part, so no task holds more
    than its range; do it last, on results."""
    return df.orderBy(*order)
