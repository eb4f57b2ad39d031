"""Projection, filtering and cleaning operators (section B).

All are row-local expressions (no shuffle) except the few that need a
scalar over the whole input (B14, B17: a one-row aggregate joined back as a
broadcast -- its size is one row by construction) or a per-group statistic
(B18, B19: partial aggregates + semi join).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import normalize_name


def coerce(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """B1: cast listed columns; values that do not fit become null.

    Timestamps accept ISO text; numbers accept text with surrounding blanks.
    """
    out = {}
    for c, t in types.items():
        if c not in df.columns:
            continue
        src = F.col(c)
        is_text = df.schema[c].dataType.simpleString() == "string"
        if t in ("timestamp", "timestamp_ntz") and is_text:
            out[c] = F.try_to_timestamp(F.trim(src)).cast(t)
        elif is_text:
            out[c] = F.trim(src).try_cast(t)
        else:
            out[c] = src.try_cast(t)
    return df.withColumns(out)


def curate(df: DataFrame, value: str = "value", lo: float = -1000.0, hi: float = 2000.0) -> DataFrame:
    """B2: safe-cast the value, drop nulls, keep ``lo <= value <= hi``."""
    v = F.col(value).try_cast("double")
    return df.withColumn(value, v).where(F.col(value).isNotNull() & F.col(value).between(lo, hi))


def date_window(df: DataFrame, ts: str, start: str | None, end: str | None,
                end_cap: str | None = None) -> DataFrame:
    """Keep rows whose UTC date is within [start, end] (inclusive);
    ``end`` is capped at ``end_cap`` when given.

    Written as a range on the raw timestamp (``start <= ts < end + 1 day``)
    rather than on ``to_date(ts)`` so the bounds are pushed into the parquet
    scan (row-group skipping, partition pruning)."""
    tt = df.schema[ts].dataType
    cond = F.lit(True)
    if start:
        cond = cond & (F.col(ts) >= F.lit(start).cast("date").cast(tt))
    if end:
        last = min(end, end_cap) if end_cap else end
        cond = cond & (F.col(ts) < F.date_add(F.lit(last).cast("date"), 1).cast(tt))
    return df.where(cond)


def newer_than(df: DataFrame, ts: str, high_water_mark: str | None) -> DataFrame:
    """Rows strictly newer than a stored high-water mark; no mark -> all."""
    if high_water_mark is None:
        return df
    return df.where(F.col(ts) > F.lit(high_water_mark).cast(df.schema[ts].dataType))


def _as_literal(value: Column, frame: DataFrame, kind) -> Column | None:
    """A one-row aggregate's value as a literal, so that a filter on it is
    pushed into the scan; None where it is null. Fetched as text: exact, and
    the same whatever the driver's own time zone."""
    text = frame.select(value.cast("string")).first()
    return None if text is None or text[0] is None else F.lit(text[0]).cast(kind)


def newer_than_table(df: DataFrame, ts: str, marks: DataFrame, mark_col: str) -> DataFrame:
    """B14 with the mark held in a table: its maximum, read first, as a
    literal that prunes the scan; an empty table keeps every row."""
    mark = _as_literal(F.max(mark_col), marks, df.schema[ts].dataType)
    return df if mark is None else df.where(F.col(ts) > mark)


def high_water_marks(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Newest ``ts`` of every key, as ``high_water_mark``."""
    return df.groupBy(*keys).agg(F.max(ts).alias("high_water_mark"))


def from_marks_on(df: DataFrame, keys: Sequence[str], ts: str, marks: DataFrame) -> DataFrame:
    """B14 with a mark for each key: rows at or after their key's mark, and
    all rows of keys without one. A key that lags behind the others loses
    nothing, and a corrected row at the mark itself is kept."""
    m = marks.select(*[F.col(k).alias(f"_mark_{k}") for k in keys], F.col("high_water_mark").alias("_mark"))
    same = [F.col(k).eqNullSafe(F.col(f"_mark_{k}")) for k in keys]
    kept = df.join(m, same, "left").where(F.col("_mark").isNull() | (F.col(ts) >= F.col("_mark")))
    return kept.select(*df.columns)


def null_fraction(cols: Sequence[str]) -> Column:
    """Share of the listed columns that are null in this row."""
    if not cols:
        return F.lit(0.0)
    s = sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))
    return s / F.lit(float(len(cols)))


def drop_sparse_rows(df: DataFrame, cols: Sequence[str], max_null_fraction: float = 0.35) -> DataFrame:
    """Keep rows whose share of null features is at most the limit."""
    return df.where(null_fraction(cols) <= F.lit(max_null_fraction))


def require_complete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any listed column."""
    return df.dropna(subset=list(cols))


def last_n_months(df: DataFrame, ts: str, months: int) -> DataFrame:
    """Rows at or after max(ts) minus ``months`` calendar months (the time
    of day stays). The cutoff is read first and prunes the scan."""
    kind = df.schema[ts].dataType
    cut = F.max(ts) - F.make_ym_interval(F.lit(0), F.lit(int(months)))
    found = _as_literal(cut, df, kind)
    return df.limit(0) if found is None else df.where(F.col(ts) >= found)


def eligible_groups(df: DataFrame, key: str, cols: Sequence[str], min_complete_ratio: float,
                    min_rows: int) -> DataFrame:
    """Keep rows of groups with enough fully populated rows (``cols`` all
    non-null) that are a high enough share of all their rows."""
    complete = F.lit(True)
    for c in cols:
        complete = complete & F.col(c).isNotNull()
    stats = (df.groupBy(key)
               .agg(F.count_if(complete).alias("_n"), F.avg(complete.cast("double")).alias("_ratio"))
               .where((F.col("_n") >= min_rows) & (F.col("_ratio") >= min_complete_ratio))
               .select(key))
    return df.join(stats, key, "left_semi")


def top_groups(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows of the ``n`` largest groups (ties: smaller key first).

    Group sizes are a partial aggregate; only the n chosen keys travel to the
    semi join (their count is n by construction, so broadcasting is safe).
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    chosen = sizes.orderBy(F.col("_n").desc(), F.col(key).asc()).limit(n).select(key)
    return df.join(F.broadcast(chosen), key, "left_semi")


def model_view(df: DataFrame, columns: Sequence[str], value: str = "value",
               target: str = "target_value") -> DataFrame:
    """Rename value to target, keep a fixed column list (missing ones
    skipped), drop rows without a target."""
    renamed = df.withColumnRenamed(value, target)
    keep = [c for c in columns if c in renamed.columns]
    return renamed.select(*keep).where(F.col(target).isNotNull())


def scope_by_list(df: DataFrame, name_col: str, allow: Sequence[str] | None = None,
                  deny: Sequence[str] | None = None, mode: str = "upper_trim") -> DataFrame:
    """Allow-list minus deny-list on the normalised name. The lists are
    literal config values, so ``isin`` keeps them in the plan."""
    key = normalize_name(F.col(name_col), mode)
    out = df
    if allow:
        out = out.where(key.isin([a.strip().upper() for a in allow]))
    if deny:
        out = out.where(~key.isin([d.strip().upper() for d in deny]))
    return out


def present(df: DataFrame, round_cols: Sequence[str] = (), ts_cols: Sequence[str] = (),
            digits: int = 2, ts_format: str = "yyyy-MM-dd HH:mm") -> DataFrame:
    """Presentation edge -- round doubles, timestamps to text."""
    repl = {c: F.round(F.col(c), digits) for c in round_cols if c in df.columns}
    repl.update({c: F.date_format(F.col(c), ts_format) for c in ts_cols if c in df.columns})
    return df.withColumns(repl)


def scope_fuzzy(df: DataFrame, id_col: str, name_col: str, ids: Sequence[str] | None = None,
                names: Sequence[str] | None = None) -> DataFrame:
    """An id list wins; otherwise keep rows whose upper-cased name
    contains any configured name, also in its umlaut spelling (OE->Ö,
    UE->Ü, AE->Ä). The name list is literal config, so the theta join
    broadcasts a side whose size is the list length."""
    if ids:
        return df.where(F.col(id_col).isin([str(i) for i in ids]))
    if not names:
        return df
    from ..functions.scalars import umlaut_variants
    spark = df.sparkSession
    pats = spark.createDataFrame([(n.strip().upper(),) for n in names], "_pat string") \
                .select(F.explode(umlaut_variants(F.col("_pat"))).alias("_pat")).distinct()
    return df.join(F.broadcast(pats), F.upper(F.col(name_col)).contains(F.col("_pat")), "left_semi")


def scoped_station_meta(meta: DataFrame, key: str = "station_id", family: str = "family",
                        ids: Sequence[str] | None = None, min_families: int = 1, max_n: int | None = None,
                        family_order: Sequence[str] = ("air_temperature", "precipitation", "wind", "pressure")) -> DataFrame:
    """Per station (metadata unioned over families): number of distinct
    families and the metadata row of its first family in ``family_order``
    (ties broken by the remaining columns, ascending).
    With ``ids``: those stations in list order (``scope_rank``); otherwise
    stations with at least ``min_families`` families, most families first,
    the first ``max_n``."""
    fam_rank = F.coalesce(F.array_position(F.array(*[F.lit(f) for f in family_order]), F.col(family)),
                          F.lit(len(family_order) + 1))
    cols = [c for c in meta.columns if c != key]
    per = meta.groupBy(key).agg(F.count_distinct(family).alias("family_count"),
                                F.min_by(F.struct(*[F.col(c) for c in cols]),
                                         F.struct(fam_rank, *[F.col(c) for c in cols]))
                                .alias("_first"))
    per = per.select(key, "family_count", *[F.col(f"_first.{c}").alias(c) for c in cols])
    if ids:
        pos = F.array_position(F.array(*[F.lit(str(i)) for i in ids]), F.col(key).cast("string"))
        return per.withColumn("scope_rank", pos).where(F.col("scope_rank") > 0)
    out = per.where(F.col("family_count") >= min_families)
    if max_n:
        out = out.orderBy(F.col("family_count").desc(), F.col(key).asc()).limit(max_n)
    return out
