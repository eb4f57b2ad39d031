"""Readers for landed raw files.

Every reader is a Spark scan: files are split across tasks by Spark, and
all parsing after the byte level (trimming, null tokens, casts, time
parsing) is done with built-in expressions. The only Python worker code is
the unzip of product archives (A4), a ``mapInPandas`` that turns one zip
member into text rows.
"""

from __future__ import annotations

import io
import itertools
import re
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import local_to_utc, pad_id, parse_hour_stamp, record_hash

# ------------------------------------------------------------------ A1 station JSON

MEASUREMENT = T.StructType([T.StructField("timestamp", T.StringType()), T.StructField("value", T.DoubleType())])
TIMESERIES = T.StructType([T.StructField("shortname", T.StringType()), T.StructField("unit", T.StringType()),
                           T.StructField("measurements", T.ArrayType(MEASUREMENT))])
STATION_PAYLOAD = T.StructType([
    T.StructField("uuid", T.StringType()), T.StructField("shortname", T.StringType()),
    T.StructField("longname", T.StringType()), T.StructField("number", T.StringType()),
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("timeseries", T.ArrayType(TIMESERIES)),
])


def read_station_payload(spark: SparkSession, path: str, series: str = "W", source: str = "gauge_feed",
                         ingestion_ts: str | None = None) -> DataFrame:
    """A1: landed station JSON (one station object per line, timeseries with
    their measurements) -> one row per measurement of series ``series``.

    Rows without a timestamp are dropped; the station name is shortname, else
    longname, else "unknown". Timestamps are ISO text with an offset and are
    converted to UTC instants.
    """
    raw = spark.read.schema(STATION_PAYLOAD).json(path)
    ts = raw.select("*", F.explode_outer("timeseries").alias("_ts")).where(F.col("_ts.shortname") == series)
    m = ts.select("*", F.explode("_ts.measurements").alias("_m")).where(F.col("_m.timestamp").isNotNull())
    ing = F.lit(ingestion_ts).cast("timestamp") if ingestion_ts else F.current_timestamp()
    out = m.select(
        F.coalesce(F.col("uuid"), F.lit("")).alias("station_id"),
        F.coalesce(F.col("shortname"), F.col("longname"), F.lit("unknown")).alias("station_name"),
        F.coalesce(F.col("_ts.shortname"), F.lit("unknown")).alias("timeseries_name"),
        F.to_timestamp(F.col("_m.timestamp")).alias("timestamp_utc"),
        F.col("_m.value").alias("value"),
        F.col("_ts.unit").alias("unit"),
        "latitude", "longitude",
        ing.alias("ingestion_ts_utc"),
        F.lit(source).alias("source"),
        F.input_file_name().alias("source_url"),
    )
    return out.withColumn("source_record_hash",
                          record_hash(["station_id", "timeseries_name", "timestamp_utc", "value", "source"]))


# ------------------------------------------------------------------ A2/A3 archive CSV

def read_archive_csv(spark: SparkSession, path: str, tz: str = "Europe/Berlin",
                     ts_format: str = "yyyy-MM-dd HH:mm") -> DataFrame:
    """A2: ``timestamp;value`` archive files: malformed lines skipped,
    decimal comma accepted, local wall time converted to UTC (ambiguous ->
    standard time, gap -> shifted forward), rows without time or value
    dropped. Adds the file path (``source_file``) for station attribution."""
    schema = T.StructType([T.StructField("timestamp", T.StringType()), T.StructField("value", T.StringType()),
                           T.StructField("_corrupt", T.StringType())])
    raw = (spark.read.schema(schema).option("sep", ";").option("header", "true").option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt").csv(path))
    raw = raw.where(F.col("_corrupt").isNull()).drop("_corrupt")
    local = F.try_to_timestamp(F.trim("timestamp"), F.lit(ts_format))
    value = F.regexp_replace(F.trim("value"), ",", ".").try_cast("double")
    out = raw.select(local_to_utc(local, tz).alias("timestamp_utc"), value.alias("value"),
                     F.col("_metadata.file_path").alias("source_file"))
    return out.where(F.col("timestamp_utc").isNotNull() & F.col("value").isNotNull())


def normalize_archive(df: DataFrame, station_id: str | Column, station_name: str | Column,
                      timeseries_name: str = "W", unit: str = "cm", source_url: str | Column = "",
                      ingestion_ts: str | None = None, ts_col: str | None = None, value_col: str | None = None,
                      source: str = "gauge_feed") -> DataFrame:
    """A3: find the time and value columns case-insensitively (``timestamp``
    or ``date``; ``value``), falling back to the first two columns, attach
    the station columns (constants, or per-row columns such as an id taken
    from the file path) and the record hash."""
    lower = {c.lower().strip(): c for c in df.columns}
    tcol = ts_col or lower.get("timestamp_utc") or lower.get("timestamp") or lower.get("date") or df.columns[0]
    vcol = value_col or lower.get("value") or df.columns[1]
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    ing = F.lit(ingestion_ts).cast("timestamp") if ingestion_ts else F.current_timestamp()
    out = df.select(lit(station_id).cast("string").alias("station_id"),
                    lit(station_name).cast("string").alias("station_name"),
                    F.lit(timeseries_name).alias("timeseries_name"),
                    F.col(tcol).cast("timestamp").alias("timestamp_utc"),
                    F.col(vcol).try_cast("double").alias("value"),
                    F.lit(unit).alias("unit"), F.lit(None).cast("double").alias("latitude"),
                    F.lit(None).cast("double").alias("longitude"), ing.alias("ingestion_ts_utc"),
                    F.lit(source).alias("source"), lit(source_url).cast("string").alias("source_url"))
    return out.withColumn("source_record_hash",
                          record_hash(["station_id", "timeseries_name", "timestamp_utc", "value", "source"]))


# ------------------------------------------------------------------ A4 product zips

# Raw columns of the hourly product files, and null tokens.
PRODUCT_COLUMNS = ("STATIONS_ID", "MESS_DATUM", "QN_8", "QN_9", "TT_TU", "RF_TU", "R1", "RSK", "F", "P0", "PP_10")
NULL_TOKENS = ("", "-999", "-999.0", "####")
# Lines of a product member sent to Spark at a time.
LINE_BATCH = 20_000


def _product_lines_fn():
    """Executor-side unzip, built as a closure so it is shipped by value and
    the workers need no import of this package: (path, bytes) of an archive ->
    (path, header, line) of its product member, streamed in batches."""
    def unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive in batch.itertuples(index=False):
                with zipfile.ZipFile(io.BytesIO(archive.content)) as zf:
                    product = next((m for m in zf.infolist() if re.fullmatch(r"produkt_.*\.txt", m.filename, re.I)), None)
                    if product is None:
                        raise ValueError(f"{archive.path}: no product member in the archive")
                    lines = io.TextIOWrapper(zf.open(product), encoding="latin1")
                    header = next(lines, "").strip()
                    while chunk := [x.rstrip("\r\n") for x in itertools.islice(lines, LINE_BATCH)]:
                        yield pd.DataFrame({"path": archive.path, "header": header, "line": chunk})
    return unzip


def read_product_zip(spark: SparkSession, path: str, file_filter: Column | None = None) -> DataFrame:
    """A4: zip archives -> raw product rows with trimmed strings and the null
    tokens ("", -999, -999.0, ####) turned into nulls. An archive without a
    product member raises.

    ``binaryFile`` lists the archives (one per task at most -- zips are not
    splittable). A ``file_filter`` over ``FILE_NAME`` (see ``prune_files``) is
    applied to the listing, so only the archives that pass are read at all.
    Workers only unzip; the lines are parsed in Spark, each
    column found by its name in the member's header."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    if file_filter is not None:
        files = files.where(file_filter)
    lines = files.select("path", "content").mapInPandas(_product_lines_fn(), "path string, header string, line string")
    split = lines.where(F.trim("line") != "").select(
        "path", F.transform(F.split("header", ";"), lambda x: F.trim(x)).alias("names"),
        F.transform(F.split("line", ";"), lambda x: F.trim(x)).alias("cells"))

    def cell(name: str) -> Column:
        text = F.get("cells", F.array_position("names", F.lit(name)).cast("int") - 1)
        return F.when(~text.isin(list(NULL_TOKENS)), text).alias(name)

    return split.select("path", *map(cell, PRODUCT_COLUMNS))


# Which raw columns feed which canonical measure, per family.
FAMILY_COLUMNS = {
    "air_temperature": {"temperature_c": ("TT_TU",), "relative_humidity_pct": ("RF_TU",)},
    "precipitation": {"precipitation_mm": ("R1", "RSK")},
    "wind": {"wind_speed_ms": ("F",)},
    "pressure": {"pressure_hpa": ("P0", "PP_10")},
}
CANONICAL_MEASURES = ("temperature_c", "precipitation_mm", "wind_speed_ms", "pressure_hpa", "relative_humidity_pct")


def canonical_measures(raw: DataFrame, family: str | Column, source_url: str | Column | None = None,
                       ingestion_ts: str | None = None) -> DataFrame:
    """B8 (+B5, B6, B7): raw product rows -> canonical hourly observation
    rows: padded station id, parsed hour stamp, quality flag (QN_9 else
    QN_8), the family's measures (first present alternative column), others
    null, and the record hash."""
    fam = F.lit(family) if isinstance(family, str) else family
    meas = {}
    for m in CANONICAL_MEASURES:
        expr = F.lit(None).cast("double")
        for f, cols in FAMILY_COLUMNS.items():
            if m in cols:
                expr = F.when(fam == f, F.coalesce(*[F.col(c).try_cast("double") for c in cols[m]])).otherwise(expr)
        meas[m] = expr
    ing = F.lit(ingestion_ts).cast("timestamp") if ingestion_ts else F.current_timestamp()
    src = F.col("path") if source_url is None else (F.lit(source_url) if isinstance(source_url, str) else source_url)
    out = raw.select(
        pad_id(F.col("STATIONS_ID"), 5).alias("dwd_station_id"),
        parse_hour_stamp(F.col("MESS_DATUM")).alias("timestamp_utc"),
        ing.alias("ingestion_ts_utc"), F.lit("weather_feed").alias("source"), src.alias("source_url"),
        F.coalesce(F.col("QN_9"), F.col("QN_8")).alias("quality_flag"), fam.alias("variable_family"),
        *[v.alias(k) for k, v in meas.items()])
    return out.withColumn("source_record_hash",
                          record_hash(["dwd_station_id", "timestamp_utc", *CANONICAL_MEASURES, "source"]))


def family_from_path(path_col: Column) -> Column:
    """Variable family from the archive name (``..._TU_``, ``_RR_``, ``_FF_``, ``_P0_``)."""
    code = F.regexp_extract(path_col, r"stundenwerte_([A-Z0-9]+)_", 1)
    return (F.when(code == "TU", "air_temperature").when(code == "RR", "precipitation")
             .when(code == "FF", "wind").when(code == "P0", "pressure"))


# ------------------------------------------------------------------ A5 station description

def read_station_description(spark: SparkSession, path: str, encoding: str = "iso-8859-1") -> DataFrame:
    """A5: fixed-width-ish station list: header lines (first token not a
    number) and rows with fewer than 8 whitespace tokens are dropped; name =
    tokens 7..n-1, region = last token."""
    # the text source is UTF-8 only; the CSV source with a separator that never
    # occurs reads whole lines in the file's own encoding
    lines = (spark.read.schema("value string").option("encoding", encoding).option("sep", "\u0001")
             .option("quote", "").csv(path))
    toks = lines.select(F.split(F.trim(F.col("value")), r"\s+").alias("t"))
    toks = toks.where((F.size("t") >= 8) & F.col("t")[0].rlike(r"^\d+$"))
    n = F.size("t")
    return toks.select(
        F.col("t")[0].alias("station_id"), F.col("t")[1].alias("from_date"), F.col("t")[2].alias("to_date"),
        F.col("t")[3].try_cast("double").alias("height_m"), F.col("t")[4].try_cast("double").alias("latitude"),
        F.col("t")[5].try_cast("double").alias("longitude"),
        F.array_join(F.slice("t", 7, n - 7), " ").alias("station_name"),
        F.element_at("t", -1).alias("region"))


# ------------------------------------------------------------------ A6 file pruning

#: The name in the file listing: a filter on it drops files before they are read.
FILE_NAME = "_metadata.file_name"


def prune_files(file_name: Column, start_date: str | None = None, ids: Sequence[str] | None = None) -> Column:
    """Predicate on an archive's file name: its 5-digit station id is in
    ``ids`` (when given) and its end date (``_YYYYMMDD_YYYYMMDD_``) is on or
    after ``start_date``; names without a date range are kept."""
    cond = F.lit(True)
    if ids is not None:
        sid = F.regexp_extract(file_name, r"_(\d{5})_", 1)
        cond = cond & sid.isin([str(i).zfill(5) for i in ids])
    if start_date:
        end = F.regexp_extract(file_name, r"_(\d{8})_(\d{8})_", 2)
        cond = cond & ((end == "") | (F.try_to_date(end, "yyyyMMdd") >= F.to_date(F.lit(start_date))))
    return cond
