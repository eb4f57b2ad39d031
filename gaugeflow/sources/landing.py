"""Landing raw files in the layouts the readers consume.

Used to land data Spark derives from other tables (and by tests) in the
shared folder. JSON and CSV are written by Spark's own writers; product
zips are written by executors, one archive per (station, month) group, so
no group is larger than a month of one station and nothing passes through
the driver. Zip landing needs ``root`` on a file system the executors
mount (a POSIX path).
"""

from __future__ import annotations

import io
import itertools
import os
import re
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "landing", f"{name}-{uuid.uuid4().hex[:10]}")


def land_station_json(measurements: DataFrame, path: str) -> str:
    """Station payload JSON: one object per (station, day) with a ``W``
    timeseries holding that day's measurements (ISO-8601 ``Z`` stamps)."""
    m = measurements.withColumn("_day", F.to_date("timestamp_utc"))
    meas = F.struct(F.date_format("timestamp_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
                    F.col("value").alias("value"))
    grouped = m.groupBy("station_id", "station_name", "latitude", "longitude", "timeseries_name", "unit", "_day") \
               .agg(F.sort_array(F.collect_list(meas)).alias("measurements"))
    payload = grouped.select(
        F.col("station_id").alias("uuid"), F.col("station_name").alias("shortname"),
        F.lit(None).cast("string").alias("longname"), F.col("station_id").alias("number"),
        "latitude", "longitude",
        F.array(F.struct(F.col("timeseries_name").alias("shortname"), F.col("unit").alias("unit"),
                         F.col("measurements").alias("measurements"))).alias("timeseries"))
    payload.write.mode("overwrite").json(path)
    return path


#: The station in the path of a landed archive file.
ARCHIVE_STATION = r"station_id=([^/]+)_[^_/]*\.csv$"
_UNSAFE = re.compile(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def _archive_writer(path: str):
    def name(sid, year):
        safe = _UNSAFE.sub(lambda m: f"%{ord(m.group()):02X}", sid) if sid else "__HIVE_DEFAULT_PARTITION__"
        return os.path.join(path, f"station_id={safe}_{year}.csv")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(path, exist_ok=True)
        rows = (r for b in batches for r in b.itertuples(index=False, name=None))
        for (sid, year), lines in itertools.groupby(rows, key=lambda r: r[:2]):
            target = name(sid, year)
            part = f"{target}.{uuid.uuid4().hex}"  # a task that runs twice replaces its own file
            with open(os.path.join(path, "." + os.path.basename(part)), "w", encoding="utf-8", newline="") as fh:
                fh.write("timestamp;value\n")
                n = 0
                for n, (_, _, stamp, value) in enumerate(lines, 1):
                    fh.write(f"{stamp or ''};{value or ''}\n")
            os.replace(fh.name, target)
            yield pd.DataFrame({"path": [target], "rows": [n]})
    return write


def land_archive_csv(series: DataFrame, path: str, tz: str = "UTC") -> str:
    """Archive CSV: ``timestamp;value`` in local wall time of ``tz`` with a
    decimal comma, one file for each station and year
    (``station_id=<station>_<year>.csv``) in one folder. Rows of a station and
    year meet before they are written, so files follow stations, not tasks
    times stations, and one listing finds them."""
    local = F.from_utc_timestamp(F.col("timestamp_utc").cast("timestamp"), tz)
    out = series.select(F.coalesce("station_id", F.lit("")).alias("station_id"), F.coalesce(F.date_format(local, "yyyy"), F.lit("")).alias("_year"),
                        F.date_format(local, "yyyy-MM-dd HH:mm").alias("timestamp"),
                        F.regexp_replace(F.col("value").cast("string"), r"\.", ",").alias("value"))
    tasks = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = out.repartition(tasks, "station_id", "_year").sortWithinPartitions("station_id", "_year")
    os.makedirs(path, exist_ok=True)
    out.mapInPandas(_archive_writer(path), "path string, rows long").agg(F.sum("rows")).first()
    return path


# Family code -> product columns written (raw column -> canonical measure).
FAMILY_LAYOUT = {
    "TU": {"TT_TU": "temperature_c", "RF_TU": "relative_humidity_pct"},
    "RR": {"R1": "precipitation_mm"},
    "FF": {"F": "wind_speed_ms"},
    "P0": {"P0": "pressure_hpa"},
}


def _zip_writer(root: str, family_code: str):
    layout = FAMILY_LAYOUT[family_code]

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        sid = str(pdf["dwd_station_id"].iloc[0])
        stamps = pd.to_datetime(pdf["timestamp_utc"])
        first, last = stamps.min().strftime("%Y%m%d"), stamps.max().strftime("%Y%m%d")
        name = f"stundenwerte_{family_code}_{sid}_{first}_{last}_hist.zip"
        raw_id = str(int(sid)) if sid.isdigit() else sid  # unpadded, as in the product files
        body = pd.DataFrame({"STATIONS_ID": "  " + raw_id, "MESS_DATUM": stamps.dt.strftime("%Y%m%d%H"),
                             "QN_9": "    3"})
        for raw_col, measure in layout.items():
            body[raw_col] = pdf[measure].map(lambda v: "-999" if pd.isna(v) else repr(float(v))).values
        body["eor"] = "eor"
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            zf.writestr(f"produkt_{family_code.lower()}_stunde_{first}_{last}_{sid}.txt",
                        body.to_csv(sep=";", index=False).encode("latin1"))
            zf.writestr("Metadaten_Geographie.txt", b"not a product file")
        os.makedirs(root, exist_ok=True)
        target = os.path.join(root, name)
        with open(target, "wb") as fh:
            fh.write(buf.getvalue())
        return pd.DataFrame({"path": [target], "rows": [len(pdf)]})
    return write


def land_product_zips(hourly: DataFrame, root: str, family_code: str = "TU") -> DataFrame:
    """Hourly product archives of one variable family, one per (station,
    month), written by the executors. Returns (path, rows) per archive
    (lazy until an action). Station ids must be 5 digits."""
    g = hourly.withColumn("_month", F.date_trunc("month", "timestamp_utc"))
    return g.groupBy("dwd_station_id", "_month").applyInPandas(_zip_writer(root, family_code), "path string, rows long")
