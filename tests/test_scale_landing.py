"""Archives are landed as one file for each station and year, whatever the tasks."""

import datetime as dt
import os

from pyspark.sql import functions as F

from gaugeflow.sources import landing as LD
from gaugeflow.sources import readers as RD


def test_archive_files_follow_stations_not_tasks(spark, tmp_path):
    rows = [(s, dt.datetime(y, 1, 1, h), v) for s in ("A", "B:1", "C_2", None) for y in (2023, 2024) for h, v in enumerate((1.5, -2.0, 3.25))]
    df = spark.createDataFrame(rows, "station_id string, timestamp_utc timestamp_ntz, value double").repartition(6)
    path = LD.land_archive_csv(df, str(tmp_path / "archive"))
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".csv")]
    assert len(files) == 4 * 2
    back = RD.read_archive_csv(spark, path, tz="UTC").select(
        F.regexp_extract("source_file", LD.ARCHIVE_STATION, 1).alias("s"), F.col("timestamp_utc").cast("timestamp_ntz"), "value")
    names = {"A": "A", "C_2": "C_2", None: "__HIVE_DEFAULT_PARTITION__"}
    got = sorted(tuple(r) for r in back.collect())
    assert [r for r in got if r[0] in names.values()] == sorted((names[s], t, v) for s, t, v in rows if s in names)
    assert len(got) == len(rows)
