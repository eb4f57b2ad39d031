"""Readers on small hand-made files; streaming replays equal batch results."""

import datetime as dt
import io
import json
import os
import tempfile
import zipfile

from pyspark.sql import functions as F

from gaugeflow.sources import readers as RD
from gaugeflow.sources import sinks as SK
from gaugeflow.sources.config import bands_dim, segments_dim, thresholds_dim
from gaugeflow.streaming import incremental as ST


def _tmp():
    return tempfile.mkdtemp(prefix="gf-test-")


def test_station_payload_rules(spark):
    d = _tmp()
    stations = [
        {"uuid": "u1", "shortname": None, "longname": "LONG ONE", "latitude": 50.0, "longitude": 7.0,
         "timeseries": [{"shortname": "W", "unit": "cm", "measurements": [
             {"timestamp": "2024-01-01T01:00:00+01:00", "value": 10.5},
             {"timestamp": None, "value": 1.0}]},
             {"shortname": "Q", "unit": "m3/s", "measurements": [{"timestamp": "2024-01-01T00:00:00Z", "value": 5.0}]}]},
        {"uuid": "u2", "shortname": None, "longname": None, "timeseries": [
            {"shortname": "W", "unit": "cm", "measurements": [{"timestamp": "2024-01-02T00:00:00Z", "value": None}]}]},
    ]
    with open(os.path.join(d, "s.json"), "w") as fh:
        fh.write("\n".join(json.dumps(s) for s in stations))
    rows = RD.read_station_payload(spark, d, ingestion_ts="2024-02-01 00:00:00").collect()
    got = sorted((r.station_id, r.station_name, r.timeseries_name, r.timestamp_utc, r.value) for r in rows)
    assert got == [("u1", "LONG ONE", "W", dt.datetime(2024, 1, 1, 0, 0), 10.5),
                   ("u2", "unknown", "W", dt.datetime(2024, 1, 2, 0, 0), None)]
    assert all(len(r.source_record_hash) == 64 for r in rows)


def test_archive_csv_rules(spark):
    d = _tmp()
    with open(os.path.join(d, "a.csv"), "w") as fh:
        fh.write("timestamp;value\n2023-10-29 02:30;12,5\n2023-03-26 02:30;7\nnot a time;3\n"
                 "2023-07-01 12:00;\n2023-07-01 13:00;1;2;3\n2023-07-01 14:00;4,25\n")
    rows = sorted((r.timestamp_utc, r.value) for r in RD.read_archive_csv(spark, d, "Europe/Berlin").collect())
    assert rows == [(dt.datetime(2023, 3, 26, 1, 0), 7.0), (dt.datetime(2023, 7, 1, 12, 0), 4.25),
                    (dt.datetime(2023, 10, 29, 1, 30), 12.5)]


def test_product_zip_and_pruning(spark):
    d = _tmp()
    body = ("STATIONS_ID;MESS_DATUM;QN_9;TT_TU;RF_TU;eor\n"
            "   433;2024010100;    3;  -3.5;  91.0;eor\n"
            "   433;2024010101;    3;-999;  ####;eor\n"
            "   433;bad;    3;  1.0;  -999.0;eor\n")
    for name in ("stundenwerte_TU_00433_20200101_20231231_hist.zip", "stundenwerte_TU_00999_19500101_19991231_hist.zip",
                 "stundenwerte_TU_00433_akt.zip"):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as zf:
            zf.writestr("Metadaten_Parameter.txt", "x")
            zf.writestr("produkt_tu_stunde_x.txt", body.encode("latin1"))
        open(os.path.join(d, name), "wb").write(buf.getvalue())
    raw = RD.read_product_zip(spark, d, file_filter=RD.prune_files(F.col(RD.FILE_NAME), start_date="2018-01-01", ids=["433"]))
    canon = RD.canonical_measures(raw, "air_temperature", ingestion_ts="2024-02-01 00:00:00").collect()
    assert len(canon) == 6  # two archives kept (dated + undated), three rows each
    got = sorted({(r.dwd_station_id, r.timestamp_utc, r.temperature_c, r.relative_humidity_pct, r.quality_flag)
                  for r in canon}, key=str)
    assert ("00433", dt.datetime(2024, 1, 1, 0, 0), -3.5, 91.0, "3") in got
    assert ("00433", dt.datetime(2024, 1, 1, 1, 0), None, None, "3") in got
    assert ("00433", None, 1.0, None, "3") in got
    assert all(r.precipitation_mm is None for r in canon)


def test_station_description(spark):
    d = _tmp()
    text = ("Stations_id von_datum bis_datum Stationshoehe geoBreite geoLaenge Stationsname Bundesland\n"
            "----------- --------- --------- ------------- --------- --------- ------------ ----------\n"
            "00433 19510101 20240131 48 52.4537 13.3017 Berlin-Tempelhof Berlin\n"
            "02667 19570701 20240131 92 50.8646 7.1575 Köln/Bonn Flughafen Nordrhein-Westfalen\n"
            "short line\n")
    open(os.path.join(d, "desc.txt"), "wb").write(text.encode("latin1"))
    rows = sorted(RD.read_station_description(spark, d).collect())
    assert [(r.station_id, r.station_name, r.region) for r in rows] == [
        ("00433", "Berlin-Tempelhof", "Berlin"), ("02667", "Köln/Bonn Flughafen", "Nordrhein-Westfalen")]


def test_config_dims(spark):
    thr = thresholds_dim(spark, "thresholds:\n  kaub: 120\n  Maxau: 380\n")
    assert sorted(thr.collect()) == [("KAUB", 120.0), ("MAXAU", 380.0)]
    bands = bands_dim(spark, "default:\n  - {id: low, max_cm: 80}\n  - {id: ok, min_cm: 80}\n"
                             "stations:\n  KAUB:\n    - {id: k, min_cm: 0}\n")
    assert sorted((r.station_name, r.band_order, r.band_id) for r in bands.collect()) == [
        ("DEFAULT", 1, "low"), ("DEFAULT", 2, "ok"), ("KAUB", 1, "k")]
    segs = segments_dim(spark, "segments:\n  - {id: S1, label: a, decision_gauge: Kaub, support_gauges: [Mainz]}\n")
    assert sorted((r.station_name, r.role) for r in segs.collect()) == [("KAUB", "decision"), ("MAINZ", "support")]


def test_sinks_conform_and_tolerant_load(spark):
    d = os.path.join(_tmp(), "t")
    df = spark.createDataFrame([("a", "1.5", 1), ("b", "x", 2)], "k string, v string, extra int")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.DoubleType()),
                           T.StructField("missing", T.LongType())])
    assert SK.append_table(df.limit(0), d, schema) is False
    assert SK.append_table(df, d, schema) is True
    got = sorted(SK.load_table(spark, d, ["k", "v", "nope"]).collect())
    assert got == [("a", 1.5), ("b", None)]


def test_streaming_windows_equal_batch(spark):
    src, out, ck = _tmp(), _tmp(), _tmp()
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=13 * i), "a" if i % 3 else "b", float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, ts timestamp, k string, v double")
    df.repartitionByRange(5, "ts").write.mode("overwrite").parquet(src)
    stream = ST.stream_files(spark, src, df.schema, max_files_per_trigger=1)
    agg = ST.windowed_counts(stream, "ts", ["k"], "v", kind="tumbling", duration="1 hour", watermark="30 days")
    ST.upsert_stream(agg, out, ck, ["window_start", "k"], ["n"], output_mode="update")
    ST.upsert_stream(agg, out, ck, ["window_start", "k"], ["n"], output_mode="update")  # re-run: no change
    got = sorted((r.window_start, r.k, r.n) for r in ST.merged_view(spark, out, ["window_start", "k"], ["n"]).collect())
    exp = sorted((r.w, r.k, r.n) for r in df.groupBy(F.date_trunc("hour", "ts").alias("w"), "k")
                 .agg(F.count("*").alias("n")).collect())
    assert got == exp


def test_upsert_stream_compaction(spark):
    src, out, ck = _tmp(), _tmp(), _tmp()
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i % 10, t0 + dt.timedelta(minutes=i), float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, ts timestamp, v double")
    df.repartitionByRange(4, "ts").write.mode("overwrite").parquet(src)
    stream = ST.stream_files(spark, src, df.schema, max_files_per_trigger=1)
    ST.upsert_stream(stream, out, ck, ["k"], ["ts"])
    before = sorted(ST.merged_view(spark, out, ["k"], ["ts"]).collect())
    assert ST.compact(spark, out, ["k"], ["ts"]) == 1
    after = sorted(ST.merged_view(spark, out, ["k"], ["ts"]).collect())
    assert before == after and len(after) == 10
    # new data lands in the new generation and still wins by order
    more = spark.createDataFrame([(3, t0 + dt.timedelta(days=1), -1.0)], "k long, ts timestamp, v double")
    more.write.mode("append").parquet(src)
    ST.upsert_stream(stream, out, ck, ["k"], ["ts"])
    got = {r.k: r.v for r in ST.merged_view(spark, out, ["k"], ["ts"]).collect()}
    assert got[3] == -1.0 and len(got) == 10


def test_event_after_a_closed_session_is_kept(spark):
    src, out, ck = _tmp(), _tmp(), _tmp()
    schema = spark.createDataFrame([], "ts timestamp, k string, v double").schema
    stream = ST.stream_files(spark, src, schema)
    agg = ST.windowed_counts(stream, "ts", ["k"], "v", kind="session", gap="1 hour", watermark="2 hours")

    def run(*rows):
        spark.createDataFrame([(dt.datetime(2024, 1, 1, h, m), k, 1.0) for h, m, k in rows], schema) \
            .write.mode("append").parquet(src)
        ST.upsert_stream(agg, out, ck, ["window_start", "k"], ["n"])
        return sorted((r.k, r.window_start.hour, r.n) for r in ST.merged_view(spark, out, ["window_start", "k"], ["n"]).collect())

    assert run((0, 0, "a"), (0, 30, "a"), (6, 0, "b")) == [("a", 0, 2)]  # b is open, a has ended
    assert run((5, 30, "a"), (6, 30, "b"), (7, 0, "a")) == [("a", 0, 2)]  # before the newest event, within the lateness
    assert run((20, 0, "c")) == [("a", 0, 2), ("a", 5, 1), ("a", 7, 1), ("b", 6, 2)]


def test_gauge_ingest_keeps_lagging_stations_and_corrections(spark):
    from gaugeflow.plans.ingest import gauge_ingest

    d = _tmp()

    def payload(name, station, *points):
        with open(os.path.join(d, name), "w") as f:
            f.write(json.dumps({"uuid": station, "shortname": station, "timeseries": [
                {"shortname": "W", "unit": "cm", "measurements": [
                    {"timestamp": f"2024-01-01T{h:02d}:00:00Z", "value": v} for h, v in points]}]}))
        return os.path.join(d, name)

    old = [payload("old-a.json", "A", (0, 1.0), (9, 2.0)), payload("old-b.json", "B", (0, 3.0))]
    new = [payload("new-a.json", "A", (0, 7.0), (9, 2.5), (10, 4.0)), payload("new-b.json", "B", (5, 5.0)),
           payload("new-c.json", "C", (1, 6.0))]
    target = gauge_ingest(spark, old, None, ingestion_ts="2024-01-02 00:00:00")

    def values(mode):
        out = gauge_ingest(spark, new, target, ingestion_ts="2024-01-03 00:00:00", mode=mode)
        return sorted((r.station_id, r.timestamp_utc.hour, r.value) for r in out.collect())

    rest = [("A", 9, 2.5), ("A", 10, 4.0), ("B", 0, 3.0), ("B", 5, 5.0), ("C", 1, 6.0)]
    assert values("incremental") == [("A", 0, 1.0), *rest]  # B lags behind A; A's row at its mark is corrected
    assert values("backfill") == [("A", 0, 7.0), *rest]


def _files_read(df):
    found = []

    def walk(plan):
        if plan.metrics().contains("numFiles"):
            found.append(plan.metrics().apply("numFiles").value())
        children = plan.children().iterator()
        while children.hasNext():
            walk(children.next())

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


def test_pruned_archives_are_not_read(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"stundenwerte_TU_{i % 4:05d}_19500101_{2000 + i}1231_hist.zip").write_bytes(b"no archive")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    kept = files.where(RD.prune_files(F.col(RD.FILE_NAME), start_date="2006-01-01", ids=["1", "3"])).select("path", "content")
    assert len(kept.collect()) == 3 and _files_read(kept) == 3
    everything = files.select("path", "content")
    assert len(everything.collect()) == 12 and _files_read(everything) == 12


def test_weather_ingest_asks_for_all_measures_by_default(spark):
    import inspect

    from gaugeflow.operators.clean import eligible_groups
    from gaugeflow.plans.ingest import weather_ingest

    given = inspect.signature(weather_ingest).parameters
    assert (given["min_complete_ratio"].default, given["min_rows"].default) == (0.80, 5000)
    cols = list(RD.CANONICAL_MEASURES)
    hours = spark.range(6250).select(F.explode(F.array(*[F.lit(x) for x in "abcd"])).alias("k"), "id")
    gap = F.when(F.col("k") == "a", False).when(F.col("k") == "b", F.col("id") >= 5000).when(F.col("k") == "c", F.col("id") >= 4999) \
           .otherwise(F.col("id") % 2 == 0)
    obs = hours.select("k", *[F.when(gap & F.lit(c == "pressure_hpa"), None).otherwise(1.0).alias(c) for c in cols])
    kept = eligible_groups(obs, "k", cols, 0.80, 5000).groupBy("k").count().collect()
    assert {(r.k, r["count"]) for r in kept} == {("a", 6250), ("b", 6250)}  # b has exactly the rows and the share


T1 = dt.datetime(2024, 1, 1)
EVENT = "k string, ts timestamp, value double"


def test_state_expires_and_late_rows_are_counted(spark, tmp_path):
    src, target, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    days = lambda a, b: [("x", T1 + dt.timedelta(hours=h), 1.0) for h in range(24 * a, 24 * b)]
    seen = []
    for rows in (days(0, 5), days(5, 10), days(1, 2) + days(9, 10)):
        spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(src)
        stream = ST.stream_files(spark, src, spark.createDataFrame([], EVENT).schema)
        agg = ST.windowed_counts(stream, "ts", ["k"], "value", duration="1 hour", watermark="1 day")
        seen.append(ST.state_progress(ST.upsert_stream(agg, target, ck, ["window_start", "k"], ["n"], output_mode="update")))
    first, second, third = seen
    assert sum(p[1] for p in first) == 120 and first[-1][2] < 30  # of 120 windows a day and the newest hour stay
    assert second[-1][2] < 30 and sum(p[3] for p in second) >= 115
    assert sum(p[4] for p in third) == 24  # the rows of the second day come after the watermark
    counts = {r.window_start: r.n for r in ST.merged_view(spark, target, ["window_start", "k"], ["n"]).collect()}
    assert len(counts) == 240 and counts[T1 + dt.timedelta(hours=30)] == 1 and counts[T1 + dt.timedelta(hours=9 * 24 + 5)] == 2


def test_marked_ingest_reruns_and_backfills(spark, tmp_path):
    schema = "s string, ts timestamp_ntz, v double, ing int"
    at = lambda h: T1 + dt.timedelta(hours=h)
    table = str(tmp_path / "marked")
    load = lambda rows, mode="incremental": ST.ingest_marked(
        spark.createDataFrame(rows, schema), table, ["s", "ts"], ["ing"], ["s"], "ts", mode)
    held = lambda: {(r.s, r.ts): r.v for r in ST.read_marked(spark, table)[0].collect()}
    marks = lambda: {r.s: r.high_water_mark for r in ST.read_marked(spark, table)[1].collect()}
    assert ST.read_marked(spark, table) is None
    assert load([("a", at(1), 1.0, 1), ("a", at(2), 1.0, 1), ("b", at(9), 1.0, 1)]) == 0
    batch = [("a", at(1), 5.0, 2), ("a", at(2), 6.0, 2), ("a", at(3), 7.0, 2), ("c", at(0), 8.0, 2)]
    for _ in range(2):  # hour 1 lies before the mark, the corrected row at the mark is taken; the rerun changes nothing
        load(batch)
        assert held() == {("a", at(1)): 1.0, ("a", at(2)): 6.0, ("a", at(3)): 7.0, ("b", at(9)): 1.0, ("c", at(0)): 8.0}
        assert marks() == {"a": at(3), "b": at(9), "c": at(0)}
    # a batch that did not end is not seen, and its generation is written anew
    spark.createDataFrame([("z", at(1), 0.0, 1)], schema).write.parquet(f"{table}/gen=3/rows")
    assert ("z", at(1)) not in held()
    load(batch, "backfill")
    assert held()[("a", at(1))] == 5.0 and marks()["a"] == at(3)


def test_bands_of_the_operational_layout(spark):
    import pytest

    text = """
operational_thresholds:
  DEFAULT:
    unit: cm
    bands:
      - {id: normal, label: Fine, min_cm: 151, max_cm: null, severity: normal, color: green}
      - {id: low, label: Low, min_cm: 81, max_cm: 150, severity: warning, color: yellow}
  kaub:
    bands:
      - {id: own, label: Own, min_cm: 0, max_cm: 9.5, severity: high, color: red}
"""
    rows = {(r.station_name, r.band_order): (r.band_id, r.min_cm, r.max_cm) for r in bands_dim(spark, text).collect()}
    assert rows == {("DEFAULT", 1): ("normal", 151.0, None), ("DEFAULT", 2): ("low", 81.0, 150.0), ("KAUB", 1): ("own", 0.0, 9.5)}
    with pytest.raises(ValueError, match="no bands"):
        bands_dim(spark, "something: {else: 1}")


def test_scope_fuzzy_replaces_one_spelling_at_a_time(spark):
    from gaugeflow.operators.clean import scope_fuzzy

    names = ["GROSSKÖNIGSRUE", "GROSSKOENIGSRÜ", "GROSSKÖNIGSRÜ", "GROSSKOENIGSRUE x", "OTHER"]
    df = spark.createDataFrame([(str(i), n) for i, n in enumerate(names)], "id string, name string")
    kept = scope_fuzzy(df, "id", "name", names=["grosskoenigsrue"]).collect()
    assert sorted(r.id for r in kept) == ["0", "1", "3"]  # both spellings at once are another name


def test_marks_held_in_a_table_reach_the_scan(spark, tmp_path):
    from gaugeflow.operators.clean import last_n_months, newer_than_table

    rows = [(i, T1 + dt.timedelta(days=i, hours=i % 24)) for i in range(200)]
    spark.createDataFrame(rows, "id int, ts timestamp_ntz").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    marks = spark.createDataFrame([(T1 + dt.timedelta(days=9),), (T1 + dt.timedelta(days=99, hours=3),)], "m timestamp_ntz")
    newer, recent = newer_than_table(df, "ts", marks, "m"), last_n_months(df, "ts", 2)
    assert {r.id for r in newer.collect()} == {i for i, t in rows if t > T1 + dt.timedelta(days=99, hours=3)}
    last = rows[-1][1]
    assert last.month == 7 and {r.id for r in recent.collect()} == {i for i, t in rows if t >= last.replace(month=5)}
    for frame in (newer, recent):
        assert "GreaterThan" in frame._jdf.queryExecution().executedPlan().toString().split("PushedFilters:")[1]
    assert newer_than_table(df, "ts", marks.limit(0), "m").count() == 200 and last_n_months(df.limit(0), "ts", 1).count() == 0
