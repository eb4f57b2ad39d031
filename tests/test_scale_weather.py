"""Product archives are opened once, however many steps follow."""

import datetime as dt

from gaugeflow.plans import ingest as IG
from gaugeflow.sources import landing as LD


def test_no_later_step_opens_the_archives_again(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    rows = [(f"0000{s}", t + dt.timedelta(hours=h), None if (s + h) % 3 == 0 else float(h), 1.0, 2.0, 3.0, 4.0) for s in range(1, 4) for h in range(4)]
    wx = spark.createDataFrame(rows, "dwd_station_id string, timestamp_utc timestamp_ntz, temperature_c double, precipitation_mm double, "
                                     "wind_speed_ms double, pressure_hpa double, relative_humidity_pct double")
    root = str(tmp_path / "zips")
    for family in LD.FAMILY_LAYOUT:
        LD.land_product_zips(wx, root, family).count()
    meta = spark.createDataFrame([(f"0000{s}", 50.0 + s / 10, 7.0) for s in range(1, 4)], "station_id string, latitude double, longitude double")
    out = IG.weather_ingest(spark, root, meta, min_complete_ratio=0.0, min_rows=1, ingestion_ts="2024-02-01 00:00:00")
    for name, frame in out.items():
        assert "binaryFile" not in frame._jdf.queryExecution().executedPlan().toString(), name
    got = {(r.dwd_station_id, r.timestamp_utc.hour): (r.temperature_c, r.is_proxy_backfilled) for r in out["observations"].collect()}
    assert len(got) == 12 and all(v == float(h) and filled == ((int(s) + h) % 3 == 0) for (s, h), (v, filled) in got.items())
