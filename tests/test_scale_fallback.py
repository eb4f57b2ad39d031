"""The fallback join meets the weather of the hours that facts have, and no other."""

import datetime as dt

from gaugeflow.operators.joins import ranked_fallback_join


def test_weather_of_other_hours_is_not_pivoted(spark):
    t = dt.datetime(2024, 1, 1)
    hour = lambda i: t + dt.timedelta(hours=i)
    facts = spark.createDataFrame([("S", hour(5), 1.0), ("S", hour(7), 2.0), ("T", hour(5), 3.0), (None, hour(5), 4.0), ("S", None, 5.0)],
                                  "station_id string, timestamp_utc timestamp_ntz, value double")
    obs = spark.createDataFrame([(o, hour(i), None if o == "D1" and i == 7 else float(i)) for o in ("D1", "D2") for i in range(200)],
                                "dwd_station_id string, timestamp_utc timestamp_ntz, m double")
    mapping = spark.createDataFrame([("S", "D1", "D2", None), ("U", "D1", None, None)], "station_id string, primary_dwd_station_id string, "
                                    "backup1_dwd_station_id string, backup2_dwd_station_id string")
    got = ranked_fallback_join(facts, obs, mapping, ["m"], hours=facts.unionByName(facts))
    rows = {(r.value, r.m, r.p_m, r.b1_m, r.weather_source_used) for r in got.collect()}
    assert rows == {(1.0, 5.0, 5.0, 5.0, "primary"), (2.0, 7.0, None, 7.0, "backup1"), (3.0, None, None, None, None),
                    (4.0, None, None, None, None), (5.0, None, None, None, None)}
    plain = ranked_fallback_join(facts, obs, mapping, ["m"])
    assert {(r.value, r.m, r.p_m, r.b1_m, r.weather_source_used) for r in plain.collect()} == rows
