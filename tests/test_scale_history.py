"""The sorts of the history are spread over more tasks than the shuffle partitions."""

import datetime as dt

from gaugeflow.operators.asof import asof_nearest

T0 = dt.datetime(2024, 1, 1)


def test_asof_join_sorts_in_as_many_tasks_as_asked(spark):
    left = spark.createDataFrame([(f"s{i % 5}", T0 + dt.timedelta(hours=i)) for i in range(300)], "k string, t timestamp_ntz")
    right = spark.createDataFrame([(f"s{i % 5}", T0 + dt.timedelta(hours=2 * i, minutes=5), float(i)) for i in range(150)],
                                  "k string, u timestamp_ntz, v double")
    plain = asof_nearest(left, right, ["k"], "t", "u", 7200, ["v"])
    split = asof_nearest(left, right, ["k"], "t", "u", 7200, ["v"], partitions=13)
    assert split.rdd.getNumPartitions() == 13
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))
    assert "Exchange SinglePartition" not in split._jdf.queryExecution().executedPlan().toString()
