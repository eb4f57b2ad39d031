"""Driver contract: entry runs; every oracle has a query; queries are callable."""

import pytest

import __spark_entry__ as E

from conftest import SMOKE


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"target_value_t_plus_24h", "lag_1", "rolling_std_3"} <= set(df.columns)


def test_registry_consistency():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 120
    assert all(callable(f) and f.__doc__ for f in qs.values())


def test_a_few_queries_run_on_smoke_data(spark):
    qs = E.queries()
    for name in ("weather_map", "asof_nearest", "time_splits", "proxy_fill", "risk_table"):
        assert qs[name](spark, SMOKE).count() >= 0


def test_a_missing_third_party_module_costs_only_the_training_data_queries(monkeypatch):
    import sys

    for name in [n for n in sys.modules if n.startswith("gaugeflow.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "xxhash", None)  # importing it raises ImportError
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    with pytest.warns(UserWarning, match="left out"):
        qs = E.queries()
    assert len(qs) >= 120 and "pipeline" not in qs
