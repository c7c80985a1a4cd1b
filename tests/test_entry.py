import importlib


def test_entry_and_contract(spark):
    m = importlib.import_module("__spark_entry__")
    df = m.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert set(m.oracle_sql()) <= set(m.queries())
    assert "features_ride" in m.oracle_sql()
