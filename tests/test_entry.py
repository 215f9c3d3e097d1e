import __spark_entry__ as E


def test_catalogue_is_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 30


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["day", "avg_goldstein", "trend"]
    assert len(rows) > 0
