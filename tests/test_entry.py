import __spark_entry__ as E


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() == 898
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 30
