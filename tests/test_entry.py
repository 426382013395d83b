import __spark_entry__ as entry


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["p", "ring", "chance"]
    assert rows.count() > 0
