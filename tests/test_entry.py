import __spark_entry__ as entry


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 70


def test_the_flagship_runs(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["doc_id", "duplicate_reason", "duplicate_of"] and rows.count() > 0
