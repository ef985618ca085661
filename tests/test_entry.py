import __spark_entry__ as entry


def test_contract(spark):
    assert entry.entry(spark).columns == ["museum_id", "other_kind", "other_id"]
    names = set(entry.queries())
    assert {"p2_found", "p5_found"} <= names
    assert set(entry.oracle_sql()) <= names
