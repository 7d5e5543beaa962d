"""The driver's entry points."""

import __spark_entry__ as entry


def test_entry_and_names(spark):
    df = entry.entry(spark)
    assert df.columns == ["segment", "nation", "n_lines", "quantity"] and df.count() == 20
    assert set(entry.oracle_sql()) <= set(entry.queries())
