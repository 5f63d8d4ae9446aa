"""Every registered query builds and runs on sf0.001; entry() works."""
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "relations" in df.columns


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_runs(spark, name):
    df = entry.queries()[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    if name in entry.oracle_sql():
        assert isinstance(entry.oracle_sql()[name], str)
