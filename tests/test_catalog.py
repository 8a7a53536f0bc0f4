"""Every registered query against its SQL."""

import pytest
from compare import same

from siftline.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, sf, duck, name):
    same(catalog.QUERIES[name](spark, sf).toPandas(), duck.sql(catalog.ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_query_runs(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf).columns


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
