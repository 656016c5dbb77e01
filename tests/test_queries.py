"""Every query of the engine against its SQL, on the smallest tables."""

import pytest

from blockweave import queries
from oracle import same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(spark, name):
    assert same(queries.QUERIES[name](spark, SF), queries.ORACLE_SQL[name], SF) > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
