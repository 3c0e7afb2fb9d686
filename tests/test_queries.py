import pytest

from glossaria.plans import queries

from .conftest import SMALL
from .same import assert_same


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert_same(queries.QUERIES[name](spark, SMALL), duck, queries.SQL[name])


def test_entry_has_rows(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
