import pytest

from glossaria.llm import registry
from tests.conftest import SMALL
from tests.same import assert_same


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert_same(registry.queries()[name](spark, SMALL), duck, registry.oracle_sql()[name])
