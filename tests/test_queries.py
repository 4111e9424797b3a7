import compare
import pytest

from lexforge.plans import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    got, other = compare.both(spark, name, compare.SF, registry.queries(), registry.oracle_sql())
    assert got == other


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_rows_only(spark, name):
    assert registry.queries()[name](spark, compare.SF).count() > 0
