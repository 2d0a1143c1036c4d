"""Every registered query of the library runs, and equals its SQL where it has one."""

import pytest
from compare import check
from conftest import DATA

import hydroframe.plans  # noqa: F401
from hydroframe.plans import registry


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, name):
    found = registry.queries()[name](spark, DATA).toPandas()
    sql = registry.oracle_sql().get(name)
    if sql:
        check(found, sql, DATA)
    else:
        assert len(found) > 0
