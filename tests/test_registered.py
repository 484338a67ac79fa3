"""Every registered query of the core library against its DuckDB twin at the smallest scale."""

import pytest

from fieldmart.plans.testbed import registered
from tests.conftest import DATA
from tests.helpers import same

ENTRIES = {name: (query, sql) for name, query, sql in registered()}


@pytest.mark.parametrize("name", [n for n, (_, sql) in ENTRIES.items() if sql])
def test_equals_oracle(spark, duck, name):
    query, sql = ENTRIES[name]
    same(query(spark, DATA), duck, sql)


@pytest.mark.parametrize("name", [n for n, (_, sql) in ENTRIES.items() if not sql])
def test_has_rows(spark, name):
    assert ENTRIES[name][0](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert "mart_weather" in e.queries() and "mart_weather" in e.oracle_sql()
    assert ENTRIES["mart_weather"][0](spark, DATA).count() > 0
