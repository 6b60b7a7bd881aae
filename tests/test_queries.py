"""Every registered query against its SQL, and the rules that no table shows."""

from __future__ import annotations

import pytest
from veilgrid.plans import registry

from tests.conftest import rows_of

NAMES = sorted(registry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf_dir, duck, name):
    got = registry.queries()[name](spark, sf_dir).toPandas()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    want = duck.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_entry_point(spark, sf_dir):
    import __spark_entry__ as entry

    assert set(registry.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 3287
