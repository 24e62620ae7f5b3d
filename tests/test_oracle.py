"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

from suite import load_all
from suite.compare import differences, oracle

SF = "/root/testdata/sf0.001"
ENTRIES = load_all()


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_query_agrees_with_sql(spark, con, name):
    entry = ENTRIES[name]
    assert entry.sql, "every query has a SQL twin"
    assert differences(entry.run(spark, SF), con, entry.sql) == []
