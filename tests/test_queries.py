"""Every registered query against its SQL, on the smallest tables."""

import oracle
import pytest

from weftwork.catalog import load_all

ENTRIES = load_all()


@pytest.fixture(scope="module")
def duck(small):
    return oracle.connect(small)


@pytest.mark.parametrize("name", list(ENTRIES))
def test_query(name, spark, small, duck):
    entry = ENTRIES[name]
    if entry.sql is None:
        assert entry(spark, small).count() > 0
        return
    found = [d for d in oracle.differences(entry, spark, small, duck) if d != "no rows"]
    assert found == []


def test_entry_module(spark):
    import __spark_entry__ as driver

    assert set(driver.oracle_sql()) < set(driver.queries())
    assert driver.entry(spark).columns == ["c_nationkey", "total_trips", "n_name"]
