"""Every query of the catalogue on the small tables, against its SQL where it has one."""

from __future__ import annotations

import pytest

from tests.conftest import SMALL
from tests.oracle import connect, plain

from snapledger.plans import general, marts, registry  # noqa: F401

QUERIES = general.QUERIES | registry.QUERIES
ORACLES = general.ORACLES | registry.ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SMALL)
    frame = got.toPandas()
    spark.catalog.clearCache()
    assert len(set(got.columns)) == len(got.columns)
    if name in ORACLES:
        want = con.execute(ORACLES[name]).df()
        assert sorted(frame.columns) == sorted(want.columns)
        assert plain(frame) == plain(want)


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["extract_date", "uuid", "change_kind"]
