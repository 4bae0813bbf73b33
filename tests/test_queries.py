"""Every named query against its SQL counterpart."""

import pytest
from conftest import SF_DIR
from helpers import rows

import __spark_entry__ as entry
from fleetmeter.plans.catalog import QUERIES
from fleetmeter.plans.oracle import ORACLES


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    relation = duck.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    order = [relation.columns.index(c) for c in columns]
    expected = sorted(
        (tuple(r[i] for i in order) for r in duck.execute(ORACLES[name]).fetchall()),
        key=lambda r: [(v is None, str(v)) for v in r],
    )
    assert expected
    assert rows(result, *columns) == expected


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 15
