"""Every registered query against its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from oracle_compare import duck, rows_of

import __spark_entry__ as E
from roomledger.plans import catalog

QUERIES = E.queries()
SQL = E.oracle_sql()
OWN = catalog.queries()  # the training-data queries have tests of their own


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(SQL) <= set(QUERIES)
    assert set(OWN) <= set(SQL)


@pytest.mark.parametrize("name", sorted(set(SQL) & set(OWN)))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = con.sql(SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


def test_entry_is_the_overview(spark):
    row = E.entry(spark).collect()
    assert len(row) == 1
    # FIXTURES.md §4, sf0.001
    r = row[0]
    assert (r.total_bookings, r.canceled_bookings, r.confirmed_bookings) == (1506, 589, 916)
    assert (r.cancellation_rate, r.total_guests, r.total_nights) == (39.11, 5851, 4494)
    assert (r.avg_nights_per_booking, r.avg_lead_time, r.avg_adr) == (2.98, 199.26, 248.92)
    assert (r.total_estimated_revenue, r.avg_revenue_per_booking) == (1117885.585, 742.78)
