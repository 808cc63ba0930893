"""Every registered query against its oracle on the smallest tables."""

import compare
import pytest

import __spark_entry__ as entry
from seriesmill.catalogue import oracle, queries

FOLDER = "/root/testdata/sf0.001"
QUERIES = queries.queries()
ORACLES = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare.compare(QUERIES[name](spark, FOLDER), con, ORACLES[name]) == []


# Queries whose rows come in a promised order, and the columns of that order.
ORDERED = {
    "distinct_regions": ["series_title_3"],
    "topk_preview": ["o_totalprice", "o_orderkey"],
    "presentation_order": ["period_start_date", "region"],
    "dash_regional": ["period", "unemployment_rate"],
    "dash_national": ["period"],
    "dash_wage_rows": ["period"],
    "dash_latest_rank": ["unemployment_rate"],
    "dash_compare": ["unemployment_rate"],
    "dash_multi": ["region", "period"],
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_order(spark, con, name):
    columns = ORDERED[name]
    ours = [tuple(row[c] for c in columns) for row in QUERIES[name](spark, FOLDER).collect()]
    result = con.sql(ORACLES[name])
    places = [result.columns.index(c) for c in columns]
    assert ours == [tuple(row[p] for p in places) for row in result.fetchall()]


def test_queries_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
