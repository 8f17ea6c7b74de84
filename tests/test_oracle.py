"""Every registered query against its DuckDB oracle at sf0.01."""

import pytest

from tests.oracle import compare, duck

import __spark_entry__ as entry_mod

SF = "/root/testdata/sf0.01"
ORACLES = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_mart_query_has_an_oracle():
    assert set(entry_mod.QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF)
    r = compare(df, con, ORACLES[name])
    assert r["columns_match"], r["columns"]
    assert r["types_match"], r["types"]
    assert r["rows"][0] == r["rows"][1], r["rows"]
    assert r["values_match"], (sorted(r["spark_rows"])[:5], sorted(r["duck_rows"])[:5])


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["DESTINATION_AIRPORT", "AIRLINE", "Count_visit_per_airline", "ranking"]
