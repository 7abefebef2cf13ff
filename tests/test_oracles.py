"""Every registered query with SQL gives the same values on both engines."""

import pytest
from compare import compare, oracle_connection

import __spark_entry__ as contract

ORACLES = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def connection(folder):
    return oracle_connection(folder)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, folder, connection, name):
    assert compare(QUERIES[name](spark, folder), connection, ORACLES[name]) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["section", "track_id", "track_name", "artist_name", "mean_cosine_score", "rk"]
    rows = df.collect()
    assert len(rows) == 50
    for section, size in (("similar", 40), ("same_group", 10)):
        part = sorted((r for r in rows if r["section"] == section), key=lambda r: r["rk"])
        scores = [r["mean_cosine_score"] for r in part]
        assert len(part) == size and scores == sorted(scores, reverse=True)
