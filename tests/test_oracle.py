"""Every registered query against its SQL, on the smallest tables."""

import pytest
from oracle_check import connect, mismatch

import __spark_entry__ as entry
from repotide.plans import batch_queries, stream_queries
from repotide.plans.oracle import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    frame = entry.queries()[name](spark, SF_DIR)
    assert mismatch(frame, duck, entry.oracle_sql()[name]) is None


def test_live_history_ends_in_the_final_ranking(spark):
    history = entry.queries()["stream_history"](spark, SF_DIR)
    last = history.agg({"batch_id": "max"}).first()[0]
    assert last >= 1
    final = history.filter(history["batch_id"] == last).drop("batch_id")
    run = entry.queries()
    expected = run["stream_rankings"](spark, SF_DIR).unionByName(run["stream_projects"](spark, SF_DIR))
    assert sorted(map(tuple, final.select(expected.columns).collect())) == sorted(
        map(tuple, expected.collect())
    )


def test_every_query_has_sql():
    library = {**batch_queries.QUERIES, **stream_queries.QUERIES}
    assert set(library) == set(ORACLES)
    assert set(library) <= set(entry.queries())


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
