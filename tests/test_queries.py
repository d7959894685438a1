"""Every registered query against its SQL text, and the shape of the driver contract."""

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from tessitura.plans.catalogue import QUERIES
from tessitura.plans.views import Tables

FOLDER = "/root/testdata/sf0.001"
# Rules without an SQL form; tests/test_folds.py and test_operators.py simulate them.
NO_SQL = {"activity_segments", "boundary_repair", "boundary_repair_audit", "frame_pitch"}


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, FOLDER), connect(FOLDER)


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_query_equals_sql(tables, name):
    found = [p for p in differences(QUERIES[name], *tables) if p != "no rows"]
    assert not found


def test_contract(spark):
    # Corpus queries come and go with their subpackage.
    assert set(QUERIES) <= set(contract.queries()) and set(QUERIES) - set(contract.oracle_sql()) == NO_SQL
    assert contract.entry(spark).count() > 0
    assert contract.queries()["song_share"](spark, FOLDER).columns == ["song_id", "duration_ms", "total_ms", "share", "over"]


@pytest.mark.parametrize("name", ["interval_subtract", "coverage_contract", "on_off_pairing", "tempo_asof", "gap_evidence", "window_packing", "noise_floor", "largest_remainder"])
def test_hot_keys_do_not_change_results(spark, name):
    spark.conf.set("spark.tessitura.maxRowsPerTask", "40")
    try:
        assert not differences(QUERIES[name], Tables(spark, FOLDER), connect(FOLDER))
    finally:
        spark.conf.unset("spark.tessitura.maxRowsPerTask")
