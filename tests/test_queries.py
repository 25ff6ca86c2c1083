"""Every registered query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry_point
from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
# On ten suppliers these happen to find nothing; they do at larger sizes.
MAY_BE_EMPTY = "both empty"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_entry_returns_rows(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_check_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", list(entry_point.queries()))
def test_query_matches_sql(spark, duck, name):
    problem = difference(
        spark, duck, FOLDER, entry_point.queries()[name], entry_point.oracle_sql().get(name)
    )
    assert problem in (None, MAY_BE_EMPTY)


SHUFFLED = [
    "jon_01_fact_dim_left",
    "jon_11_asof_snapshot",
    "flt_04_range_predicate",
    "mrg_02_merge_delete_unmatched",
    "mrg_06_incremental_fact",
    "dq_18_no_future_dates",
    "val_13_quarantine",
]


@pytest.mark.parametrize("name", SHUFFLED)
def test_query_matches_sql_without_broadcasts(spark, duck, name):
    """The same answers when no lookup is small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        build, sql = entry_point.queries()[name], entry_point.oracle_sql()[name]
        assert difference(spark, duck, FOLDER, build, sql) is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
