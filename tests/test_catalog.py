"""Every query against its SQL, run by DuckDB on the same tables."""

import duckdb
import pytest
from helpers import SMALL, plan_of

import __spark_entry__
from washline import catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
# Results that come out of a shuffle; all others are narrow from scan to result.
SHUFFLING = {"row_index", "profile_types", "stream_profile"}
FILE_QUERIES = {"probe_source", "list_files", "file_checksums", "land_files", "land_and_verify"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    yield connection
    connection.close()


def in_order(names, rows):
    """Rows as texts, with the columns in name order."""
    places = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(row[i] for i in places)) for row in rows)


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SMALL)
    wanted = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in wanted.description]
    assert sorted(df.columns) == sorted(names)
    assert in_order(df.columns, map(tuple, df.collect())) == in_order(names, wanted.fetchall())
    if name in FILE_QUERIES:  # tasks open files in Python
        return
    plan = plan_of(df)
    for costly in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert costly not in plan
    assert ("Exchange" in plan) == (name in SHUFFLING)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 6000


def test_entry_points_hold_the_catalog():
    assert set(catalog.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_merged_branches_read_each_table_once(spark):
    assert plan_of(catalog.queries()["merge_branches"](spark, SMALL)).count("FileScan parquet") == 2
