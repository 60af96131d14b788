"""Every registered query against its SQL, on the smallest tables."""

import pytest

from tickharbor.plans import CATALOG, oracle_sql, queries
from tools.compare import connect, table

SMALL = "/root/testdata/sf0.001"
SQL = oracle_sql()
# Left to tools/compare.py: these write over a thousand small folders, twice or file by file.
SLOW = {"archive_round_trip", "file_manifest", "storage_fan_out", "stream_fan_out"}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", [name for name in queries() if name not in SLOW])
def test_query(spark, duck, name):
    df = queries()[name](spark, SMALL)
    columns, rows = table(df.columns, df.collect())
    if name in SQL:
        expected = duck.sql(SQL[name])
        assert (columns, rows) == table(expected.columns, expected.fetchall())


def test_all_dashboard_queries_are_there():
    covered = {item.strip() for entry in CATALOG.values() for item in entry.covers.split(",")}
    assert {f"Q{n:02d}" for n in range(1, 49)} <= covered
