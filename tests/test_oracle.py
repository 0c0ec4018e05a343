"""Every query with SQL gives the rows DuckDB gives; the others give rows."""

import re

import pytest

import __spark_entry__ as entry
import oracle

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not re.match(r"op\d+_|pipeline$", n)))
def test_query(name, spark, connection):
    result = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert oracle.differences(result, connection, SQL[name]) == []
    else:
        assert not result.isEmpty()


def test_entry(spark):
    assert entry.entry(spark).columns == ["genres", "week_end_date", "revenue"]


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
