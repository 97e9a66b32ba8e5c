"""Every registered query against the same question in SQL."""

import math
from pathlib import Path

import duckdb
import pytest
from support import CHECK

import __spark_entry__ as spark_entry

from tidewatch.plans.catalog import QUERIES
from tidewatch.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in Path(CHECK).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    yield connection
    connection.close()


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        return "NaN" if isinstance(value, float) and math.isnan(value) else repr(value)

    return sorted(columns), sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(spark_entry.queries())
    assert set(ORACLES) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, sql, name):
    df = QUERIES[name](spark, CHECK)
    want = sql.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert rows_of(df.columns, df.collect()) == rows_of(columns, want.fetchall())


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 1000
