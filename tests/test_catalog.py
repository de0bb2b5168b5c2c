"""Every registered query gives what its SQL gives on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from tally.catalog import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF_DIR}/{file}')")
    return con


def canonical(rows):
    return sorted(repr(tuple(r)) for r in rows)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cols = sorted(df.columns)
    result = duck.execute(SQL[name])
    names = [c[0] for c in result.description]
    want = [tuple(row[names.index(c)] for c in cols) for row in result.fetchall()]
    assert sorted(names) == cols
    assert canonical(df.select(*[f"`{c}`" for c in cols]).collect()) == canonical(want)


def test_contract_lists_the_catalog():
    assert set(QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
