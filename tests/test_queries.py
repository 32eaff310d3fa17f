"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from newsflow.plans.oracle import ORACLE
from newsflow.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for file in sorted(Path(SF_DIR).glob("*.parquet")):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= contract.queries().keys() and ORACLE.keys() <= contract.oracle_sql().keys()


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, database, name):
    df = contract.queries()[name](spark, SF_DIR)
    relation = database.sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    assert comparable(df.columns, df.collect()) == comparable(relation.columns, relation.fetchall())
