"""Registered corpus queries against their SQL, on the smallest tables."""

import os

import duckdb
import pytest

from newsflow.llm.oracle import ORACLE
from newsflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    base = duckdb.connect()
    for file in os.listdir(FOLDER):
        path = f"{FOLDER}/{file}"
        base.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    wanted = base.sql(ORACLE[name])
    got = QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    assert columns == sorted(wanted.columns)
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(repr, wanted.project(", ".join(columns)).fetchall()))
