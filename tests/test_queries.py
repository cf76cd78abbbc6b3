"""Every quick registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import canonical, same

SLOW = ("m04", "m05", "m06", "m07", "m09", "m10", "m11", "m12", "m13", "m14")
NAMES = ["a", "f", "j", "m", "o", "p", "s", "t", "u", "w"]


@pytest.fixture(scope="module")
def oracle(sf):
    con = duckdb.connect()
    for file in os.listdir(sf):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{file}'")
    return con


@pytest.mark.parametrize("letter", NAMES)
def test_queries_match_sql(spark, sf, oracle, letter):
    sql = entry.oracle_sql()
    for name, run in entry.queries().items():
        if not name.startswith(letter) or name.startswith(SLOW) or name not in sql:
            continue
        mine, theirs = run(spark, sf).toPandas(), oracle.execute(sql[name]).df()
        assert sorted(mine.columns) == sorted(theirs.columns), name
        assert same(canonical(mine), canonical(theirs)) is None, name


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_runs(spark):
    assert entry.entry(spark).count() > 0
