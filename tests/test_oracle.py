"""Every registered query of the core against its SQL, on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from millwatch.plans.oracle import ORACLE_SQL as SQL
from millwatch.plans.queries import QUERIES

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def canonical(names: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(names)), key=names.__getitem__)

    def shown(value) -> str:
        return "NaN" if isinstance(value, float) and math.isnan(value) else repr(value)

    return sorted(names), sorted("|".join(shown(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    result = QUERIES[name](spark, str(SF))
    ours = canonical(result.columns, [tuple(row) for row in result.collect()])
    relation = database.execute(SQL[name])
    theirs = canonical([column[0] for column in relation.description], relation.fetchall())
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]


def test_registered_names_match():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() == 10
