"""Every registered query against its SQL, row for row."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from citeweave.catalog import REGISTRY

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


# Beyond SQL: topics, see tests/test_snapshots.py.
TESTED_OTHERWISE = {"work_topics"}


@pytest.fixture(scope="session")
def oracle(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf_dir) / name}.parquet'")
    return connection


def comparable(rows):
    """Rows in a fixed order; floats exact, missing values as None."""
    def cell(value):
        return None if isinstance(value, float) and math.isnan(value) else value

    return sorted((tuple(cell(v) for v in row) for row in rows),
                  key=lambda row: tuple((v is not None, v if v is not None else 0) for v in row))


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
         "boolean": "BOOLEAN", "float": "FLOAT"}


def mismatch(spark, sf_dir, oracle, name):
    query = entry_points.queries()[name]
    frame = query(spark, sf_dir)
    columns = sorted(frame.columns)
    relation = oracle.sql(entry_points.oracle_sql()[name])
    if columns != sorted(relation.columns):
        return f"columns {columns} / {sorted(relation.columns)}"
    kinds = [KINDS[frame.schema[c].dataType.simpleString()] for c in columns]
    found = dict(zip(relation.columns, map(str, relation.types)))
    if kinds != [found[c] for c in columns]:
        return f"types {list(zip(columns, kinds, [found[c] for c in columns]))}"
    ours = comparable(map(tuple, frame.select(*[f"`{c}`" for c in columns]).collect()))
    theirs = comparable(relation.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows / {len(theirs)}"
    if not ours:
        return "no rows"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{str(a)[:500]}\n / {str(b)[:500]}"
    return None


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_same_rows_as_sql(spark, sf_dir, oracle, name):
    assert mismatch(spark, sf_dir, oracle, name) is None


def test_every_query_has_sql():
    """Those of the catalog; the training-data queries have a rule of their own beside their tests."""
    assert {name for name, query in REGISTRY.items() if query.sql is None} == TESTED_OTHERWISE
    assert set(REGISTRY) - TESTED_OTHERWISE <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
