"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tools.compare import compare, tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return tables(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, db, name):
    ours = entry.queries()[name](spark, FOLDER).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        # Operators on text that SQL cannot express; other tests check their content.
        assert len(ours) > 0
    else:
        assert compare(ours, db.execute(sql).df()) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
