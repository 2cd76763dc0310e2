"""Every registered query against its SQL, on the smallest tables."""

import datetime
import os

import pytest

import __spark_entry__ as entry
from topiclog.plans.oracle import ORACLE
from topiclog.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def tables():
    db = duckdb.connect()
    for file in os.listdir(SF_DIR):
        if file.endswith(".parquet"):
            db.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{SF_DIR}/{file}'")
    return db


def comparable(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    plain = lambda v: v.isoformat() if isinstance(v, datetime.datetime) else v
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, tables, name):
    frame = QUERIES[name](spark, SF_DIR)
    cursor = tables.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    assert comparable([tuple(r) for r in frame.collect()], frame.columns) == comparable(cursor.fetchall(), columns)
