"""Every query against its SQL in an independent engine, on the smallest tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from marquee.starschema.oracle import ORACLE
from marquee.starschema.queries import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="star-schema tables are not here")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for path in sorted(Path(FOLDER).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def comparable(columns, data):
    order = sorted(range(len(columns)), key=lambda at: columns[at])

    def plain(value):
        if isinstance(value, float):
            return None if math.isnan(value) else value + 0.0
        return value

    return sorted((tuple(plain(row[at]) for at in order) for row in data), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, engine, name):
    got = QUERIES[name](spark, FOLDER)
    wanted = engine.execute(ORACLE[name])
    columns = [column[0] for column in wanted.description]
    assert sorted(got.columns) == sorted(columns)
    assert comparable(got.columns, map(tuple, got.collect())) == comparable(columns, wanted.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
