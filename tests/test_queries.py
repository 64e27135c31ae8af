"""Every registered query against its SQL counterpart on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from tests.conftest import SF_DIR

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(row):
    """Sortable values; integers and floats compare by value, NULL and NaN to themselves."""
    cells = []
    for value in row:
        if isinstance(value, bool) or value is None:
            cells.append(("", str(value)))
        elif isinstance(value, (int, float)):
            cells.append(("number", "nan" if math.isnan(value) else repr(float(value))))
        else:
            cells.append((type(value).__name__, str(value)))
    return cells


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    found = sorted(comparable(row) for row in df.select(*columns).collect())
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted(comparable([row[i] for i in order]) for row in cursor.fetchall())
    assert found == expected
    assert found


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry_ranks_all_families(spark):
    rows = entry_points.entry(spark).orderBy("rank").collect()
    assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5]
    assert [r["is_best"] for r in rows] == [True, False, False, False, False]
    assert [r["rmse"] for r in rows] == sorted(r["rmse"] for r in rows)
