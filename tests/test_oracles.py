"""Every registered query against its SQL, on the driver's tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from shared import DATA_DIR
from workload import oracles, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SCALE = DATA_DIR / os.environ.get("TEST_SCALE", "sf0.01")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SCALE}/{name}.parquet')")
    yield con
    con.close()


def _normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(
        (tuple(_normal(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((v is not None, str(v)) for v in row),
    )


def test_every_query_has_an_oracle():
    assert set(queries.REGISTRY) == set(oracles.ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_oracle(spark, database, name):
    result = contract.queries()[name](spark, str(SCALE))
    found = _rows(result.columns, [tuple(r) for r in result.collect()])
    answer = database.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    expected = _rows(columns, answer.fetchall())
    assert sorted(result.columns) == sorted(columns)
    assert len(found) == len(expected)
    assert found == expected
