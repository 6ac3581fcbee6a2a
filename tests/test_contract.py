import glob

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    found = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        found.execute(f"CREATE VIEW {path.rsplit('/', 1)[1].removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return found


def same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and abs(a - b) <= 2e-6)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    result = db.execute(ORACLES[name])
    names = sorted(d[0] for d in result.description)
    assert sorted(df.columns) == names
    at = [[d[0] for d in result.description].index(n) for n in names]
    right = sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=repr)
    found = sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
    assert len(found) == len(right)
    assert all(same(x, y) for a, b in zip(found, right, strict=True) for x, y in zip(a, b, strict=True))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
