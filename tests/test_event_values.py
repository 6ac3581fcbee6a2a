"""Candles, and what is made of them, of events whose values have more than two decimals."""

from datetime import datetime, timedelta

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.plans.adapters import price
from tidemark.plans.registry import ORACLES, QUERIES


def test_price_equals_the_cast_of_the_sql(spark):
    values = [0.125, 0.375, 0.005, 1.005, 2.675, -0.125, -1.005, 0.0049999999999999999, 0.0, 1e13 + 0.125, 1e15 + 0.125, 123456789012345.67, None]
    values += [n / 1000 for n in range(5, 100_000, 10)] + [n / 8 for n in range(0, 20_000, 7)]
    found = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double").orderBy("i").select(price(F.col("x"))).collect()]
    right = [duckdb.execute("SELECT CAST(CAST(? AS DOUBLE) AS DECIMAL(18, 2))", [x]).fetchone()[0] for x in values]
    assert found == right


@pytest.fixture(scope="module")
def events(tmp_path_factory):
    """220 hours with three events of each of two types; many a value ends in a half of a cent as text and is below it."""
    rows = [
        (datetime(2024, 1, 1) + timedelta(hours=n, minutes=10 * i + 1), ("click", "view")[i % 2], (1000 + (n * 37 + i * 101) % 8900) / 1000 + 0.005)
        for n in range(220) for i in range(6)
    ]
    folder = tmp_path_factory.mktemp("events")
    ids, (ts, kinds, values) = range(len(rows)), zip(*rows, strict=True)
    table = {"event_id": pa.array(ids, pa.int64()), "ts": pa.array(ts, pa.timestamp("us")), "user_id": pa.array([n * 7 % 31 for n in ids], pa.int64())}
    pq.write_table(pa.table(table | {"event_type": kinds, "value": values, "props": ["{}"] * len(rows)}), folder / "events.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    return str(folder), db


@pytest.mark.parametrize("name", [
    "roc",
    "candles_1h",
    "decoded_tickers",
    "trend_features",
    "momentum_features",
    "rsi_atr",
])
def test_values_of_more_than_two_decimals_as_in_the_sql(spark, events, name):
    folder, db = events
    result = db.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    right = sorted(result.fetchall(), key=repr)
    assert sorted((tuple(r[n] for n in names) for r in QUERIES[name](spark, folder).collect()), key=repr) == right
