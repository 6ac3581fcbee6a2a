"""Candles, and what is made of them, of events within a millisecond of a candle's end and of events before 1970."""

from datetime import datetime, timedelta

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from test_contract import same

from tidemark.plans.registry import ORACLES, QUERIES

#: Microseconds from an hour's end: less than half a millisecond before it, half of one, more, and well inside.
FROM_END = (-400, -500, -600, -1, -2_000_000_000)


@pytest.fixture(scope="module")
def events(tmp_path_factory):
    """Hours around the start of 1970 and 220 hours in 2024, with a few events of two types in each."""
    hours = [datetime(1969, 12, 30) + timedelta(hours=n) for n in range(96)] + [datetime(2024, 1, 1) + timedelta(hours=n) for n in range(220)]
    rows = []
    for n, start in enumerate(hours):
        times = (timedelta(minutes=20), timedelta(microseconds=400 + n % 3 * 100), timedelta(hours=1, microseconds=FROM_END[n % 5]))
        rows += [(start + at, ("click", "view")[(n + i) % 7 % 2], round(50 + (n * 37 + i * 101) % 89 / 7, 2)) for i, at in enumerate(times)]
        rows += [(start + timedelta(minutes=30 + i), kind, round(40 + (n * 53) % 97 / 3, 2)) for i, kind in enumerate(("click", "view"))]
    folder = tmp_path_factory.mktemp("events")
    ids, (ts, kinds, values) = range(len(rows)), zip(*rows, strict=True)
    table = {"event_id": pa.array(ids, pa.int64()), "ts": pa.array(ts, pa.timestamp("us")), "user_id": pa.array([n * 7 % 31 for n in ids], pa.int64())}
    pq.write_table(pa.table(table | {"event_type": kinds, "value": values, "props": ["{}"] * len(rows)}), folder / "events.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    return str(folder), db


@pytest.mark.parametrize("name", [
    "candles_1h",
    "candles_5m",
    "lineage",
    "decoded_klines",
    "true_range",
    "roc",
    "bollinger20",
    "macd_family",
    "rsi_atr",
    "feature_matrix_by_type",
    "ema_features",
    "trend_features",
    "momentum_features",
    "feature_matrix",
])
def test_milliseconds_of_events_as_in_the_sql(spark, events, name):
    folder, db = events
    df, result = QUERIES[name](spark, folder), db.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    right = sorted(result.fetchall(), key=repr)
    found = sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
    assert len(found) == len(right)
    assert all(same(x, y) for a, b in zip(found, right, strict=True) for x, y in zip(a, b, strict=True))
