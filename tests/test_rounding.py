"""Doubles of results are rounded as the SQL rounds them, to the bit."""

from datetime import datetime, timedelta

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.plans.registry import ORACLES, QUERIES, round_double


def test_round_double_equals_round_of_the_sql(spark):
    values = [323 / 640, -323 / 640, 1 / 640, 5e-7, -5e-7, 0.49999999999999994e-6, 1.0000005, 0.0, -1e-9, 2.0**52 / 1e6, (2.0**52 + 1) / 1e6, 1e303, -1.7e308, None]
    values += [n / 640 for n in range(1, 640, 7)] + [(2 * n + 1) / 2e6 for n in range(0, 10_000_000, 49_999)]
    found = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double").orderBy("i").select(round_double(F.col("x"))).collect()]
    right = [duckdb.execute("SELECT round(CAST(? AS DOUBLE), 6)", [x]).fetchone()[0] for x in values]
    assert list(map(repr, found)) == list(map(repr, right))


@pytest.mark.parametrize("name", ["feature_matrix", "feature_matrix_by_type"])
def test_share_whose_text_ends_in_a_half_and_that_is_below_it(spark, tmp_path, name):
    """An hour in which takers buy 323 of 640."""
    taken, other = [9] * 32 + [2], [9] * 31 + [6]  # a user's quantity is the last digit of its number, and 1
    rows = [(2 * i, user) for i, user in enumerate(taken)] + [(2 * i + 1, user) for i, user in enumerate(other)]
    ids, users = zip(*rows, strict=True)
    ts = [datetime(2024, 1, 1) + timedelta(seconds=i) for i in ids]
    table = {"event_id": pa.array(ids, pa.int64()), "ts": pa.array(ts, pa.timestamp("us")), "user_id": pa.array(users, pa.int64()), "event_type": ["click"] * len(ids), "value": [1.5] * len(ids)}
    pq.write_table(pa.table(table), tmp_path / "events.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    result = db.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    right = result.fetchall()
    assert right[0][names.index("taker_buy_share")] == 0.504687
    assert [tuple(r[n] for n in names) for r in QUERIES[name](spark, str(tmp_path)).collect()] == right
