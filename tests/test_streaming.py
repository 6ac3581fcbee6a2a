import datetime as dt

from test_ingest import COIN, H, kline

from tidemark.operators.store import Store, kline_row
from tidemark.streaming.klines import closed_candles, upsert_stream


def test_stream_of_candles_is_upserted(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    store.initialize()
    store.upsert_symbols([COIN])
    schema = store.table("klines").schema.add("received_at", "long")
    rows = [kline(0, "50001", received_at=2), kline(0, "50000", received_at=1), kline(H, received_at=1)]
    fields = [f.name for f in schema]
    typed = [kline_row(r) | {"received_at": r["received_at"]} for r in rows]
    spark.createDataFrame([tuple(r[n] for n in fields) for r in typed], schema).write.parquet(f"{tmp_path}/in")
    query = upsert_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), store, f"{tmp_path}/checkpoint")
    query.awaitTermination()
    assert [int(r["close_price"]) for r in store.kline_range("BTCUSDT", "1h", 0, 9 * H).collect()] == [50001, 50500]


def test_candles_close_with_the_watermark(spark, tmp_path):
    at = lambda minute: dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=minute)
    rows = [("A", at(1), 1, 10.0, 2.0, True), ("A", at(3), 2, 12.0, 1.0, False), ("A", at(7), 3, 11.0, 1.0, True), ("A", at(40), 4, 9.0, 1.0, True)]
    schema = "symbol string, ts timestamp, trade_id long, price double, quantity double, taker_buy boolean"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    found = closed_candles(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), "5m")
    query = found.writeStream.format("memory").queryName("closed").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    got = [(int(r["open_price"]), int(r["high_price"]), int(r["close_price"]), int(r["volume"]), r["number_of_trades"]) for r in spark.table("closed").orderBy("open_time").collect()]
    assert got == [(10, 12, 12, 3, 2), (11, 11, 11, 1, 1)]
