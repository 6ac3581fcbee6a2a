"""Candles that arrive as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.segments import interval_ms_column
from tidemark.operators.store import Store
from tidemark.types import KEYS


def upsert_stream(stream: DataFrame, store: Store, checkpoint: str, position: str = "received_at") -> StreamingQuery:
    """Writes a stream of candles into the store: of equal keys the one received last, batch by batch.

    A batch that is repeated after a failure writes the same rows again.
    """

    def write(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        order = Window.partitionBy(*KEYS["klines"]).orderBy(F.desc(position))
        last = batch.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n", position)
        store.upsert_kline_frame(last.withColumn("batch_pos", F.lit(0)))

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def closed_candles(trades: DataFrame, interval: str, late: str = "10 minutes") -> DataFrame:
    """Candles of a stream of trades (symbol, ts, trade_id, price, quantity, taker_buy), each once its window is closed.

    A window closes when the watermark, `late` behind the newest trade, has passed it; later trades are dropped.
    """
    ms = interval_ms_column(F.lit(interval))
    window = F.window("ts", {"5m": "5 minutes", "15m": "15 minutes", "1h": "1 hour", "4h": "4 hours", "1d": "1 day"}[interval])
    at, value = F.struct("ts", "trade_id"), F.col("price") * F.col("quantity")
    own = F.when(F.col("taker_buy"), F.lit(1)).otherwise(F.lit(0))
    found = trades.withWatermark("ts", late).groupBy("symbol", window.alias("w")).agg(
        F.min_by("price", at).alias("open_price"), F.max("price").alias("high_price"), F.min("price").alias("low_price"), F.max_by("price", at).alias("close_price"),
        F.sum("quantity").alias("volume"), F.sum(value).alias("quote_asset_volume"), F.count("*").alias("number_of_trades"),
        F.sum(F.col("quantity") * own).alias("taker_buy_base_volume"), F.sum(value * own).alias("taker_buy_quote_volume"),
    )
    start = F.unix_millis(F.col("w.start"))
    return found.withColumns({"interval": F.lit(interval), "open_time": start, "close_time": start + ms - 1}).drop("w")
