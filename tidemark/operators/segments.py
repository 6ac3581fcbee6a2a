"""Contiguous segments of a candle series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.types import INTERVAL_MS, WARMUP_BARS

SERIES = ["symbol", "interval"]


def interval_ms_column(interval: Column) -> Column:
    """Milliseconds of an interval's name; NULL for another one."""
    found = F.lit(None).cast("long")
    for name, ms in INTERVAL_MS.items():
        found = F.when(interval == name, ms).otherwise(found)
    return found


def numeric(candles: DataFrame) -> DataFrame:
    """Candles with their quantities as doubles under short names."""
    short = {"open_price": "open", "high_price": "high", "low_price": "low", "close_price": "close", "volume": "volume", "quote_asset_volume": "quote_volume", "taker_buy_base_volume": "taker_base", "taker_buy_quote_volume": "taker_quote"}
    return candles.select(*SERIES, "open_time", "close_time", *(F.col(c).cast("double").alias(n) for c, n in short.items()), "number_of_trades")


def segmented(candles: DataFrame) -> DataFrame:
    """Candles with segment_id (from 0, in time order), bar_index in the segment, and the flags of gaps and warm-up.

    A step of more than the interval starts a segment; no candle is made up. The first bar of every segment but the
    first is a gap's end; a bar is warmed up where its segment holds enough bars before it for every feature.
    """
    series = Window.partitionBy(*SERIES).orderBy("open_time")
    last = F.lag("open_time", 1).over(series)
    breaks = F.when(F.col("open_time") - last > interval_ms_column(F.col("interval")), 1).otherwise(0)
    marked = candles.withColumn("_break", breaks).withColumn("segment_id", F.sum("_break").over(series.rowsBetween(Window.unboundedPreceding, 0))).drop("_break")
    index = F.row_number().over(Window.partitionBy(*SERIES, "segment_id").orderBy("open_time")) - 1
    return marked.withColumn("bar_index", index).withColumns(
        {"is_gap_boundary": (F.col("segment_id") > 0) & (F.col("bar_index") == 0), "is_warm": F.col("bar_index") >= WARMUP_BARS}
    )
