"""Raw payloads as typed rows, by column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Positions of a raw candle.
KLINE_FIELDS = ("open_time", "open_price", "high_price", "low_price", "close_price", "volume", "close_time", "quote_asset_volume", "number_of_trades", "taker_buy_base_volume", "taker_buy_quote_volume")
_LONGS = ("open_time", "close_time", "number_of_trades")

_SYMBOL = "struct<symbol:string,status:string,baseAsset:string,quoteAsset:string,baseAssetPrecision:int,quoteAssetPrecision:int,quotePrecision:int,isSpotTradingAllowed:boolean,isMarginTradingAllowed:boolean>"


def decode_klines(pages: DataFrame, payload: str = "response_json") -> DataFrame:
    """A row per candle of pages (symbol, interval, payload); position is its place in the page.

    A value that isn't a number gives NULL here, which validation reports.
    """
    rows = pages.withColumn("_page", F.from_json(payload, "array<array<string>>"))
    others = [c for c in pages.columns if c != payload]
    rows = rows.select(*others, F.posexplode("_page").alias("position", "_k")).filter(F.size("_k") >= len(KLINE_FIELDS))
    typed = {name: F.element_at("_k", i + 1).try_cast("long" if name in _LONGS else "decimal(38,18)") for i, name in enumerate(KLINE_FIELDS)}
    return rows.select(*others, "position", *(x.alias(n) for n, x in typed.items()))


def _or(x: Column, default) -> Column:
    return F.coalesce(x, F.lit(default))


def decode_exchange_info(responses: DataFrame, payload: str = "response_json") -> DataFrame:
    """A row per symbol of exchange metadata with server_time; of a repeated symbol the last entry."""
    parsed = responses.select(F.from_json(payload, f"struct<serverTime:bigint,symbols:array<{_SYMBOL}>>").alias("p"))
    rows = parsed.select(_or(F.col("p.serverTime"), 0).alias("server_time"), F.posexplode("p.symbols").alias("pos", "s")).filter(F.length(F.trim("s.symbol")) > 0)
    last = rows.groupBy(F.upper(F.trim("s.symbol")).alias("symbol")).agg(F.max_by(F.struct("s", "server_time"), "pos").alias("x"))
    return last.select(
        "symbol", _or(F.col("x.s.baseAsset"), "").alias("base_asset"), _or(F.col("x.s.quoteAsset"), "").alias("quote_asset"), _or(F.col("x.s.status"), "").alias("status"),
        _or(F.col("x.s.isSpotTradingAllowed"), False).alias("is_spot_trading_allowed"), _or(F.col("x.s.isMarginTradingAllowed"), False).alias("is_margin_trading_allowed"),
        _or(F.col("x.s.baseAssetPrecision"), 8).alias("base_asset_precision"), _or(F.coalesce("x.s.quoteAssetPrecision", "x.s.quotePrecision"), 8).alias("quote_asset_precision"), "x.server_time",
    )


def decode_tickers(responses: DataFrame, payload: str = "response_json") -> DataFrame:
    """A row per ticker; the payload is one or a list."""
    one, many = F.from_json(payload, "struct<symbol:string,price:string>"), F.from_json(payload, "array<struct<symbol:string,price:string>>")
    found = F.when(F.ltrim(payload).startswith("["), many).otherwise(F.array(one))
    others = [c for c in responses.columns if c != payload]
    return responses.select(*others, F.explode(found).alias("t")).select(*others, F.upper(F.trim("t.symbol")).alias("symbol"), F.col("t.price").try_cast("decimal(38,18)").alias("price")).filter("symbol IS NOT NULL AND price IS NOT NULL")
