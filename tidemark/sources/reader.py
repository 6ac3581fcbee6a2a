"""Candles as a Spark data source: a partition per symbol, interval and range of pages.

spark.dataSource.register(KlineDataSource); spark.read.format("exchange_klines").options(base_url=..., symbols="A,B",
intervals="1h", start=..., end=...).load(). A partition asks for its pages one after the other, under the client's
pacing. Every partition paces itself, so `partition_pages` should be large where the exchange limits the sum.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator
from decimal import Decimal

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.sources.client import PAGE_LIMIT, RestClient, Retry, http
from tidemark.sources.decode import KLINE_FIELDS
from tidemark.types import interval_ms, symbol_name

_LONGS = ("open_time", "close_time", "number_of_trades")


class KlineRange(InputPartition):
    def __init__(self, symbol: str, interval: str, start: int, end: int):
        self.symbol, self.interval, self.start, self.end = symbol, interval, start, end


def raw_kline(values: list) -> tuple:
    """A raw candle's values, typed."""
    return tuple(int(v) if n in _LONGS else Decimal(str(v)) for n, v in zip(KLINE_FIELDS, values, strict=False))


def pages(client: RestClient, retry: Retry, symbol: str, interval: str, start: int, end: int) -> Iterator[list[list]]:
    """Pages from start to end; a short page is the last. A page that doesn't advance is an error."""
    at = start
    while at <= end:
        page = retry.page(client, symbol, interval, at, end, PAGE_LIMIT)
        if not page:
            return
        yield page
        after = int(page[-1][6]) + 1
        if after <= at:
            raise RuntimeError(f"{symbol} {interval}: a page ends before {at}")
        at = after
        if len(page) < PAGE_LIMIT:
            return
        if at <= end:
            retry.pace(client)


class KlineReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        o, out = self.options, []
        start, end = int(o["start"]), int(o["end"])
        for symbol in o["symbols"].split(","):
            for interval in o["intervals"].split(","):
                ms = interval_ms(interval)
                first = start - start % ms
                step = ms * PAGE_LIMIT * int(o.get("partition_pages", "100"))
                out += [KlineRange(symbol_name(symbol), interval, t, min(t + step - 1, end)) for t in range(first, end + 1, step)]
        return out

    def read(self, partition: KlineRange) -> Iterator[tuple]:
        transport = http
        if "transport" in self.options:  # module:function
            module, _, name = self.options["transport"].partition(":")
            transport = getattr(importlib.import_module(module), name)
        client = RestClient(self.options["base_url"], transport, float(self.options.get("timeout", "10")))
        retry = Retry(float(self.options.get("delay_ms", "200")), int(self.options.get("max_retries", "3")))
        for page in pages(client, retry, partition.symbol, partition.interval, partition.start, partition.end):
            for k in page:
                yield (partition.symbol, partition.interval, *raw_kline(k))


class KlineDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "exchange_klines"

    def schema(self) -> str:
        return "symbol string, `interval` string, " + ", ".join(f"{n} {'long' if n in _LONGS else 'decimal(38,18)'}" for n in KLINE_FIELDS)

    def reader(self, schema) -> DataSourceReader:
        return KlineReader(self.options)
