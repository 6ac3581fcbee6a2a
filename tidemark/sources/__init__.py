"""Exchange REST source and the decoders of its payloads."""

from tidemark.sources.client import RestClient
from tidemark.sources.decode import decode_exchange_info, decode_klines, decode_tickers
from tidemark.sources.reader import KlineDataSource

__all__ = ["RestClient", "KlineDataSource", "decode_exchange_info", "decode_klines", "decode_tickers"]
