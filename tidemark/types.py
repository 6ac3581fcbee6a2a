"""Schemas, fixed values and records of the candle engine."""

from __future__ import annotations

from enum import Enum

# The kline intervals and their lengths in milliseconds.
INTERVAL_MS = {"5m": 300_000, "15m": 900_000, "1h": 3_600_000, "4h": 14_400_000, "1d": 86_400_000}


class KlineInterval(str, Enum):
    """The intervals as an enumeration."""

    M5 = "5m"
    M15 = "15m"
    H1 = "1h"
    H4 = "4h"
    D1 = "1d"

    @classmethod
    def from_value(cls, value: str) -> KlineInterval:
        interval_ms(value)
        return cls(getattr(value, "value", value))


# The features in canonical order, each with the first bar of a segment that has it, and its warm-up bars.
FEATURES = {
    "ema20": (19, 60),
    "ema50": (49, 150),
    "ema200": (199, 600),
    "ratio_close_ema20": (19, 60),
    "ratio_close_ema50": (49, 150),
    "ratio_close_ema200": (199, 600),
    "spread_ema20_50": (49, 150),
    "spread_ema50_200": (199, 600),
    "spread_ema20_200": (199, 600),
    "slope_ema20": (22, 63),
    "slope_ema50": (52, 153),
    "slope_ema200": (202, 603),
    "rsi14": (14, 42),
    "macd_line": (25, 78),
    "macd_signal": (33, 105),
    "macd_hist": (33, 105),
    "macd_norm": (25, 78),
    "macd_hist_norm": (33, 105),
    "roc10": (10, 10),
    "roc21": (21, 21),
    "atr14": (14, 42),
    "natr14": (14, 42),
    "bb_upper": (19, 19),
    "bb_mid": (19, 19),
    "bb_lower": (19, 19),
    "bb_pct_b": (19, 19),
    "bb_bandwidth": (19, 19),
    "vol_sma20": (19, 19),
    "rvol20": (19, 19),
    "taker_buy_share": (0, 0),
}
FEATURE_NAMES = tuple(FEATURES)
FIRST_VALID = {name: first for name, (first, _) in FEATURES.items()}
WARMUP = {name: warm for name, (_, warm) in FEATURES.items()}
#: Bars from which every feature of a segment is warmed up.
WARMUP_BARS = max(WARMUP.values())

PRICES = ("open_price", "high_price", "low_price", "close_price")
VOLUMES = ("volume", "quote_asset_volume", "taker_buy_base_volume", "taker_buy_quote_volume")

#: Storage tables as DDL. Identifiers of append-only tables are assigned by the store.
TABLES = {
    "ingestion_runs": "id long, run_type string, status string, started_at long, completed_at long, records_fetched long, records_stored long, error_message string",
    "raw_api_responses": "id long, endpoint string, params_json string, response_json string, content_hash string, ingestion_run_id long, fetched_at long",
    "symbols": "symbol string, base_asset string, quote_asset string, status string, is_spot_trading_allowed boolean, is_margin_trading_allowed boolean, base_asset_precision int, quote_asset_precision int, updated_at long, created_at timestamp",
    "symbol_status_events": "id long, symbol string, status string, is_spot_trading_allowed boolean, effective_at long, raw_response_id long",
    "klines": "symbol string, `interval` string, open_time long, open_price decimal(38,18), high_price decimal(38,18), low_price decimal(38,18), close_price decimal(38,18), volume decimal(38,18), close_time long, quote_asset_volume decimal(38,18), number_of_trades long, taker_buy_base_volume decimal(38,18), taker_buy_quote_volume decimal(38,18), raw_response_id long",
    "ticker_snapshots": "id long, symbol string, price decimal(38,18), snapshot_at long, raw_response_id long",
}
KEYS = {"symbols": ["symbol"], "klines": ["symbol", "interval", "open_time"], "ingestion_runs": ["id"]}
SCHEMA_VERSION = 1


def interval_ms(interval: str) -> int:
    """Length of an interval; exact names only."""
    value = getattr(interval, "value", interval)
    if not isinstance(value, str) or value not in INTERVAL_MS:
        raise ValueError(f"unknown interval {interval!r}; known are {', '.join(INTERVAL_MS)}")
    return INTERVAL_MS[value]


def symbol_name(symbol: str) -> str:
    """A symbol without surrounding space, in upper case."""
    if not isinstance(symbol, str) or not symbol.strip():
        raise ValueError("a symbol is a non-empty string")
    return symbol.strip().upper()


def epoch_ms(value: int, name: str = "timestamp") -> int:
    """A time in epoch milliseconds: a whole number, not negative, not a boolean."""
    if isinstance(value, bool) or not isinstance(value, int):
        raise TypeError(f"{name} must be int, got {type(value).__name__}")
    if value < 0:
        raise ValueError(f"{name} must not be negative, got {value}")
    return value
