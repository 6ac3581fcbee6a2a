"""An exchange in memory, as a transport."""

import json
from urllib.parse import parse_qs, urlparse

from tidemark.sources.client import Answer
from tidemark.types import INTERVAL_MS


def raw(t, ms, price="100"):
    return [t, price, "105", "95", "102", "10.50", t + ms - 1, "1000", 50, "4", "400", "0"]


class Exchange:
    def __init__(self, server, candles=None, symbols=(), tickers=()):
        self.server, self.candles, self.symbols, self.tickers = server, candles or {}, list(symbols), list(tickers)
        self.asked, self.fail = [], []
        self.headers = {}

    def __call__(self, url, timeout):
        parts = urlparse(url)
        q = {k: v[0] for k, v in parse_qs(parts.query).items()}
        self.asked.append((parts.path, q))
        if parts.path.endswith("/klines") and self.fail:
            found = self.fail.pop(0)
            if isinstance(found, Exception):
                raise found
            if found:
                return found
        if parts.path.endswith("/time"):
            return Answer(200, json.dumps({"serverTime": self.server}))
        if parts.path.endswith("/exchangeInfo"):
            return Answer(200, json.dumps({"serverTime": self.server, "symbols": self.symbols}))
        if parts.path.endswith("/price"):
            return Answer(200, json.dumps(self.tickers))
        ms, start = INTERVAL_MS[q["interval"]], int(q.get("startTime", 0))
        times = [t for t in self.candles.get((q["symbol"], q["interval"]), []) if start <= t <= int(q.get("endTime", 1 << 60))]
        return Answer(200, json.dumps([raw(t, ms) for t in times[: int(q["limit"])]]), self.headers)


H = 3_600_000


def page_transport(url, timeout):
    """For the data source, which runs in other processes: hourly candles of the first ten days of the epoch."""
    return Exchange(10**12, {("BTCUSDT", "1h"): range(0, 240 * H, H), ("ETHUSDT", "1h"): range(0, 24 * H, H)})(url, timeout)


def symbol(name, status="TRADING", quote="USDT", spot=True):
    return {"symbol": name, "status": status, "baseAsset": name[:3], "baseAssetPrecision": 8, "quoteAsset": quote, "quoteAssetPrecision": 8, "isSpotTradingAllowed": spot, "isMarginTradingAllowed": True}
