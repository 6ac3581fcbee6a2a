"""The exchange's public REST endpoints over an exchangeable transport."""

from __future__ import annotations

import json
import socket
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from tidemark.errors import ClientApiError, ClientConnectionError, ClientHttpError, ClientResponseError, ClientTimeoutError
from tidemark.types import interval_ms, symbol_name

PAGE_LIMIT = 1000
#: Weight used, as the exchange's headers tell it, above which a request waits so many seconds at least.
THROTTLE = ((1000, 1.0), (700, 0.5))


@dataclass(frozen=True)
class Answer:
    """What a transport returns: status, text, headers."""

    status: int
    text: str
    headers: dict[str, str] = field(default_factory=dict)


Transport = Callable[[str, float], Answer]


def http(url: str, timeout: float) -> Answer:
    """A GET request by the standard library."""
    try:
        with urllib.request.urlopen(url, timeout=timeout) as r:
            return Answer(r.status, r.read().decode(), dict(r.headers))
    except urllib.error.HTTPError as e:
        return Answer(e.code, e.read().decode(errors="replace"), dict(e.headers))
    except (TimeoutError, socket.timeout) as e:
        raise ClientTimeoutError(str(e)) from e
    except urllib.error.URLError as e:
        raise (ClientTimeoutError if isinstance(e.reason, TimeoutError) else ClientConnectionError)(str(e.reason)) from e


class RestClient:
    """Four GET endpoints. `headers` holds those of the last answer, in lower case."""

    def __init__(self, base_url: str, transport: Transport = http, timeout: float = 10.0):
        self.base_url, self.transport, self.timeout = base_url.rstrip("/"), transport, timeout
        self.headers: dict[str, str] = {}

    def request(self, endpoint: str, params: dict[str, Any] | None = None) -> Any:
        """The decoded payload; errors by kind. Parameters that are None aren't sent."""
        sent = urllib.parse.urlencode({k: v for k, v in (params or {}).items() if v is not None})
        answer = self.transport(f"{self.base_url}{endpoint}" + (f"?{sent}" if sent else ""), self.timeout)
        self.headers = {k.lower(): v for k, v in answer.headers.items()}
        ok = 200 <= answer.status < 400
        try:
            payload = json.loads(answer.text)
        except ValueError as e:
            if ok:
                raise ClientResponseError(f"{endpoint}: not JSON") from e
            raise ClientHttpError(f"{endpoint}: status {answer.status}", answer.status) from e
        if isinstance(payload, dict) and payload.get("code", 0) != 0 and "msg" in payload:
            raise ClientApiError(f"{endpoint}: {payload['code']} {payload['msg']}", payload["code"], answer.status)
        if not ok:
            raise ClientHttpError(f"{endpoint}: status {answer.status}", answer.status)
        return payload

    def server_time(self) -> int:
        payload = self.request("/api/v3/time")
        if not isinstance(payload, dict) or "serverTime" not in payload:
            raise ClientResponseError("no serverTime")
        return int(payload["serverTime"])

    def exchange_info(self, symbol: str | None = None, symbols: list[str] | None = None) -> dict:
        """Metadata of one symbol, of some, or of all."""
        params: dict[str, Any] = {}
        if symbol is not None:
            params["symbol"] = symbol_name(symbol)
        elif symbols is not None:
            params["symbols"] = json.dumps([symbol_name(s) for s in symbols], separators=(",", ":"))
        payload = self.request("/api/v3/exchangeInfo", params)
        if not isinstance(payload, dict) or not isinstance(payload.get("symbols"), list):
            raise ClientResponseError("no list of symbols")
        return payload

    def ticker_price(self, symbol: str | None = None) -> list[dict]:
        payload = self.request("/api/v3/ticker/price", {"symbol": symbol and symbol_name(symbol)})
        found = payload if isinstance(payload, list) else [payload]
        if not all(isinstance(x, dict) and "symbol" in x and "price" in x for x in found):
            raise ClientResponseError("a ticker has no symbol or price")
        return found

    def klines(self, symbol: str, interval: str, start: int | None = None, end: int | None = None, limit: int = PAGE_LIMIT) -> list[list]:
        """A page of raw candles, positions as the exchange has them."""
        interval_ms(interval)
        if isinstance(limit, bool) or not isinstance(limit, int) or not 1 <= limit <= PAGE_LIMIT:
            raise ValueError(f"limit is from 1 to {PAGE_LIMIT}, got {limit!r}")
        payload = self.request("/api/v3/klines", {"symbol": symbol_name(symbol), "interval": getattr(interval, "value", interval), "startTime": start, "endTime": end, "limit": limit})
        if not isinstance(payload, list) or not all(isinstance(k, list) and len(k) >= 11 for k in payload):
            raise ClientResponseError("candles are lists of 11 values at least")
        return payload

    def used_weight(self) -> int:
        """The largest weight that the last answer's headers tell."""
        told = [v.strip() for k, v in self.headers.items() if "used-weight" in k]
        return max([0, *(int(v) for v in told if v.isdigit())])


@dataclass
class Retry:
    """How a page is asked for again, and how long requests wait; one counter for all kinds of failure."""

    delay_ms: float = 200.0
    max_retries: int = 3
    sleep: Callable[[float], None] = time.sleep

    def __post_init__(self) -> None:
        if isinstance(self.delay_ms, bool) or not isinstance(self.delay_ms, int | float):
            raise TypeError("delay_ms must be a number")
        if isinstance(self.max_retries, bool) or not isinstance(self.max_retries, int):
            raise TypeError("max_retries must be int")
        if self.delay_ms < 0 or self.max_retries < 0:
            raise ValueError("delay_ms and max_retries must not be negative")

    def page(self, client: RestClient, *args: Any) -> list[list]:
        """A page of candles. Limits by rate wait as long as the exchange says, lost connections twice as long each time."""
        tries = 0
        while True:
            try:
                return client.klines(*args)
            except (ClientHttpError, ClientTimeoutError, ClientConnectionError) as e:
                limited = isinstance(e, ClientHttpError)
                if limited and e.status != 429 or tries >= self.max_retries:
                    raise
                told = client.headers.get("retry-after", "")
                self.sleep(max(float(told), 1.0) if limited and told.replace(".", "", 1).isdigit() else 2.0 if limited else float(2**tries))
                tries += 1

    def pace(self, client: RestClient) -> None:
        """Waits between two pages."""
        used = client.used_weight()
        self.sleep(max(self.delay_ms / 1000, next((s for most, s in THROTTLE if used > most), 0.0)))
