"""Backfill, universe sync, and the coverage pipeline: network calls in sequence, everything else as Spark jobs."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import functions as F

from tidemark.errors import StoreError
from tidemark.operators.continuity import coverage, gap_report, repair_plan
from tidemark.operators.store import Store, now_ms
from tidemark.operators.universe import universe_diff
from tidemark.sources.client import PAGE_LIMIT, RestClient, Retry
from tidemark.sources.decode import KLINE_FIELDS, decode_exchange_info, decode_tickers
from tidemark.types import epoch_ms, interval_ms, symbol_name


@dataclass(frozen=True)
class DownloadResult:
    symbol: str
    interval: str
    run_id: int
    requested_start: int
    requested_end: int
    effective_start: int
    effective_end: int
    pages: int
    fetched: int
    stored: int
    report: dict[str, Any]
    seconds: float
    status: str


def _json(value: Any) -> str:
    return json.dumps(value, separators=(",", ":"))


class Downloader:
    """Backfill of candles into a store, with the raw pages archived first."""

    def __init__(self, store: Store, client: RestClient, retry: Retry | None = None):
        self.store, self.client, self.retry = store, client, retry or Retry()

    def download(self, symbol: str, interval: str, start: int, end: int, resume: bool = True) -> DownloadResult:
        """Candles that open from start on and are closed by the server's time.

        With resume, only what follows the last stored candle of the range is asked for. Each page is archived in one
        commit, forming candles included, and its closed candles are stored in another. A failure marks the run.
        """
        ms, symbol = interval_ms(interval), symbol_name(symbol)
        epoch_ms(start, "start")
        epoch_ms(end, "end")
        if start > end:
            raise ValueError("start must not be after end")
        if not isinstance(resume, bool):
            raise TypeError("resume must be bool")
        if self.store.symbol(symbol) is None:
            raise StoreError(f"no symbol {symbol}")
        began = time.monotonic()
        run = self.store.start_run("historical_klines", now_ms())
        pages = fetched = stored = 0
        try:
            server = self.client.server_time()
            first, last, status = start - start % ms, min(end, server - 1), "completed"
            at = first
            if resume and (row := self.store.latest_kline_in_range(symbol, interval, first, last) if last >= first else None):
                at = row["close_time"] + 1
                status = "already_up_to_date" if at > last else status
            effective, seen, forming = at, [], False
            while at <= last:
                page = self.retry.page(self.client, symbol, interval, at, last, PAGE_LIMIT)
                pages += 1
                fetched += len(page)
                closed = [k for k in page if int(k[6]) < server]
                if not closed:
                    forming = bool(page)
                    break
                asked = {"symbol": symbol, "interval": interval, "startTime": at, "endTime": last, "limit": PAGE_LIMIT}
                raw = self.store.archive_responses([{"endpoint": "/api/v3/klines", "params_json": _json(asked), "response_json": _json(page), "ingestion_run_id": run, "fetched_at": now_ms()}])[0]
                rows = [dict(zip(KLINE_FIELDS, map(str, k), strict=False)) | {"symbol": symbol, "interval": interval, "raw_response_id": raw} for k in closed]
                stored += self.store.upsert_klines([r | {n: int(r[n]) for n in ("open_time", "close_time", "number_of_trades")} for r in rows])
                seen += [int(k[0]) for k in closed]
                after = int(closed[-1][6]) + 1
                if after <= at:
                    raise RuntimeError(f"{symbol} {interval}: a page ends before {at}")
                at = after
                if len(page) < PAGE_LIMIT or len(closed) < len(page):
                    break
                if at <= last:
                    self.retry.pace(self.client)
            nothing = status != "completed" or effective > last or (forming and not seen)
            report = {"expected": 0, "actual": 0, "missing": 0, "coverage_ratio": 1.0} if nothing else self._report(symbol, interval, seen, effective, last)
            self.store.update_run(run, "completed", completed_at=now_ms(), records_fetched=fetched, records_stored=stored)
        except Exception as e:
            self.store.update_run(run, "failed", completed_at=now_ms(), records_fetched=fetched, records_stored=stored, error_message=str(e) or type(e).__name__)
            raise
        return DownloadResult(symbol, interval, run, start, end, effective, last, pages, fetched, stored, report, time.monotonic() - began, status)

    def _report(self, symbol: str, interval: str, seen: list[int], start: int, end: int) -> dict[str, Any]:
        spark = self.store.spark
        bars = spark.createDataFrame([(symbol, interval, t) for t in seen], "symbol string, `interval` string, open_time long")
        asked = spark.createDataFrame([(symbol, interval, start, end)], "symbol string, `interval` string, expected_start long, expected_end long")
        report, _ = gap_report(asked, bars)
        return report.drop("symbol", "interval").first().asDict()


def sync_universe(store: Store, client: RestClient, quote_asset: str = "USDT") -> dict[str, Any]:
    """Stores the exchange's instruments of a quote asset: the payload in one commit, symbols and events in another."""
    quote = symbol_name(quote_asset)
    run = store.start_run("exchange_info_sync", now_ms())
    try:
        fetched_at = now_ms()
        payload = client.exchange_info()
        raw = store.archive_responses([{"endpoint": "/api/v3/exchangeInfo", "params_json": "{}", "response_json": _json(payload), "ingestion_run_id": run, "fetched_at": fetched_at}])[0]
        snapshot = decode_exchange_info(store.table("raw_api_responses").filter(F.col("id") == raw)).cache()
        changes = universe_diff(store.table("symbols"), snapshot, quote)
        counts = {r["change"]: r["count"] for r in changes.groupBy("change").count().collect()}
        effective = payload.get("serverTime") or fetched_at
        written, events = store.write_universe(changes, effective, raw)
        total = snapshot.count()
        snapshot.unpersist()
        store.update_run(run, "completed", completed_at=now_ms(), records_fetched=total, records_stored=written)
    except Exception as e:
        store.update_run(run, "failed", completed_at=now_ms(), error_message=str(e) or type(e).__name__)
        raise
    return {"run_id": run, "raw_response_id": raw, "effective_at": effective, "fetched": total, "stored": written, "events": events, "changes": counts}


def snapshot_tickers(store: Store, client: RestClient, symbol: str | None = None) -> int:
    """Stores current prices of known symbols, with the payload archived."""
    at = now_ms()
    raw = store.archive_responses([{"endpoint": "/api/v3/ticker/price", "response_json": _json(client.ticker_price(symbol)), "fetched_at": at}])[0]
    found = decode_tickers(store.table("raw_api_responses").filter(F.col("id") == raw).select("response_json"))
    known = found.join(store.table("symbols").select("symbol"), "symbol", "left_semi").collect()  # the instruments of one exchange
    return len(store.append_tickers([{"symbol": r["symbol"], "price": r["price"], "snapshot_at": at, "raw_response_id": raw} for r in known]))


# -- coverage and repair ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class PipelineConfig:
    fail_fast: bool = False
    repair_interior_only: bool = False

    def __post_init__(self) -> None:
        for name, value in vars(self).items():
            if not isinstance(value, bool):
                raise TypeError(f"{name} must be bool")


@dataclass(frozen=True)
class PipelineRequest:
    symbols: Sequence[str]
    intervals: Sequence[str]
    start_time: int
    end_time: int
    download_before_scan: bool = True
    repair_gaps: bool = True
    config: PipelineConfig | None = None

    def __post_init__(self) -> None:
        for name in ("symbols", "intervals"):
            if not isinstance(getattr(self, name), list | tuple) or not getattr(self, name):
                raise ValueError(f"{name} must be a non-empty list or tuple")
        for s in self.symbols:
            symbol_name(s)
        for i in self.intervals:
            interval_ms(i)
        if epoch_ms(self.start_time, "start_time") >= epoch_ms(self.end_time, "end_time"):
            raise ValueError("start_time must be before end_time")
        for name in ("download_before_scan", "repair_gaps"):
            if not isinstance(getattr(self, name), bool):
                raise TypeError(f"{name} must be bool")
        if self.config is not None and not isinstance(self.config, PipelineConfig):
            raise TypeError("config must be a PipelineConfig or None")


@dataclass
class SeriesResult:
    """Download is not_started, completed or failed; coverage not_checked, complete or gaps_found; repair not_requested, not_needed, completed or incomplete."""

    symbol: str
    interval: str
    download: str = "not_started"
    coverage: str = "not_checked"
    repair: str = "not_requested"
    initial: dict[str, Any] | None = None
    final: dict[str, Any] | None = None
    repairs: list[dict[str, Any]] = field(default_factory=list)
    error: str | None = None


@dataclass
class PipelineResult:
    """Status is completed, completed_with_gaps, failed or partial_failure."""

    status: str
    results: dict[tuple[str, str], SeriesResult]
    total_symbols: int
    total_intervals: int
    completed: int
    failed: int
    repairs_attempted: int
    repairs_completed: int
    seconds: float
    errors: list[str]


class Orchestrator:
    """Download, scan, repair and verify for every pair of symbol and interval.

    Downloads and repairs follow each other, by symbol first; coverage is scanned in one job for all series, and the
    repaired ones are verified in another.
    """

    def __init__(self, store: Store, downloader: Downloader, server_time: Callable[[], int] | None = None):
        if not isinstance(store, Store) or not isinstance(downloader, Downloader):
            raise TypeError("a Store and a Downloader are needed")
        self.store, self.downloader, self.server_time = store, downloader, server_time or downloader.client.server_time

    def scan(self, series: Sequence[tuple[str, str]], start: int, end: int, server_time: int | None) -> tuple[dict, dict]:
        """Reports and gaps by series."""
        asked = self.store.spark.createDataFrame([(s, i, start, end, server_time) for s, i in series], "symbol string, `interval` string, `start` long, `end` long, server_time long")
        report, gaps = coverage(asked, self.store.table("klines"))
        reports = {(r["symbol"], r["interval"]): r.asDict() for r in report.collect()}  # a row per series
        found: dict[tuple[str, str], list[dict]] = {}
        for g in repair_plan(gaps).collect():  # what is to be downloaded, gap by gap
            found.setdefault((g["symbol"], g["interval"]), []).append(g.asDict())
        order = ("leading", "interior", "trailing", "full_range")
        return reports, {k: sorted(v, key=lambda g: (order.index(g["gap_type"]), g["gap_start"])) for k, v in found.items()}

    def run(self, request: PipelineRequest) -> PipelineResult:
        if not isinstance(request, PipelineRequest):
            raise TypeError("request must be a PipelineRequest")
        began, config = time.monotonic(), request.config or PipelineConfig()
        start, end = request.start_time, request.end_time
        results: dict[tuple[str, str], SeriesResult] = {}
        for pair in [(symbol_name(s), getattr(i, "value", i)) for s in request.symbols for i in request.intervals]:
            found = results[pair] = SeriesResult(*pair)
            if request.download_before_scan:
                try:
                    self.downloader.download(*pair, start, end)
                    found.download = "completed"
                except Exception as e:  # a series' failure doesn't end the others
                    found.download, found.error = "failed", f"Download failed: {e}"
                    if config.fail_fast:
                        break
        try:
            server = self.server_time()
        except Exception:  # without the server's time nothing is clamped
            server = None
        self._scan_and_repair(results, request, config, start, end, server)
        return self._summary(results, request, time.monotonic() - began)

    def _scan_and_repair(self, results, request, config, start, end, server) -> None:
        try:
            reports, gaps = self.scan(list(results), start, end, server)
        except Exception as e:
            for found in results.values():
                found.error = str(e) or type(e).__name__
                found.download = "failed" if found.download == "not_started" else found.download
            return
        for pair, found in results.items():
            found.initial = found.final = reports[pair]
            found.coverage = "complete" if reports[pair]["is_complete"] else "gaps_found"
            wanted = [g for g in gaps.get(pair, []) if g["gap_type"] == "interior" or not config.repair_interior_only]
            if found.coverage == "complete" or (request.repair_gaps and not wanted):
                found.repair = "not_needed"
            for gap in wanted if request.repair_gaps and found.coverage != "complete" else []:
                try:
                    done = self.downloader.download(*pair, gap["download_start"], gap["download_end"], resume=False)
                    found.repairs.append({"gap": gap, "recovered": done.stored, "success": True, "error": None})
                except Exception as e:
                    found.repairs.append({"gap": gap, "recovered": 0, "success": False, "error": str(e) or type(e).__name__})
        again = [pair for pair, found in results.items() if found.repairs]
        if again:
            reports, _ = self.scan(again, start, end, server)
            for pair in again:
                found = results[pair]
                found.final = reports[pair]
                found.repair = "completed" if reports[pair]["is_complete"] else "incomplete"
                found.coverage = "complete" if reports[pair]["is_complete"] else "gaps_found"

    def _summary(self, results, request, seconds) -> PipelineResult:
        failed = sum(r.download == "failed" for r in results.values())
        whole = all(r.coverage == "complete" for r in results.values())
        status = "failed" if failed == len(results) else "partial_failure" if failed else "completed" if whole else "completed_with_gaps"
        tried = [x for r in results.values() for x in r.repairs]
        errors = [f"{r.symbol} {r.interval}: {r.error}" for r in results.values() if r.error]
        return PipelineResult(status, results, len(request.symbols), len(request.intervals), len(results) - failed, failed, len(tried), sum(x["success"] for x in tried), seconds, errors)
