import json
from decimal import Decimal

import pytest
from fake_exchange import Exchange, H, raw, symbol
from pyspark.sql import functions as F

from tidemark import errors as E
from tidemark.operators.ingest import Downloader, Orchestrator, PipelineConfig, PipelineRequest, snapshot_tickers, sync_universe
from tidemark.operators.store import Store, decimal_text, kline_row
from tidemark.sources import KlineDataSource, RestClient, decode_klines
from tidemark.sources.client import Answer, Retry

COIN = {"symbol": "btcusdt ", "base_asset": "BTC", "quote_asset": "USDT", "status": "TRADING", "updated_at": 1}


def kline(t, close="50500.12345678", **more):
    return {"symbol": "BTCUSDT", "interval": "1h", "open_time": t, "open_price": "50000.00000001", "high_price": "51000", "low_price": "49000", "close_price": close, "volume": "123.45678900", "close_time": t + H - 1,
            "quote_asset_volume": "1", "number_of_trades": 3, "taker_buy_base_volume": "1", "taker_buy_quote_volume": "1", **more}


@pytest.fixture()
def store(spark, tmp_path):
    found = Store(spark, f"file://{tmp_path}/store")
    found.initialize()
    found.upsert_symbols([COIN])
    return found


def system(store, exchange, **retry):
    waits = []
    client = RestClient("http://x", exchange)
    return Downloader(store, client, Retry(sleep=waits.append, **retry)), waits


def test_store_basics(store):
    store.initialize()
    assert store.schema_version() == 1
    made = store.symbol("BTCUSDT")["created_at"]
    store.upsert_symbols([COIN | {"status": "BREAK"}, COIN | {"symbol": "ETHUSDT"}])
    assert store.symbol(" btcusdt")["created_at"] == made and store.symbol("BTCUSDT")["status"] == "BREAK"
    assert [r["symbol"] for r in store.symbols("usdt").collect()] == ["BTCUSDT", "ETHUSDT"] and store.symbols("BTC").count() == 0
    assert store.symbol("XRP") is None
    with pytest.raises(ValueError):
        store.symbols(" ")


def test_klines_upsert_and_lookups(store):
    assert store.upsert_klines([]) == 0
    assert store.upsert_klines([kline(0), kline(H), kline(0, "50600")]) == 3
    assert store.upsert_klines([kline(H, "50700"), kline(2 * H)]) == 2
    assert [(r["open_time"] // H, r["close_price"]) for r in store.kline_range("BTCUSDT", "1h", 0, 2 * H).collect()] == [(0, Decimal("50600")), (1, Decimal("50700"))]
    assert [r[0] // H for r in store.open_times("BTCUSDT", "1h", 0, 2 * H).collect()] == [0, 1, 2]
    assert [r["open_time"] // H for r in store.latest_klines("BTCUSDT", "1h", 2).collect()] == [2, 1]
    assert store.latest_kline_in_range("BTCUSDT", "1h", 0, H)["open_time"] == H
    assert store.latest_kline_in_range("BTCUSDT", "1h", 9 * H, 10 * H) is None
    store.insert_kline(kline(3 * H))
    with pytest.raises(E.StoreIntegrityError):
        store.insert_kline(kline(3 * H))
    with pytest.raises(E.StoreIntegrityError):
        store.upsert_klines([kline(0, symbol="NONE")])
    with pytest.raises(E.StoreIntegrityError):
        store.upsert_klines([kline(0, raw_response_id=99)])
    with pytest.raises(ValueError, match="row 1"):
        store.upsert_klines([kline(9 * H), kline(-1)])
    with pytest.raises(ValueError):
        store.upsert_klines([kline(0)], chunk_size=0)
    assert store.table("klines").count() == 4


def test_only_touched_series_are_rewritten(store):
    store.upsert_symbols([COIN | {"symbol": "ETHUSDT"}])
    store.upsert_klines([kline(0), kline(0, symbol="ETHUSDT"), kline(H, symbol="ETHUSDT")])
    before = store._pointer()["tables"]["klines"]
    store.upsert_klines([kline(0, "50600")])
    after = store._pointer()["tables"]["klines"]
    assert [k for k in after if after[k] != before[k]] == ["1h/BTCUSDT"] and len(after) == 2
    assert store.table("klines").count() == 3 and store.klines("ETHUSDT", "1h").count() == 2 and store.klines("ETHUSDT", "5m").count() == 0
    assert len(store.klines("ETHUSDT", "1h").inputFiles()) < len(store.table("klines").inputFiles())


def test_scalars():
    assert decimal_text("1.50") == Decimal("1.50")
    for wrong, error in ((1.5, TypeError), (True, TypeError), ("NaN", ValueError), ("x", ValueError)):
        with pytest.raises(error):
            decimal_text(wrong)
    with pytest.raises(ValueError, match="has no"):
        kline_row({"symbol": "A"})


def test_appends_runs_and_lineage(store):
    run = store.start_run("x", 5)
    first, second = store.archive_responses([{"endpoint": "/a", "response_json": j, "ingestion_run_id": run, "fetched_at": 1} for j in ("[]", "[]")])
    assert second == first + 1
    hashes = {r["content_hash"] for r in store.table("raw_api_responses").collect()}
    assert hashes == {"4f53cda18c2baa0c0354bb5f9a3ecbe5ed12ab4d8e11ba873c2f11161202b945"}
    store.update_run(run, "completed", records_fetched=7)
    assert store.table("ingestion_runs").first()[2:8] == ("completed", 5, None, 7, 0, None)
    with pytest.raises(E.StoreError):
        store.update_run(99, "failed")
    with pytest.raises(E.StoreIntegrityError):
        store.archive_responses([{"endpoint": "/a", "response_json": "{}", "ingestion_run_id": 99, "fetched_at": 1}])
    store.append_status_events([{"symbol": "BTCUSDT", "status": " break", "is_spot_trading_allowed": True, "effective_at": t} for t in (1, 3, 3)])
    assert [(r["effective_at"], r["id"], r["status"]) for r in store.status_events("BTCUSDT", 2).collect()] == [(3, 3, "BREAK"), (3, 2, "BREAK")]
    store.append_tickers([{"symbol": "BTCUSDT", "price": "1.5", "snapshot_at": 4}])
    assert store.tickers("BTCUSDT").first()["price"] == Decimal("1.5")


def test_newer_store_is_refused(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    assert store.schema_version() is None
    store._commit({"number": 0, "schema_version": 2, "tables": {}})
    with pytest.raises(E.StoreInitError):
        store.initialize()
    with pytest.raises(E.StoreError, match="another"):
        store._commit({"number": 0, "schema_version": 1, "tables": {}})


@pytest.mark.parametrize(
    "answer, error",
    [
        (Answer(200, "x"), E.ClientResponseError), (Answer(500, "x"), E.ClientHttpError), (Answer(200, '{"code": -1, "msg": "no"}'), E.ClientApiError),
        (Answer(429, "{}"), E.ClientHttpError), (Answer(200, "{}"), E.ClientResponseError),
    ],
)
def test_client_errors(answer, error):
    with pytest.raises(error):
        RestClient("http://x", lambda url, timeout: answer).server_time()


def test_client_requests():
    exchange = Exchange(5, tickers=[{"symbol": "A", "price": "1"}])
    client = RestClient("http://x/", exchange)
    assert client.server_time() == 5
    client.exchange_info(symbols=["a", "b"])
    assert exchange.asked[-1] == ("/api/v3/exchangeInfo", {"symbols": '["A","B"]'})
    client.exchange_info("a", ["b"])
    assert exchange.asked[-1][1] == {"symbol": "A"}
    assert client.ticker_price() == [{"symbol": "A", "price": "1"}]
    for wrong in (0, 1001, True):
        with pytest.raises(ValueError):
            client.klines("A", "1h", limit=wrong)
    with pytest.raises(ValueError):
        client.klines("A", "1H")


def test_backfill_pages_resume_and_lineage(store):
    exchange = Exchange(2000 * H + 5, {("BTCUSDT", "1h"): list(range(0, 1501 * H, H))})
    loader, waits = system(store, exchange)
    done = loader.download("BTCUSDT", "1h", 10, 1499 * H)
    assert (done.pages, done.fetched, done.stored, done.effective_start, done.status) == (2, 1500, 1500, 0, "completed")
    assert done.report == {"expected": 1500, "actual": 1500, "missing": 0, "coverage_ratio": 1.0} and waits == [0.2]
    assert loader.download("BTCUSDT", "1h", 0, 1499 * H).status == "already_up_to_date"
    more = loader.download("BTCUSDT", "1h", 0, 1600 * H)
    assert (more.effective_start, more.stored) == (1500 * H, 1)
    chain = store.table("klines").join(store.table("raw_api_responses").withColumnRenamed("id", "raw_response_id"), "raw_response_id").join(store.table("ingestion_runs").withColumnRenamed("id", "ingestion_run_id"), "ingestion_run_id")
    assert chain.count() == 1501
    pages = store.table("raw_api_responses").select("response_json")
    assert decode_klines(pages).select("open_time").distinct().count() == 1501


def test_forming_candles_are_archived_and_not_stored(store):
    exchange = Exchange(3 * H - 1, {("BTCUSDT", "1h"): [0, H, 2 * H]})
    loader, _ = system(store, exchange)
    done = loader.download("BTCUSDT", "1h", 0, 9 * H)
    assert (done.fetched, done.stored, done.effective_end) == (3, 2, 3 * H - 2)
    assert len(json.loads(store.table("raw_api_responses").first()["response_json"])) == 3
    assert done.report["missing"] == 1
    again = loader.download("BTCUSDT", "1h", 0, 9 * H)
    assert (again.pages, again.stored, again.report["expected"]) == (1, 0, 0)


def test_retries(store):
    exchange = Exchange(99 * H, {("BTCUSDT", "1h"): [0]})
    exchange.fail = [Answer(429, "{}", {"Retry-After": "7"}), E.ClientTimeoutError("t"), Answer(429, "{}")]
    loader, waits = system(store, exchange)
    assert loader.download("BTCUSDT", "1h", 0, H).stored == 1 and waits == [7.0, 2.0, 2.0]
    for failure in (Answer(418, "{}"), Answer(500, "x")):
        exchange.fail = [failure]
        with pytest.raises(E.ClientHttpError):
            loader.download("BTCUSDT", "1h", 0, H, resume=False)
    exchange.fail = [E.ClientConnectionError("c")] * 4
    with pytest.raises(E.ClientConnectionError):
        loader.download("BTCUSDT", "1h", 0, H, resume=False)
    assert [r["status"] for r in store.table("ingestion_runs").orderBy("id").collect()] == ["completed", "failed", "failed", "failed"]
    with pytest.raises(E.StoreError):
        loader.download("NONE", "1h", 0, H)
    for wrong in ({"delay_ms": True}, {"max_retries": 1.0}):
        with pytest.raises(TypeError):
            Retry(**wrong)


def test_pacing_follows_the_used_weight():
    waits, exchange = [], Exchange(0)
    client = RestClient("http://x", exchange)
    for told, wait in (("900", 0.5), ("1001", 1.0), ("x", 0.2), ("10", 0.2)):
        exchange.headers = {"X-Used-Weight-1m": told}
        client.klines("A", "1h")
        Retry(sleep=waits.append).pace(client)
        assert waits[-1] == wait


def test_universe_lifecycle(store):
    exchange = Exchange(100, symbols=[symbol("BTCUSDT"), symbol("ETHUSDT"), symbol("ETHBTC", quote="BTC")])
    client = RestClient("http://x", exchange)
    first = sync_universe(store, client)
    assert (first["fetched"], first["stored"], first["events"], first["effective_at"]) == (3, 2, 2, 100)
    exchange.symbols = exchange.symbols[:1]
    assert sync_universe(store, client)["changes"] == {"unchanged": 1, "delisted": 1}
    exchange.symbols.append(symbol("ETHUSDT"))
    assert sync_universe(store, client)["events"] == 1
    assert sync_universe(store, client)["events"] == 0
    assert [r["status"] for r in store.status_events("ETHUSDT").collect()] == ["TRADING", "DELISTED", "TRADING"]
    exchange.tickers = [{"symbol": "BTCUSDT", "price": "2"}, {"symbol": "ZZZ", "price": "1"}]
    assert snapshot_tickers(store, client) == 1
    with pytest.raises(E.ClientResponseError):
        sync_universe(store, RestClient("http://x", lambda u, t: Answer(200, "[]")))
    assert store.table("ingestion_runs").orderBy(F.desc("id")).first()["status"] == "failed"


def test_orchestrated_repair(store):
    store.upsert_symbols([COIN | {"symbol": "ETHUSDT"}])
    hours = [h * H for h in range(24)]
    exchange = Exchange(24 * H, {("BTCUSDT", "1h"): [t for t in hours if t // H not in (5, 6, 7)]})
    loader, _ = system(store, exchange)
    run = Orchestrator(store, loader).run
    ask = lambda **more: PipelineRequest(["BTCUSDT"], ["1h"], 0, 23 * H, **more)
    found = run(ask(repair_gaps=False))
    pair = found.results["BTCUSDT", "1h"]
    assert (found.status, pair.coverage, pair.repair, pair.initial["missing"]) == ("completed_with_gaps", "gaps_found", "not_requested", 3)
    found = run(ask(download_before_scan=False))
    assert (found.repairs_attempted, found.repairs_completed, found.results["BTCUSDT", "1h"].repair) == (1, 1, "incomplete")
    exchange.candles["BTCUSDT", "1h"] = hours
    found = run(ask(download_before_scan=False))
    pair = found.results["BTCUSDT", "1h"]
    assert (found.status, pair.repair, pair.repairs[0]["recovered"], pair.final["is_complete"]) == ("completed", "completed", 3, True)
    found = run(PipelineRequest(["NONE", "BTCUSDT"], ["1h"], 0, 23 * H))
    assert (found.status, found.completed, found.failed, len(found.errors)) == ("partial_failure", 1, 1, 1)
    found = run(PipelineRequest(["NONE", "BTCUSDT"], ["1h"], 0, 23 * H, config=PipelineConfig(fail_fast=True)))
    assert (found.status, list(found.results), found.total_symbols) == ("failed", [("NONE", "1h")], 2)
    edge = run(PipelineRequest(["ETHUSDT"], ["1h"], 0, 23 * H, download_before_scan=False, config=PipelineConfig(repair_interior_only=True)))
    assert (edge.results["ETHUSDT", "1h"].repair, edge.results["ETHUSDT", "1h"].coverage) == ("not_needed", "gaps_found")


@pytest.mark.parametrize("change, error", [({"symbols": []}, ValueError), ({"symbols": [" "]}, ValueError), ({"intervals": ["2h"]}, ValueError), ({"start_time": 5}, ValueError), ({"start_time": True}, TypeError), ({"repair_gaps": 1}, TypeError), ({"config": {}}, TypeError)])
def test_requests_are_checked(change, error):
    with pytest.raises(error):
        PipelineRequest(**({"symbols": ["A"], "intervals": ["1h"], "start_time": 0, "end_time": 5} | change))


def test_data_source(spark):
    spark.dataSource.register(KlineDataSource)
    df = spark.read.format("exchange_klines").options(base_url="http://x", symbols="BTCUSDT,ETHUSDT", intervals="1h", start=0, end=100 * H, transport="fake_exchange:page_transport", delay_ms=0, partition_pages=1).load()
    assert {r["symbol"]: r["n"] for r in df.groupBy("symbol").agg(F.count("*").alias("n")).collect()} == {"BTCUSDT": 101, "ETHUSDT": 24}
    assert df.schema["close_price"].dataType.simpleString() == "decimal(38,18)"


def test_raw_fixture_decodes(spark):
    df = spark.createDataFrame([("A", "1h", json.dumps([raw(0, H), ["short"]]))], "symbol string, `interval` string, response_json string")
    row = decode_klines(df).first()
    assert decode_klines(df).count() == 1 and (row["position"], row["volume"], row["number_of_trades"]) == (0, Decimal("10.5"), 50)


def test_appends_read_nothing_and_fold_parts(spark, tmp_path):
    """A table of n appends has some log n parts, and ids and rows are those of one write."""
    import tidemark.operators.store as module

    fold, module.FOLD = module.FOLD, 3
    try:
        store = Store(spark, f"file://{tmp_path}")
        store.initialize()
        store.upsert_symbols([{"symbol": "AAA", "base_asset": "A", "quote_asset": "Q", "status": "TRADING", "updated_at": 1}])
        ids = [store.archive_responses([{"endpoint": "e", "params_json": "{}", "response_json": f"[{k}]", "fetched_at": k}])[0] for k in range(10)]
        assert ids == list(range(1, 11)) and len(store._tables()["raw_api_responses"]) == 2
        rows = store.table("raw_api_responses").orderBy("id").collect()
        assert [(r["id"], r["response_json"]) for r in rows] == [(k + 1, f"[{k}]") for k in range(10)] and len({r["content_hash"] for r in rows}) == 10
        bar = {"symbol": "AAA", "interval": "1h", "open_price": "1", "high_price": "2", "low_price": "1", "close_price": "2", "volume": "3", "quote_asset_volume": "4", "number_of_trades": 5, "taker_buy_base_volume": "1", "taker_buy_quote_volume": "1"}
        at = lambda k, volume="3": bar | {"open_time": k * 3_600_000, "close_time": (k + 1) * 3_600_000 - 1, "volume": volume}
        for k in range(4):
            store.upsert_klines([at(2 * k), at(2 * k + 1, "7"), at(2 * k + 1)])
        parts = store._tables()["klines"]["1h/AAA"]["parts"]
        assert [level for _, level in parts] == [1, 0]
        store.upsert_klines([at(2, "9"), at(8)])  # an older candle: the series is written anew
        assert len(store._tables()["klines"]["1h/AAA"]["parts"]) == 1
        assert [(r["open_time"] // 3_600_000, int(r["volume"])) for r in store.klines("AAA", "1h").orderBy("open_time").collect()] == [(k, 9 if k == 2 else 3) for k in range(9)]
    finally:
        module.FOLD = fold
