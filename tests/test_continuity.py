import pytest
from pyspark.sql import functions as F

from tidemark import errors as E
from tidemark.operators.continuity import coverage, gap_report, missing_bars, repair_plan
from tidemark.operators.universe import universe_diff
from tidemark.operators.validation import first_violations, validate, violations

H = 3_600_000


def bars(spark, hours, symbol="A"):
    return spark.createDataFrame([(symbol, "1h", int(h * H)) for h in hours], "symbol string, `interval` string, open_time long")


def covered(spark, hours, start, end, server=None):
    asked = spark.createDataFrame([("A", "1h", int(start * H), int(end * H), server)], "symbol string, `interval` string, `start` long, `end` long, server_time long")
    report, gaps = coverage(asked, bars(spark, hours))
    return report.first(), [(g["gap_type"], g["gap_start"] // H, g["gap_end"] // H, g["missing"]) for g in gaps.orderBy("gap_start").collect()]


@pytest.mark.parametrize(
    "hours, end, gaps",
    [
        ([3, 4, 5], 5, [("leading", 0, 2, 3)]),
        ([0, 1, 4, 8], 8, [("interior", 2, 3, 2), ("interior", 5, 7, 3)]),
        ([0, 1, 2, 3, 4], 7, [("trailing", 5, 7, 3)]),
        ([], 5, [("full_range", 0, 5, 6)]),
        ([0, 1, 1, 2], 2, []),
        ([1, 3], 4, [("leading", 0, 0, 1), ("interior", 2, 2, 1), ("trailing", 4, 4, 1)]),
    ],
)
def test_coverage_gaps(spark, hours, end, gaps):
    report, found = covered(spark, hours, 0, end)
    assert found == gaps
    assert report["missing"] == sum(g[3] for g in gaps) and report["is_complete"] == (not gaps)
    assert report["expected"] == end + 1 and report["actual"] == len(set(hours))
    assert report["coverage_ratio"] == pytest.approx(len(set(hours)) / (end + 1), abs=1e-6)


def test_coverage_is_clamped_and_aligned(spark):
    report, gaps = covered(spark, range(10), 0, 20, int(8.5 * H))
    assert (report["aligned_end"], report["expected"], report["is_complete"], gaps) == (7 * H, 8, True, [])
    report, gaps = covered(spark, [], 5.5, 6, int(2 * H))
    assert (report["aligned_start"], report["expected"], report["coverage_ratio"], report["is_complete"], gaps) == (5 * H, 0, 1.0, True, [])


def test_gap_report(spark):
    asked = spark.createDataFrame([("A", "1h", 0, 5 * H), ("B", "1h", 0, 5 * H), ("C", "1h", None, None)], "symbol string, `interval` string, expected_start long, expected_end long")
    report, gaps = gap_report(asked, bars(spark, [2, 3]))
    assert {r["symbol"]: (r["expected"], r["actual"], r["missing"], r["coverage_ratio"]) for r in report.collect()} == {"A": (6, 2, 4, 0.333333), "B": (6, 0, 6, 0.0), "C": (0, 0, 0, 1.0)}
    assert [(g["symbol"], g["gap_start"], g["gap_end"], g["missing"]) for g in gaps.orderBy("symbol", "gap_start").collect()] == [("A", 0, 2 * H - 1, 2), ("A", 4 * H, 6 * H - 1, 2), ("B", 0, 6 * H - 1, 6)]


def test_repair_ranges_and_missing_bars(spark):
    asked = spark.createDataFrame([("A", "1h", 0, 20 * H, None)], "symbol string, `interval` string, `start` long, `end` long, server_time long")
    df = bars(spark, [*range(2, 12), *range(15, 21)])
    gaps = coverage(asked, df)[1]
    assert [(r["download_start"], r["download_end"]) for r in repair_plan(gaps, interior_only=True).collect()] == [(12 * H, 15 * H - 1)]
    assert repair_plan(gaps).count() == 2
    assert sorted(r["open_time"] // H for r in missing_bars(asked, df).collect()) == [0, 1, 12, 13, 14]


BASE = {"symbol": "A", "interval": "1h", "open_time": 0, "close_time": H - 1, "open_price": "100", "high_price": "105", "low_price": "95", "close_price": "102", "volume": "10", "quote_asset_volume": "1000", "number_of_trades": 50, "taker_buy_base_volume": "4", "taker_buy_quote_volume": "400", "position": 0}
SCHEMA = "symbol string, `interval` string, open_time long, close_time long, open_price string, high_price string, low_price string, close_price string, volume string, quote_asset_volume string, number_of_trades long, taker_buy_base_volume string, taker_buy_quote_volume string, position long"


def frame(spark, *changes):
    rows = [BASE | {"position": i, "open_time": i * H, "close_time": (i + 1) * H - 1} | c for i, c in enumerate(changes)]
    return spark.createDataFrame([tuple(r[n.split()[0].strip("`")] for n in SCHEMA.split(", ")) for r in rows], SCHEMA)


@pytest.mark.parametrize(
    "change, rule",
    [
        ({}, None), ({"open_time": -1}, 1), ({"open_time": None}, 1), ({"close_time": 0, "open_time": 0}, 2), ({"open_price": "NaN"}, 5), ({"high_price": None}, 5), ({"close_price": "0"}, 6),
        ({"high_price": "94"}, 7), ({"high_price": "101"}, 8), ({"low_price": "101"}, 9), ({"volume": "Infinity"}, 10), ({"volume": "-1"}, 11), ({"taker_buy_base_volume": "11"}, 12),
        ({"taker_buy_quote_volume": "1001"}, 13), ({"number_of_trades": -1}, 14), ({"number_of_trades": None}, 14), ({"volume": "x", "close_price": "-1"}, 6),
        ({"open_price": "100", "high_price": "100", "low_price": "100", "close_price": "100"}, None),
    ],
)
def test_first_rule_of_a_candle(spark, change, rule):
    assert violations(frame(spark, change)).first()["rule"] == rule


def test_forming_candles(spark):
    assert violations(frame(spark, {}), server_time_ms=H - 1).first()["error"] == "FormingCandleError"
    assert violations(frame(spark, {}), server_time_ms=H).first()["error"] is None
    with pytest.raises(TypeError):
        violations(frame(spark, {}), server_time_ms=True)


def test_sequences(spark):
    found = violations(frame(spark, {}, {"open_time": 0}, {"open_time": 2 * H}, {"open_time": H}, {"open_time": H + 5})).orderBy("position").collect()
    assert [r["rule"] for r in found] == [None, 15, None, 16, 17]
    first = first_violations(frame(spark, {}, {"open_time": 0, "volume": "-1"})).first()
    assert (first["position"], first["rule"]) == (1, 11)
    for change, error in ({"open_time": 0}, E.DuplicateTimestampError), ({"volume": "-1"}, E.CorruptedCandleValueError), ({"high_price": "1"}, E.CorruptedCandleError):
        with pytest.raises(error):
            validate(frame(spark, {}, change))
    assert validate(frame(spark, {}, {})).count() == 2
    with pytest.raises(E.EmptySequenceError):
        validate(frame(spark, {}).limit(0))
    with pytest.raises(E.InvalidIntervalError):
        validate(frame(spark, {"interval": "1H"}))


def test_universe_changes(spark):
    columns = "symbol string, base_asset string, quote_asset string, status string, is_spot_trading_allowed boolean, is_margin_trading_allowed boolean, base_asset_precision int, quote_asset_precision int"
    row = lambda s, status="TRADING", spot=True, margin=True, quote="USDT": (s, "X", quote, status, spot, margin, 8, 8)
    old = spark.createDataFrame([row("SAME"), row("MARGIN"), row("BREAK"), row("SPOT"), row("GONE"), row("LONG", "DELISTED", False), row("OTHER", quote="BTC")], columns)
    new = spark.createDataFrame([row("same "), row("MARGIN", margin=False), row("BREAK", "BREAK"), row("SPOT", spot=False), row("NEW"), row("NEWBTC", quote="BTC")], columns)
    found = {r["symbol"]: (r["change"], r["is_event"]) for r in universe_diff(old, new, " usdt").collect()}
    assert found == {"SAME": ("unchanged", False), "MARGIN": ("unchanged", False), "BREAK": ("transition", True), "SPOT": ("transition", True), "NEW": ("new", True), "GONE": ("delisted", True)}
    gone = universe_diff(old, new).filter(F.col("symbol") == "GONE").first()
    assert (gone["status"], gone["is_spot_trading_allowed"], gone["is_margin_trading_allowed"]) == ("DELISTED", False, True)
