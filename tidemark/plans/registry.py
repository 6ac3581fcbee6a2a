"""Queries over the driver's tables and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions.matrix import features
from tidemark.operators.continuity import coverage, gap_report, missing_bars, repair_plan
from tidemark.operators.segments import numeric, segmented
from tidemark.operators.store import latest_rows, merged, orphans
from tidemark.operators.universe import universe_diff
from tidemark.operators.validation import violations
from tidemark.sources.decode import KLINE_FIELDS, decode_exchange_info, decode_klines, decode_tickers
from tidemark.plans.adapters import EVENT_MS, candles, nearest, opened, price, table
from tidemark.types import FEATURE_NAMES, INTERVAL_MS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Digits of doubles in results: sums of the same numbers in another order differ beyond.
DIGITS = 6


def query(sql: str | None) -> Callable:
    """Registers a function under its name, with its SQL."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def bars(spark: SparkSession, sf_dir: str, interval: str = "1h", by_type: bool = True) -> DataFrame:
    return candles(table(spark, sf_dir, "events"), interval, by_type)


def round_double(x: Column) -> Column:
    """A double with DIGITS digits as the SQL's round makes it: its product with a power of ten, halves away from zero.

    Spark's round takes the shortest decimal text of the double: 323 / 640 ends in a half there, and is below it here.
    """
    power = F.lit(10.0**DIGITS)
    size = F.abs(x * power)
    found = F.signum(x) * nearest(size) / power
    return F.when(size == float("inf"), x).otherwise(found)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: round_double(F.col(n)) for n in names})


# -- SQL pieces ------------------------------------------------------------------------------------------------------


def candles_sql(interval: str = "1h", by_type: bool = True, name: str = "bars") -> str:
    """A common table expression of the candles."""
    ms = INTERVAL_MS[interval]
    symbol = "event_type" if by_type else "'ALL'"
    return f"""{name} AS (
    SELECT symbol, '{interval}' AS "interval", open_time,
        arg_min(p, (t, event_id)) AS open_price, max(p) AS high_price, min(p) AS low_price, arg_max(p, (t, event_id)) AS close_price,
        sum(q) AS volume, sum(p * q) AS quote_asset_volume, count(*) AS number_of_trades,
        sum(CASE WHEN taker THEN q ELSE 0 END) AS taker_buy_base_volume, sum(CASE WHEN taker THEN p * q ELSE 0 END) AS taker_buy_quote_volume,
        open_time + {ms} - 1 AS close_time
    FROM (SELECT {symbol} AS symbol, epoch_ms(ts) AS t, epoch_ms(ts) - epoch_ms(ts) % {ms} AS open_time, event_id,
            CAST(value AS DECIMAL(18, 2)) AS p, CAST(user_id % 10 + 1 AS DECIMAL(18, 0)) AS q, event_id % 2 = 0 AS taker
        FROM events WHERE value > 0)
    GROUP BY symbol, open_time)"""


def segments_sql(interval: str = "1h", by_type: bool = True) -> str:
    """Candles, and seg: with doubles, segment_id, idx, and the window w."""
    ms = INTERVAL_MS[interval]
    return f"""{candles_sql(interval, by_type)},
brk AS (SELECT *, CASE WHEN open_time - lag(open_time) OVER (PARTITION BY symbol ORDER BY open_time) > {ms} THEN 1 ELSE 0 END AS b FROM bars),
num AS (SELECT symbol, "interval", open_time, close_time, CAST(open_price AS DOUBLE) AS o, CAST(high_price AS DOUBLE) AS h, CAST(low_price AS DOUBLE) AS l,
    CAST(close_price AS DOUBLE) AS c, CAST(volume AS DOUBLE) AS v, CAST(taker_buy_base_volume AS DOUBLE) AS tb,
    CAST(sum(b) OVER (PARTITION BY symbol ORDER BY open_time ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment_id FROM brk),
seg AS (SELECT *, CAST(row_number() OVER (PARTITION BY symbol, segment_id ORDER BY open_time) - 1 AS INTEGER) AS idx FROM num)"""


_W = "WINDOW w AS (PARTITION BY symbol, segment_id ORDER BY open_time)"


def recursive_sql(interval: str, by_type: bool) -> str:
    """seg with the recursive quantities, as rec: one row after the other."""
    seeds = ", ".join(f"avg(c) OVER (PARTITION BY symbol, segment_id ORDER BY open_time ROWS {n - 1} PRECEDING) AS s{n}" for n in (12, 20, 26, 50, 200))
    alpha = {n: f"(2::DOUBLE / {n + 1}::DOUBLE)" for n in (12, 20, 26, 50, 200)}
    ema = lambda n: f"CASE WHEN s.idx = {n - 1} THEN s.s{n} WHEN s.idx > {n - 1} THEN {alpha[n]} * s.c + (1::DOUBLE - {alpha[n]}) * r.ema{n} END"
    start = ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in ("ema12", "ema20", "ema26", "ema50", "ema200", "macd_sum", "macd_signal", "avg_gain", "avg_loss", "atr14"))
    line = f"(({ema(12)}) - ({ema(26)}))"
    wild = lambda seed, last, x: f"CASE WHEN s.idx = 14 THEN s.{seed} WHEN s.idx > 14 THEN (r.{last} * 13 + s.{x}) / 14 END"
    return f"""RECURSIVE {segments_sql(interval, by_type)},
moves AS (SELECT *, greatest(c - lag(c) OVER w, 0) AS gain, greatest(lag(c) OVER w - c, 0) AS loss,
    greatest(h - l, abs(h - lag(c) OVER w), abs(l - lag(c) OVER w)) AS tr FROM seg {_W}),
seeded AS (SELECT *, {seeds},
    avg(gain) OVER (PARTITION BY symbol, segment_id ORDER BY open_time ROWS 13 PRECEDING) AS sg,
    avg(loss) OVER (PARTITION BY symbol, segment_id ORDER BY open_time ROWS 13 PRECEDING) AS sl,
    avg(tr) OVER (PARTITION BY symbol, segment_id ORDER BY open_time ROWS 13 PRECEDING) AS st FROM moves),
r AS (
    SELECT symbol, segment_id, idx, {start} FROM seeded WHERE idx = 0
    UNION ALL
    SELECT s.symbol, s.segment_id, s.idx, {ema(12)}, {ema(20)}, {ema(26)}, {ema(50)}, {ema(200)},
        CASE WHEN s.idx BETWEEN 25 AND 33 THEN coalesce(r.macd_sum, 0) + {line} END,
        CASE WHEN s.idx = 33 THEN (r.macd_sum + {line}) / 9 WHEN s.idx > 33 THEN 0.2::DOUBLE * {line} + 0.8::DOUBLE * r.macd_signal END,
        {wild("sg", "avg_gain", "gain")}, {wild("sl", "avg_loss", "loss")}, {wild("st", "atr14", "tr")}
    FROM r JOIN seeded s ON s.symbol = r.symbol AND s.segment_id = r.segment_id AND s.idx = r.idx + 1),
rec AS (SELECT s.*, r.* EXCLUDE (symbol, segment_id, idx) FROM seg s JOIN r ON s.symbol = r.symbol AND s.segment_id = r.segment_id AND s.idx = r.idx)"""


_LAST = lambda n: f"rows BETWEEN {n - 1} PRECEDING AND CURRENT ROW"
_S20 = f"OVER (PARTITION BY symbol, segment_id ORDER BY open_time {_LAST(20)})"


def _full(x: str) -> str:
    return f"CASE WHEN idx >= 19 THEN {x} END"


_MID, _SIGMA, _VOL = _full(f"avg(c) {_S20}"), _full(f"stddev_pop(c) {_S20}"), _full(f"avg(v) {_S20}")
_UP, _LO = f"(({_MID}) + 2.0 * ({_SIGMA}))", f"(({_MID}) - 2.0 * ({_SIGMA}))"
_LINE, _HIST = "(ema12 - ema26)", "(ema12 - ema26 - macd_signal)"
FEATURE_SQL = {
    **{f"ema{n}": f"ema{n}" for n in (20, 50, 200)},
    **{f"ratio_close_ema{n}": f"CASE WHEN ema{n} > 0 THEN c / ema{n} END" for n in (20, 50, 200)},
    **{f"spread_ema{a}_{b}": f"CASE WHEN ema{b} > 0 THEN (ema{a} - ema{b}) / ema{b} END" for a, b in ((20, 50), (50, 200), (20, 200))},
    **{f"slope_ema{n}": f"CASE WHEN lag(ema{n}, 3) OVER w > 0 THEN (ema{n} - lag(ema{n}, 3) OVER w) / (3 * lag(ema{n}, 3) OVER w) END" for n in (20, 50, 200)},
    "rsi14": "CASE WHEN avg_gain = 0 AND avg_loss = 0 THEN 50 WHEN avg_loss = 0 THEN 100 ELSE 100 * avg_gain / (avg_gain + avg_loss) END",
    "macd_line": _LINE,
    "macd_signal": "macd_signal",
    "macd_hist": _HIST,
    "macd_norm": f"CASE WHEN c > 0 THEN {_LINE} / c * 100 END",
    "macd_hist_norm": f"CASE WHEN c > 0 THEN {_HIST} / c * 100 END",
    **{f"roc{n}": f"CASE WHEN lag(c, {n}) OVER w > 0 THEN (c - lag(c, {n}) OVER w) / lag(c, {n}) OVER w * 100 END" for n in (10, 21)},
    "atr14": "atr14",
    "natr14": "CASE WHEN c > 0 THEN atr14 / c * 100 END",
    "bb_upper": _UP,
    "bb_mid": _MID,
    "bb_lower": _LO,
    "bb_pct_b": f"CASE WHEN {_SIGMA} <= 1e-12 THEN 0.5 WHEN {_SIGMA} > 1e-12 THEN (c - {_LO}) / ({_UP} - {_LO}) END",
    "bb_bandwidth": f"CASE WHEN {_SIGMA} <= 1e-12 OR {_MID} <= 0 THEN 0.0 WHEN {_MID} > 0 THEN ({_UP} - {_LO}) / ({_MID}) END",
    "vol_sma20": _VOL,
    "rvol20": f"CASE WHEN {_VOL} = 0 THEN 1.0 ELSE v / ({_VOL}) END",
    "taker_buy_share": "CASE WHEN v = 0 THEN 0.5 WHEN v > 0 THEN greatest(0, least(1, tb / v)) END",
}


def features_sql(names: tuple[str, ...], interval: str, by_type: bool, recursive: bool = True) -> str:
    source, cte = ("rec", recursive_sql(interval, by_type)) if recursive else ("seg", segments_sql(interval, by_type))
    picked = ", ".join(f"round(CAST({FEATURE_SQL[n]} AS DOUBLE), {DIGITS}) AS {n}" for n in names)
    return f"WITH {cte}\nSELECT symbol, open_time, segment_id, {picked} FROM {source} {_W}"


# -- candles and segments --------------------------------------------------------------------------------------------

_BAR = ["symbol", "interval", "open_time", "open_price", "high_price", "low_price", "close_price", "volume", "quote_asset_volume", "number_of_trades", "taker_buy_base_volume", "taker_buy_quote_volume", "close_time"]
_BAR_DOUBLES = [*_BAR[3:9], *_BAR[10:12]]


def _plain(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(c).cast("double").alias(c) if c in _BAR_DOUBLES else F.col(c) for c in _BAR))


_BAR_SQL = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in _BAR_DOUBLES else f'"{c}"' for c in _BAR)


@query(f"WITH {candles_sql()} SELECT {_BAR_SQL} FROM bars")
def candles_1h(spark, sf_dir):
    return _plain(bars(spark, sf_dir))


@query(f"WITH {candles_sql('5m', False)} SELECT {_BAR_SQL} FROM bars")
def candles_5m(spark, sf_dir):
    return _plain(bars(spark, sf_dir, "5m", False))


@query(f"""WITH {segments_sql()} SELECT symbol, open_time, segment_id, idx AS bar_index,
    segment_id > 0 AND idx = 0 AS is_gap_boundary, idx >= 603 AS is_warm FROM seg""")
def segments_1h_by_type(spark, sf_dir):
    return segmented(bars(spark, sf_dir)).select("symbol", "open_time", "segment_id", "bar_index", "is_gap_boundary", "is_warm")


# -- features --------------------------------------------------------------------------------------------------------


def _window_features(spark: SparkSession, sf_dir: str, found: dict) -> DataFrame:
    df = segmented(numeric(bars(spark, sf_dir)))
    return rounded(df.select("symbol", "open_time", "segment_id", *(x.alias(n) for n, x in found.items())), *found)


@query(f"""WITH {segments_sql()} SELECT symbol, open_time, segment_id,
    round(greatest(h - l, abs(h - lag(c) OVER w), abs(l - lag(c) OVER w)), 6) AS true_range,
    round(greatest(c - lag(c) OVER w, 0), 6) * CASE WHEN idx = 0 THEN NULL ELSE 1 END AS gain,
    round(greatest(lag(c) OVER w - c, 0), 6) * CASE WHEN idx = 0 THEN NULL ELSE 1 END AS loss FROM seg {_W}""")
def true_range(spark, sf_dir):
    w = C.segment_window()
    gain, loss = C.gain_loss(F.col("close"), w)
    return _window_features(spark, sf_dir, {"true_range": C.true_range(F.col("high"), F.col("low"), F.col("close"), w), "gain": gain, "loss": loss})


@query(features_sql(("roc10", "roc21"), "1h", True, False))
def roc(spark, sf_dir):
    w = C.segment_window()
    return _window_features(spark, sf_dir, {f"roc{n}": C.roc(F.col("close"), w, n) for n in (10, 21)})


@query(features_sql(("bb_upper", "bb_mid", "bb_lower", "bb_pct_b", "bb_bandwidth"), "1h", True, False))
def bollinger20(spark, sf_dir):
    return _window_features(spark, sf_dir, {f"bb_{n}": x for n, x in C.bollinger(F.col("close"), C.segment_window()).items()})


@query(features_sql(("vol_sma20", "rvol20", "taker_buy_share"), "1h", True, False))
def volume_features(spark, sf_dir):
    average = C.moving_average(F.col("volume"), C.segment_window())
    return _window_features(spark, sf_dir, {"vol_sma20": average, "rvol20": C.relative_volume(F.col("volume"), average), "taker_buy_share": C.taker_buy_share(F.col("taker_base"), F.col("volume"))})


def _features_query(name: str, names: tuple[str, ...], interval: str, by_type: bool) -> None:
    def run(spark, sf_dir):
        found = features(bars(spark, sf_dir, interval, by_type), names)
        return rounded(found.select("symbol", "open_time", "segment_id", *names), *names)

    run.__name__ = name
    query(features_sql(names, interval, by_type))(run)


_features_query("ema_features", FEATURE_NAMES[:3], "1h", False)
_features_query("trend_features", FEATURE_NAMES[:12], "1h", False)
_features_query("macd_family", ("macd_line", "macd_signal", "macd_hist", "macd_norm", "macd_hist_norm"), "1h", True)
_features_query("rsi_atr", ("rsi14", "atr14", "natr14"), "1h", True)
_features_query("momentum_features", FEATURE_NAMES[12:20], "1h", False)
_features_query("volatility_features", FEATURE_NAMES[20:27], "1h", False)
_features_query("feature_matrix", FEATURE_NAMES, "1h", False)
_features_query("feature_matrix_by_type", FEATURE_NAMES, "1h", True)


# -- lookups ---------------------------------------------------------------------------------------------------------

_RANGE = "SELECT min(open_time) + 86400000 AS lo, max(open_time) - 86400000 AS hi FROM bars"


def _range(df: DataFrame) -> tuple[int, int]:
    lo, hi = df.agg(F.min("open_time"), F.max("open_time")).first()
    return lo + 86_400_000, hi - 86_400_000


@query(f"WITH {candles_sql()}, x AS ({_RANGE}) SELECT {_BAR_SQL} FROM bars, x WHERE symbol = 'click' AND open_time >= lo AND open_time < hi")
def kline_range(spark, sf_dir):
    df = bars(spark, sf_dir)
    lo, hi = _range(df)
    return _plain(df.filter((F.col("symbol") == "click") & (F.col("open_time") >= lo) & (F.col("open_time") < hi)).orderBy("open_time"))


@query(f"WITH {candles_sql()}, x AS ({_RANGE}) SELECT symbol, open_time FROM bars, x WHERE open_time BETWEEN lo AND hi")
def open_times(spark, sf_dir):
    df = bars(spark, sf_dir)
    return df.filter(F.col("open_time").between(*_range(df))).select("symbol", "open_time")


@query(f"WITH {candles_sql()} SELECT {_BAR_SQL} FROM bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) <= 10")
def kline_latest_n(spark, sf_dir):
    return _plain(latest_rows(bars(spark, sf_dir), ["symbol", "interval"], "open_time", 10))


@query(f"WITH {candles_sql()}, x AS ({_RANGE}) SELECT {_BAR_SQL} FROM bars, x WHERE open_time BETWEEN lo AND hi QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) = 1")
def latest_in_range(spark, sf_dir):
    df = bars(spark, sf_dir)
    rest = [c for c in df.columns if c not in ("symbol", "interval")]
    last = df.filter(F.col("open_time").between(*_range(df))).groupBy("symbol", "interval").agg(F.max_by(F.struct(*rest), "open_time").alias("r"))
    return _plain(last.select("symbol", "interval", "r.*"))


@query("SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 100")
def status_events_top_n(spark, sf_dir):
    return table(spark, sf_dir, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(100).select("event_id", "user_id", "event_type")


# -- continuity ------------------------------------------------------------------------------------------------------

_REQ = """req AS (SELECT symbol, "interval", min(open_time) - 7200000 AS lo, max(open_time) + 7200000 AS hi FROM bars GROUP BY ALL)"""
_STEP = "step AS (SELECT symbol, open_time, lag(open_time) OVER (PARTITION BY symbol ORDER BY open_time) AS last FROM bars)"
_ENDS = "ends AS (SELECT symbol, min(open_time) AS first, max(open_time) AS final, count(*) AS actual FROM bars GROUP BY symbol)"


def _requests(df: DataFrame, lo: str, hi: str) -> DataFrame:
    return df.groupBy("symbol", "interval").agg((F.min("open_time") - 7_200_000).alias(lo), (F.max("open_time") + 7_200_000).alias(hi))


_GAPS1 = f"""WITH {candles_sql()}, {_REQ}, {_STEP}, {_ENDS},
gaps AS (
    SELECT symbol, lo AS gap_start, first - 1 AS gap_end, (first - lo) // 3600000 AS missing FROM req JOIN ends USING (symbol)
    UNION ALL SELECT symbol, last + 3600000, open_time - 1, (open_time - last) // 3600000 - 1 FROM step WHERE open_time - last > 3600000
    UNION ALL SELECT symbol, final + 3600000, final + 3600000 + ((hi - final - 3600000) // 3600000 + 1) * 3600000 - 1, (hi - final - 3600000) // 3600000 + 1 FROM req JOIN ends USING (symbol))"""


@query(f"""{_GAPS1} SELECT e.symbol, CAST(actual + m AS BIGINT) AS expected, actual, CAST(m AS BIGINT) AS missing
FROM ends e JOIN (SELECT symbol, sum(missing) AS m FROM gaps GROUP BY symbol) g USING (symbol)""")
def gap_report_1h(spark, sf_dir):
    df = bars(spark, sf_dir)
    return gap_report(_requests(df, "expected_start", "expected_end"), df)[0].select("symbol", "expected", "actual", "missing")


@query(f"{_GAPS1} SELECT symbol, gap_start, gap_end, missing FROM gaps")
def gap_list_1h(spark, sf_dir):
    df = bars(spark, sf_dir)
    return gap_report(_requests(df, "expected_start", "expected_end"), df)[1].select("symbol", "gap_start", "gap_end", "missing")


_COV = f"""WITH {candles_sql()}, {_REQ}, {_STEP}, {_ENDS},
cov AS (SELECT r.symbol, r.lo, r.hi, least(hi, final - 3600000) AS top FROM req r JOIN ends USING (symbol)),
own AS (SELECT c.symbol, c.lo, c.top, b.open_time, lag(b.open_time) OVER (PARTITION BY c.symbol ORDER BY b.open_time) AS last
    FROM cov c JOIN bars b ON b.symbol = c.symbol AND b.open_time BETWEEN c.lo AND c.top),
edge AS (SELECT symbol, lo, top, min(open_time) AS first, max(open_time) AS final, count(*) AS actual FROM own GROUP BY ALL),
gaps AS (
    SELECT symbol, 'leading' AS gap_type, lo AS gap_start, first - 3600000 AS gap_end FROM edge WHERE first > lo
    UNION ALL SELECT symbol, 'interior', last + 3600000, open_time - 3600000 FROM own WHERE open_time - last > 3600000
    UNION ALL SELECT symbol, 'trailing', final + 3600000, top FROM edge WHERE final + 3600000 <= top)"""


def _covered(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    df = bars(spark, sf_dir)
    closed = df.groupBy("symbol", "interval").agg(F.max("open_time").alias("server_time"))
    return coverage(_requests(df, "start", "end").join(closed, ["symbol", "interval"]), df)


@query(f"""{_COV} SELECT e.symbol, lo AS aligned_start, top AS aligned_end, (top - lo) // 3600000 + 1 AS expected, actual, CAST(m AS BIGINT) AS missing,
    m = 0 AND actual = (top - lo) // 3600000 + 1 AS is_complete
FROM edge e JOIN (SELECT symbol, sum((gap_end - gap_start) // 3600000 + 1) AS m FROM gaps GROUP BY symbol) USING (symbol)""")
def coverage_report(spark, sf_dir):
    return _covered(spark, sf_dir)[0].select("symbol", "aligned_start", "aligned_end", "expected", "actual", "missing", "is_complete")


@query(f"""{_COV} SELECT e.symbol, round(CAST(actual AS DOUBLE) / ((top - lo) // 3600000 + 1), 4) AS coverage_ratio FROM edge e""")
def coverage_ratio(spark, sf_dir):
    return _covered(spark, sf_dir)[0].select("symbol", F.round(F.col("coverage_ratio").cast("double"), 4).alias("coverage_ratio"))


@query(f"{_COV} SELECT symbol, gap_type, gap_start, gap_end, (gap_end - gap_start) // 3600000 + 1 AS missing FROM gaps")
def coverage_gaps(spark, sf_dir):
    return _covered(spark, sf_dir)[1].select("symbol", "gap_type", "gap_start", "gap_end", "missing")


@query(f"{_COV} SELECT symbol, gap_type, gap_start AS download_start, gap_end + 3600000 - 1 AS download_end FROM gaps")
def repair_ranges(spark, sf_dir):
    return repair_plan(_covered(spark, sf_dir)[1]).select("symbol", "gap_type", "download_start", "download_end")


@query(f"{_COV} SELECT symbol, gap_start AS download_start, gap_end + 3600000 - 1 AS download_end FROM gaps WHERE gap_type = 'interior'")
def repair_ranges_interior(spark, sf_dir):
    return repair_plan(_covered(spark, sf_dir)[1], interior_only=True).select("symbol", "download_start", "download_end")


@query(f"""WITH {candles_sql()}, {_REQ}, grid AS (SELECT symbol, unnest(generate_series(lo, hi, 3600000)) AS open_time FROM req)
SELECT g.symbol, g.open_time FROM grid g ANTI JOIN bars b ON g.symbol = b.symbol AND g.open_time = b.open_time""")
def missing_bars_1h(spark, sf_dir):
    df = bars(spark, sf_dir)
    return missing_bars(_requests(df, "start", "end"), df).select("symbol", "open_time")


# -- universe, validation, storage -----------------------------------------------------------------------------------


def _symbols(customer: DataFrame, later: bool) -> DataFrame:
    """Two snapshots of made-up instruments: some are gone in the later one, some new, some changed."""
    key = F.col("c_custkey")
    there = key % 7 != 3 if later else key % 11 != 5
    trading = (key % 13 != 4) if later else (key % 5 != 2)
    return customer.filter(there).select(
        F.concat(F.lit("S"), key.cast("string")).alias("symbol"), F.col("c_mktsegment").alias("base_asset"), F.when(key % 3 == 0, "BTC").otherwise("USDT").alias("quote_asset"),
        F.when(trading, "TRADING").when(key % 2 == 0, "DELISTED").otherwise("BREAK").alias("status"), (key % 4 != 1).alias("is_spot_trading_allowed"), (key % 2 == 0).alias("is_margin_trading_allowed"),
        F.lit(8).alias("base_asset_precision"), F.lit(8).alias("quote_asset_precision"),
    )


def _symbols_sql(there: str, trading: str) -> str:
    return f"""SELECT 'S' || c_custkey AS symbol, CASE WHEN c_custkey % 3 = 0 THEN 'BTC' ELSE 'USDT' END AS quote_asset,
    CASE WHEN {trading} THEN 'TRADING' WHEN c_custkey % 2 = 0 THEN 'DELISTED' ELSE 'BREAK' END AS status, c_custkey % 4 <> 1 AS spot FROM customer WHERE {there}"""


@query(f"""WITH a AS ({_symbols_sql("c_custkey % 11 <> 5", "c_custkey % 5 <> 2")}), b AS (SELECT * FROM ({_symbols_sql("c_custkey % 7 <> 3", "c_custkey % 13 <> 4")}) WHERE quote_asset = 'USDT'),
d AS (SELECT coalesce(a.symbol, b.symbol) AS symbol,
    CASE WHEN b.symbol IS NOT NULL THEN CASE WHEN a.symbol IS NULL THEN 'new' WHEN a.status <> b.status OR a.spot <> b.spot THEN 'transition' ELSE 'unchanged' END
         WHEN a.quote_asset = 'USDT' AND a.status <> 'DELISTED' THEN 'delisted' END AS change,
    coalesce(b.status, 'DELISTED') AS status, CASE WHEN b.symbol IS NULL THEN FALSE ELSE b.spot END AS is_spot_trading_allowed FROM a FULL JOIN b ON a.symbol = b.symbol)
SELECT symbol, change, status, is_spot_trading_allowed, change <> 'unchanged' AS is_event FROM d WHERE change IS NOT NULL""")
def universe_changes(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return universe_diff(_symbols(customer, False), _symbols(customer, True)).select("symbol", "change", "status", "is_spot_trading_allowed", "is_event")


def _corrupted(df: DataFrame) -> DataFrame:
    """Candles with every kind of fault, by hour of the epoch."""
    hour = F.floor(F.col("open_time") / 3_600_000)
    return df.withColumns({
        "close_time": F.when(hour % 17 == 1, F.col("open_time")).otherwise(F.col("close_time")),
        "close_price": F.when(hour % 17 == 2, F.lit(0)).when(hour % 17 == 3, F.col("high_price") + 1).otherwise(F.col("close_price")),
        "low_price": F.when(hour % 17 == 4, F.col("high_price") + 1).when(hour % 17 == 5, F.col("high_price")).otherwise(F.col("low_price")),
        "volume": F.when(hour % 17 == 6, F.lit(-1)).when(hour % 17 == 7, F.col("taker_buy_base_volume") - 1).otherwise(F.col("volume")),
        "quote_asset_volume": F.when(hour % 17 == 8, F.col("taker_buy_quote_volume") - F.lit("0.5").cast("decimal(2,1)")).otherwise(F.col("quote_asset_volume")),
        "number_of_trades": F.when(hour % 17 == 9, -1).when(hour % 17 == 10, None).otherwise(F.col("number_of_trades")),
    })


@query(f"""WITH {candles_sql()}, c AS (SELECT *, (open_time // 3600000) % 17 AS m FROM bars),
x AS (SELECT symbol, open_time, CASE WHEN m = 1 THEN open_time ELSE close_time END AS close_time, open_price AS o, high_price AS h,
    CASE WHEN m = 4 THEN high_price + 1 WHEN m = 5 THEN high_price ELSE low_price END AS l, CASE WHEN m = 2 THEN 0 WHEN m = 3 THEN high_price + 1 ELSE close_price END AS c,
    CASE WHEN m = 6 THEN -1 WHEN m = 7 THEN taker_buy_base_volume - 1 ELSE volume END AS v, CASE WHEN m = 8 THEN taker_buy_quote_volume - 0.5 ELSE quote_asset_volume END AS qv,
    taker_buy_base_volume AS tb, taker_buy_quote_volume AS tq, CASE WHEN m = 9 THEN -1 WHEN m = 10 THEN NULL ELSE number_of_trades END AS n FROM c),
top AS (SELECT max(close_time) AS server FROM bars),
r AS (SELECT symbol, open_time, CASE WHEN close_time <= open_time THEN 2 WHEN close_time >= server THEN 4 WHEN least(o, h, l, c) <= 0 THEN 6 WHEN h < l THEN 7 WHEN h < o OR h < c THEN 8
    WHEN l > o OR l > c THEN 9 WHEN least(v, qv, tb, tq) < 0 THEN 11 WHEN tb > v THEN 12 WHEN tq > qv THEN 13 WHEN n IS NULL OR n < 0 THEN 14 END AS rule FROM x, top)
SELECT symbol, open_time, CAST(rule AS INTEGER) AS rule FROM r WHERE rule IS NOT NULL""")
def candle_violations(spark, sf_dir):
    df = bars(spark, sf_dir)
    server = df.agg(F.max("close_time")).first()[0]
    return violations(_corrupted(df), server, position=None).filter("rule IS NOT NULL").select("symbol", "open_time", "rule")


def _batches(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Stored hourly candles of all events, and a batch that repeats a part with other volumes, twice."""
    old = bars(spark, sf_dir)
    again = old.filter(F.col("open_time") / 3_600_000 % 10 == 0)
    batch = again.withColumns({"volume": F.col("volume") + 1, "batch_pos": F.lit(0)}).unionByName(again.withColumns({"volume": F.col("volume") + 2, "batch_pos": F.lit(1)}))
    return old, batch


@query(f"""WITH {candles_sql()} SELECT symbol, open_time, CAST(volume + CASE WHEN (open_time // 3600000) % 10 = 0 THEN 2 ELSE 0 END AS DOUBLE) AS volume FROM bars""")
def upsert_latest(spark, sf_dir):
    old, batch = _batches(spark, sf_dir)
    return merged(old, batch, ["symbol", "interval", "open_time"], "batch_pos").select("symbol", "open_time", F.col("volume").cast("double").alias("volume"))


# -- decoders and sequence rules ---------------------------------------------------------------------------------------


@query(f"WITH {candles_sql()} SELECT {_BAR_SQL}, CAST(row_number() OVER (PARTITION BY symbol, open_time // 86400000 ORDER BY open_time) - 1 AS INTEGER) AS position FROM bars")
def decoded_klines(spark, sf_dir):
    """Pages of a day of candles each, as an exchange sends them, decoded again."""
    values = [F.col(name).cast("string") for name in KLINE_FIELDS]
    day = F.expr("open_time div 86400000")
    page = F.transform(F.array_sort(F.collect_list(F.struct("open_time", F.array(*values).alias("k")))), lambda x: x["k"])
    pages = bars(spark, sf_dir).groupBy("symbol", "interval", day.alias("day")).agg(F.to_json(page).alias("response_json"))
    found = decode_klines(pages)
    return found.select(*(F.col(c).cast("double").alias(c) if c in _BAR_DOUBLES else F.col(c) for c in _BAR), F.col("position").cast("int").alias("position"))


@query("""SELECT upper('c' || c_custkey) AS symbol, c_mktsegment AS base_asset, 'USDT' AS quote_asset, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'TRADING' END AS status,
    c_custkey % 2 = 0 AS is_spot_trading_allowed, CAST(CASE WHEN c_custkey % 3 = 0 THEN 8 ELSE c_custkey % 9 END AS INTEGER) AS base_asset_precision,
    CAST(c_custkey // 100 AS BIGINT) AS server_time FROM customer""")
def decoded_exchange_info(spark, sf_dir):
    """Exchange metadata of a hundred instruments a response; left-out fields take their defaults, names come in any case."""
    key = F.col("c_custkey")
    entry = F.struct(
        F.concat(F.lit(" c"), key.cast("string")).alias("symbol"), F.when(key % 5 != 0, "TRADING").alias("status"), F.col("c_mktsegment").alias("baseAsset"), F.lit("USDT").alias("quoteAsset"),
        F.when(key % 3 != 0, key % 9).cast("int").alias("baseAssetPrecision"), F.when(key % 2 == 0, True).alias("isSpotTradingAllowed"),
    )
    groups = table(spark, sf_dir, "customer").groupBy(F.floor(key / 100).alias("serverTime")).agg(F.collect_list(entry).alias("symbols"))
    found = decode_exchange_info(groups.select(F.to_json(F.struct("serverTime", "symbols")).alias("response_json")))
    return found.select("symbol", "base_asset", "quote_asset", "status", "is_spot_trading_allowed", "base_asset_precision", "server_time")


@query("SELECT CAST(event_id AS BIGINT) AS event_id, upper(event_type) AS symbol, CAST(CAST(value AS DECIMAL(18, 2)) AS DOUBLE) AS price FROM events WHERE event_id % 7 <> 0")
def decoded_tickers(spark, sf_dir):
    """Tickers, one by one or in a list; those without a number are no tickers."""
    text = F.when(F.col("event_id") % 7 == 0, "none").otherwise(price(F.col("value")).cast("string"))
    one = F.to_json(F.struct(F.concat(F.lit(" "), F.col("event_type")).alias("symbol"), text.alias("price")))
    payload = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("["), one, F.lit("]"))).otherwise(one)
    found = decode_tickers(table(spark, sf_dir, "events").select(F.col("event_id").cast("long").alias("event_id"), payload.alias("response_json")))
    return found.select("event_id", "symbol", F.col("price").cast("double").alias("price"))


def _shuffled(df: DataFrame) -> DataFrame:
    """Candles in an order with repeats, steps back and, at every seventh bar, an open time ten minutes late."""
    at = F.floor(F.col("open_time") / 3_600_000)
    late = F.when(at % 7 == 3, F.col("open_time") + 600_000).otherwise(F.col("open_time"))
    position = F.when(at % 11 == 5, F.col("open_time") - 5_400_000).otherwise(F.col("open_time"))
    rows = df.withColumns({"position": position, "open_time": late})
    return rows.unionByName(rows.filter(at % 13 == 1).withColumn("position", F.col("position") + 1))


@query(f"""WITH {candles_sql()}, a AS (SELECT symbol, open_time // 3600000 AS hr, open_time AS raw FROM bars),
r AS (SELECT symbol, hr, CASE WHEN hr % 7 = 3 THEN raw + 600000 ELSE raw END AS open_time, CASE WHEN hr % 11 = 5 THEN raw - 5400000 ELSE raw END AS position FROM a),
x AS (SELECT symbol, open_time, position FROM r UNION ALL SELECT symbol, open_time, position + 1 FROM r WHERE hr % 13 = 1),
d AS (SELECT *, open_time - lag(open_time) OVER (PARTITION BY symbol ORDER BY position) AS step FROM x)
SELECT symbol, open_time, position, CAST(CASE WHEN step = 0 THEN 15 WHEN step < 0 THEN 16 WHEN step < 3600000 THEN 17 END AS INTEGER) AS rule FROM d WHERE step < 3600000""")
def sequence_violations(spark, sf_dir):
    found = violations(_shuffled(bars(spark, sf_dir)), None, "position").filter("rule >= 15")
    return found.select("symbol", "open_time", F.col("position").cast("long").alias("position"), F.col("rule").cast("int").alias("rule"))


@query("SELECT event_id, sha256(props) AS content_hash FROM events WHERE props IS NOT NULL")
def raw_archive_hash(spark, sf_dir):
    return table(spark, sf_dir, "events").filter("props IS NOT NULL").select("event_id", F.sha2("props", 256).alias("content_hash"))


@query("SELECT o_orderkey FROM orders ANTI JOIN (SELECT * FROM customer WHERE c_custkey % 9 <> 0) c ON o_custkey = c_custkey")
def orphan_children(spark, sf_dir):
    parents = table(spark, sf_dir, "customer").filter("c_custkey % 9 <> 0")
    return orphans(table(spark, sf_dir, "orders"), "o_custkey", parents, "c_custkey").select("o_orderkey")


@query(f"""WITH {candles_sql()} SELECT e.event_id, b.open_time AS bar, b.number_of_trades FROM events e JOIN bars b ON b.symbol = e.event_type AND b.open_time = epoch_ms(e.ts) - epoch_ms(e.ts) % 3600000""")
def lineage(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("symbol"), F.expr(EVENT_MS).alias("t")).withColumn("open_time", opened(F.col("t"), 3_600_000))
    return events.join(bars(spark, sf_dir), ["symbol", "open_time"]).select("event_id", F.col("open_time").alias("bar"), "number_of_trades")
