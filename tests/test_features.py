import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.errors import EmptySequenceError, FeatureAssemblyError
from tidemark.functions import columns as C
from tidemark.functions.matrix import FAMILIES, assemble, features, first_valid_violations
from tidemark.functions.recursive import ema, exponential, segment_series, wilder
from tidemark.operators.segments import segmented
from tidemark.spec import FeatureSpec, MomentumSpec, StructureSpec, TechnicalFeaturesSpec, TrendSpec, VolatilitySpec, VolumeSpec, canonical
from tidemark.types import FEATURE_NAMES, FIRST_VALID, WARMUP, WARMUP_BARS

H = 3_600_000
COLUMNS = "symbol string, `interval` string, open_time long, close_time long, open_price double, high_price double, low_price double, close_price double, volume double, quote_asset_volume double, number_of_trades long, taker_buy_base_volume double, taker_buy_quote_volume double"


def candles(spark, closes, times=None, symbol="BTCUSDT", volumes=None, spread=1.0):
    times = times or [i * H for i in range(len(closes))]
    volumes = volumes if volumes is not None else [10.0] * len(closes)
    rows = [(symbol, "1h", t, t + H - 1, float(c), c + spread, c - spread, float(c), float(v), v * c, 5, v * 0.4, v * c * 0.4) for t, c, v in zip(times, closes, volumes, strict=True)]
    return spark.createDataFrame(rows, COLUMNS)


def walk(n, seed=42):
    return (100 + np.cumsum(np.random.default_rng(seed).normal(0, 1, n))).clip(10).tolist()


def rows(df, *names):
    return [tuple(r[n] for n in names) if len(names) > 1 else r[names[0]] for r in df.orderBy("symbol", "open_time").collect()]


def test_exponential_average():
    assert exponential([10, 11, 12, 13, 14, 15], 5) == [None] * 4 + [12.0, 13.0]
    assert exponential([1.0], 5) == [None]
    assert wilder([9, 1, 2, 3], 2) == [None, None, 1.5, 2.25]


def test_true_range_and_atr_leave_out_the_first_bar():
    high, low, close = [105, 110, 108], [95, 100, 92], [100, 102, 95]
    assert segment_series(close, high, low)["atr14"] == [None] * 3
    n = 20
    high, low, close = [100.0 + i % 3 for i in range(n)], [98.0] * n, [99.0] * n
    tr = [high[0] - low[0]] + [max(high[i] - low[i], abs(high[i] - close[i - 1]), abs(low[i] - close[i - 1])) for i in range(1, n)]
    assert segment_series(close, high, low)["atr14"][14] == pytest.approx(np.mean(tr[1:15]))


def test_rsi_of_one_direction(spark):
    for closes, value in ((range(100, 120), 100.0), (range(120, 100, -1), 0.0), ([100] * 25, 50.0)):
        found = rows(features(candles(spark, list(closes)), ("rsi14",)), "rsi14")
        assert found == [None] * 14 + [pytest.approx(value)] * (len(closes) - 14)


def test_macd_relations(spark):
    found = rows(features(candles(spark, np.linspace(100, 200, 50).tolist()), FAMILIES["momentum"]), "macd_line", "macd_signal", "macd_hist")
    assert [x[0] is not None for x in found] == [i >= 25 for i in range(50)]
    assert [x[1] is not None for x in found] == [i >= 33 for i in range(50)]
    assert all(x[2] == pytest.approx(x[0] - x[1]) for x in found[33:])
    assert found[33][1] == pytest.approx(np.mean([x[0] for x in found[25:34]]))


def test_bollinger_against_numpy_and_flat(spark):
    closes = walk(60)
    found = rows(features(candles(spark, closes), FAMILIES["volatility"]), "bb_upper", "bb_mid", "bb_lower", "bb_pct_b", "bb_bandwidth")
    for i in range(19, 60):
        part = np.array(closes[i - 19 : i + 1])
        mid, sd = part.mean(), part.std()
        assert found[i] == pytest.approx((mid + 2 * sd, mid, mid - 2 * sd, (closes[i] - mid + 2 * sd) / (4 * sd), 4 * sd / mid), rel=1e-7)
    flat = rows(features(candles(spark, [100] * 25), FAMILIES["volatility"]), "bb_pct_b", "bb_bandwidth")
    assert flat == [(None, None)] * 19 + [(0.5, 0.0)] * 6


def test_volume_guards(spark):
    df = spark.createDataFrame([(10.0, None, 6.0), (20.0, 10.0, 0.0), (0.0, 0.0, 0.0), (10.0, 5.0, 20.0), (-1.0, 5.0, 1.0)], "v double, sma double, tb double")
    found = df.select(C.relative_volume(F.col("v"), F.col("sma")).alias("r"), C.taker_buy_share(F.col("tb"), F.col("v")).alias("s")).collect()
    assert [tuple(r) for r in found] == [(None, 0.6), (2.0, 0.0), (1.0, 0.5), (2.0, 1.0), (-0.2, None)]


def test_every_feature_starts_where_it_must(spark):
    matrix = features(candles(spark, walk(650))).cache()
    assert first_valid_violations(matrix).count() == 0
    assert matrix.filter("is_warm").count() == 650 - WARMUP_BARS
    assert matrix.columns[4:34] == list(FEATURE_NAMES)


def test_segments_are_isolated_and_flagged(spark):
    closes = walk(100)
    times = [i * H for i in range(50)] + [(i + 3) * H for i in range(50, 100)]
    both = features(candles(spark, closes, times)).orderBy("open_time").collect()
    assert [r["open_time"] // H for r in both if r["is_gap_boundary"]] == [53]
    alone = features(candles(spark, closes[50:], times[50:])).orderBy("open_time").collect()
    assert [[r[n] for n in FEATURE_NAMES] for r in both[50:]] == [[r[n] for n in FEATURE_NAMES] for r in alone]
    off_grid = segmented(candles(spark, [1, 2, 3], [0, H + 1, 2 * H + 1]))
    assert rows(off_grid, "segment_id", "bar_index") == [(0, 0), (1, 0), (1, 1)]


def test_later_candles_change_nothing(spark):
    closes = walk(260)
    short = features(candles(spark, closes[:230])).orderBy("open_time").collect()
    long = features(candles(spark, closes)).orderBy("open_time").collect()
    assert [[r[n] for n in FEATURE_NAMES] for r in short] == [[r[n] for n in FEATURE_NAMES] for r in long[:230]]


def test_series_are_independent_and_order_of_rows_is_not_used(spark):
    a, b = candles(spark, walk(80)), candles(spark, walk(80, 7), symbol="ETHUSDT")
    mixed = features(a.unionByName(b).orderBy(F.rand(3)), FAMILIES["trend"])
    assert rows(mixed.filter("symbol = 'ETHUSDT'"), "ema20") == rows(features(b, FAMILIES["trend"]), "ema20")


def test_one_shuffle(spark):
    plan = features(candles(spark, walk(5)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_short_series_have_the_taker_share_only(spark):
    found = features(candles(spark, [100.0, 101.0])).collect()
    assert {n for r in found for n in FEATURE_NAMES if r[n] is not None} == {"taker_buy_share"}


def test_matrix_access(spark):
    with pytest.raises(EmptySequenceError):
        assemble(candles(spark, []))
    with pytest.raises(FeatureAssemblyError):
        features(candles(spark, [1.0]), ("ema21",))
    matrix = assemble(candles(spark, walk(30)))
    assert matrix.shape == (30, 32) and matrix.state_features == {}
    assert matrix.column("ema20").columns == ["symbol", "interval", "open_time", "ema20"]
    with pytest.raises(KeyError):
        matrix.column("x")
    arrays = matrix.arrays("BTCUSDT", "1h")
    assert len(arrays) == 32 and np.isnan(arrays["ema20"][:19]).all() and np.isfinite(arrays["ema20"][19:]).all() and arrays["open_time"].dtype == np.int64
    meta = matrix.metadata().first()
    assert (meta["start_time"], meta["end_time"], meta["segments"]) == (0, 29 * H, 1)


def test_average_of_any_column(spark):
    found = ema(segmented(candles(spark, [1, 2, 3, 4])), "volume", 2)
    assert rows(found, "ema2") == [None, 10.0, 10.0, 10.0]


def test_fixed_tables():
    assert len(FEATURE_NAMES) == 30 and WARMUP_BARS == 603
    assert FIRST_VALID["slope_ema200"] == 202 and WARMUP["macd_signal"] == 105
    assert sum(map(len, FAMILIES.values())) == 30


def test_specs():
    assert TechnicalFeaturesSpec().spec_hash == "416c39ebc98a9194214d04c4a4c30bcb5f49ea4e15dad1c3f66cc796cf65544d"
    assert TechnicalFeaturesSpec(trend=TrendSpec(slope_k=4)).spec_hash != TechnicalFeaturesSpec().spec_hash
    assert FeatureSpec("a", params={"x": 1, "y": 2}).spec_hash == FeatureSpec(" a ", params={"y": 2, "x": 1}).spec_hash
    assert StructureSpec().to_feature_spec().params["window_size"] == 5
    assert VolumeSpec(neutral_taker_share=1).to_feature_spec().params["neutral_taker_share"] == 1.0
    for wrong in (lambda: TrendSpec(slope_k=True), lambda: MomentumSpec(macd_fast=26), lambda: VolatilitySpec(ddof=2), lambda: VolumeSpec(rvol_period=0), lambda: FeatureSpec(" "), lambda: canonical(float("nan"))):
        with pytest.raises(ValueError):
            wrong()
    with pytest.raises(TypeError):
        StructureSpec(pivot_k=True)
