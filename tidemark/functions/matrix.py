"""The feature matrix: thirty features of every candle, in canonical order."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import EmptySequenceError, FeatureAssemblyError
from tidemark.functions import columns as C
from tidemark.functions.recursive import SLOPE_BARS, with_recursive
from tidemark.operators.segments import numeric, segmented
from tidemark.spec import TechnicalFeaturesSpec
from tidemark.types import FEATURE_NAMES, FIRST_VALID, WARMUP

FAMILIES = {"trend": FEATURE_NAMES[:12], "momentum": FEATURE_NAMES[12:20], "volatility": FEATURE_NAMES[20:27], "volume": FEATURE_NAMES[27:]}


def window_features() -> dict[str, Column]:
    """Features of a fixed frame, over segmented candles; they need no other shuffle than the segments."""
    w, close, volume = C.segment_window(), F.col("close"), F.col("volume")
    average = C.moving_average(volume, w)
    found = {f"roc{n}": C.roc(close, w, n) for n in (10, 21)} | {f"bb_{name}": x for name, x in C.bollinger(close, w).items()}
    return found | {"vol_sma20": average, "rvol20": C.relative_volume(volume, average), "taker_buy_share": C.taker_buy_share(F.col("taker_base"), volume)}


def recursive_features() -> dict[str, Column]:
    """Features over rows that have the recursive quantities: projections only."""
    close, found = F.col("close"), {}
    for n in (20, 50, 200):
        average = F.col(f"ema{n}")
        found |= {f"ema{n}": average, f"ratio_close_ema{n}": C.ratio(close, average), f"slope_ema{n}": C.slope_from(average, F.col(f"ema{n}_past"), SLOPE_BARS)}
    for fast, slow in ((20, 50), (50, 200), (20, 200)):
        found[f"spread_ema{fast}_{slow}"] = C.spread(F.col(f"ema{fast}"), F.col(f"ema{slow}"))
    line = F.col("ema12") - F.col("ema26")
    histogram = line - F.col("macd_signal")
    found |= {"rsi14": F.when(F.col("avg_gain").isNotNull(), C.rsi(F.col("avg_gain"), F.col("avg_loss"))), "macd_line": line, "macd_signal": F.col("macd_signal"), "macd_hist": histogram}
    found |= {"macd_norm": C.percent_of(line, close), "macd_hist_norm": C.percent_of(histogram, close)}
    return found | {"atr14": F.col("atr14"), "natr14": C.percent_of(F.col("atr14"), close)}


def features(candles: DataFrame, only: tuple[str, ...] = FEATURE_NAMES) -> DataFrame:
    """Features of candles: series, times, the features named, segment and flags. One shuffle, by series.

    Frames come first and then the recursion, as its output has no known partitioning. Without a recursive feature
    there is no Python in the plan.

    Values depend on where the candles given begin, so a range is chosen before, by filtering the candles.
    """
    unknown = set(only) - set(FEATURE_NAMES)
    if unknown:
        raise FeatureAssemblyError(f"unknown features: {', '.join(sorted(unknown))}")
    flags = ["segment_id", "bar_index", "is_gap_boundary", "is_warm"]
    framed, recursive = window_features(), recursive_features()
    rows = segmented(numeric(candles).select("symbol", "interval", "open_time", "close_time", "high", "low", "close", "volume", "taker_base"))
    rows = rows.select("symbol", "interval", "open_time", "close_time", "high", "low", "close", *(framed[n].alias(n) for n in only if n in framed), *flags)
    if any(n in recursive for n in only):
        rows = with_recursive(rows)
    return rows.select("symbol", "interval", "open_time", "close_time", *(recursive.get(n, F.col(n)).alias(n) for n in only), *flags)


@dataclass(frozen=True)
class FeatureMatrix:
    """A matrix and what it was made with; its rows stay in Spark."""

    frame: DataFrame
    spec: TechnicalFeaturesSpec
    state_features: dict[str, DataFrame]

    @property
    def column_names(self) -> tuple[str, ...]:
        return ("open_time", "close_time", *FEATURE_NAMES)

    def column(self, name: str) -> DataFrame:
        """One column with the keys of its rows."""
        if name not in self.column_names:
            raise KeyError(name)
        return self.frame.select("symbol", "interval", *dict.fromkeys(["open_time", name]))

    def count(self) -> int:
        return self.frame.count()

    @property
    def shape(self) -> tuple[int, int]:
        return self.count(), len(self.column_names)

    def arrays(self, symbol: str, interval: str) -> dict[str, np.ndarray]:
        """One series as arrays in time order, NaN where a feature isn't available; it must fit into memory."""
        rows = self.frame.filter((F.col("symbol") == symbol) & (F.col("interval") == interval)).select(*self.column_names).orderBy("open_time").toArrow()
        return {n: rows[n].to_numpy() if n in ("open_time", "close_time") else rows[n].to_pandas().to_numpy(np.float64) for n in self.column_names}

    def metadata(self) -> DataFrame:
        """A row per series: its first and last open time, rows, segments, and the specification."""
        return self.frame.groupBy("symbol", "interval").agg(
            F.min("open_time").alias("start_time"), F.max("open_time").alias("end_time"), F.count("*").alias("rows"), (F.max("segment_id") + 1).alias("segments"),
        ).withColumns({"version": F.lit(self.spec.version), "spec_hash": F.lit(self.spec.spec_hash)})


def assemble(candles: DataFrame, spec: TechnicalFeaturesSpec | None = None) -> FeatureMatrix:
    """The matrix of candles; an empty table has none."""
    if candles.isEmpty():
        raise EmptySequenceError("there are no candles")
    return FeatureMatrix(features(candles), spec or TechnicalFeaturesSpec(), {})


def first_valid_violations(matrix: DataFrame) -> DataFrame:
    """Features that are there before their first valid bar, or missing after it: (feature, rows); empty if all is right."""
    parts = [F.struct(F.lit(n).alias("feature"), (F.col(n).isNotNull() != (F.col("bar_index") >= FIRST_VALID[n])).alias("wrong")) for n in FEATURE_NAMES]
    return matrix.select(F.explode(F.array(*parts)).alias("p")).filter("p.wrong").groupBy("p.feature").agg(F.count("*").alias("rows"))


def warm(name: str) -> Column:
    """Whether a bar is warmed up for one feature."""
    return F.col("bar_index") >= WARMUP[name]
