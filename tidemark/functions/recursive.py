"""Features that depend on their own last value, by one grouped-map function over segments.

Spark has no recursive window, and a closed form overflows after a few thousand bars. A segment is a task's unit of
work here, as in the definition; it is read in time order, once, by plain loops over floats. Everything that needs no
recursion stays in columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import SEGMENT

Series = list[float | None]


def smooth(x: Sequence[float], first: int, period: int, last_weight: Callable[[float, float], float]) -> Series:
    """Values seeded with the mean of x[first : first + period], then carried on by last_weight(last, x)."""
    out: Series = [None] * len(x)
    seed = first + period - 1
    if len(x) <= seed:
        return out
    total = 0.0
    for v in x[first : seed + 1]:
        total += v
    last = total / period
    out[seed] = last
    for i in range(seed + 1, len(x)):
        last = last_weight(last, x[i])
        out[i] = last
    return out


def exponential(x: Sequence[float], period: int, first: int = 0) -> Series:
    """Exponential moving average, seeded with a simple one."""
    a = 2.0 / (period + 1)
    b = 1.0 - a
    return smooth(x, first, period, lambda last, v: a * v + b * last)


def wilder(x: Sequence[float], period: int, first: int = 1) -> Series:
    """Wilder's average: the last value has weight period - 1."""
    return smooth(x, first, period, lambda last, v: (last * (period - 1) + v) / period)


def segment_series(close: Sequence[float], high: Sequence[float], low: Sequence[float]) -> dict[str, Series]:
    """The recursive quantities of one segment."""
    moves = [0.0, *(b - a for a, b in zip(close, close[1:], strict=False))]
    ranges = [h - lo for h, lo in zip(high, low, strict=True)]
    for i in range(1, len(close)):
        ranges[i] = max(ranges[i], abs(high[i] - close[i - 1]), abs(low[i] - close[i - 1]))
    out = {f"ema{n}": exponential(close, n) for n in (12, 20, 26, 50, 200)}
    line = [f - s for f, s in zip(out["ema12"], out["ema26"], strict=True) if s is not None]
    out["macd_signal"] = [None] * (len(close) - len(line)) + exponential(line, 9)
    out["avg_gain"] = wilder([max(m, 0.0) for m in moves], 14)
    out["avg_loss"] = wilder([max(-m, 0.0) for m in moves], 14)
    out["atr14"] = wilder(ranges, 14)
    for n in (20, 50, 200):
        out[f"ema{n}_past"] = ([None] * SLOPE_BARS + out[f"ema{n}"])[: len(close)]
    return out


#: Bars between an average and its past value, which a slope needs.
SLOPE_BARS = 3
_NAMES = ("ema12", "ema20", "ema26", "ema50", "ema200", "macd_signal", "avg_gain", "avg_loss", "atr14", "ema20_past", "ema50_past", "ema200_past")


def with_recursive(segmented: DataFrame) -> DataFrame:
    """Segmented candles (see segments.py) with the recursive quantities.

    The segments' window has dealt the rows by series already; a group of a series and a segment needs no other exchange.
    """
    schema = ", ".join([f"`{n}` {t}" for n, t in segmented.dtypes] + [f"{n} double" for n in _NAMES])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("open_time")
        found = segment_series(*(table[c].to_pylist() for c in ("close", "high", "low")))
        for name in _NAMES:
            table = table.append_column(name, pa.array(found[name], pa.float64()))
        return table

    return segmented.groupBy(*SEGMENT).applyInArrow(run, schema)


def ema(segmented: DataFrame, column: str, period: int, name: str | None = None) -> DataFrame:
    """Segmented rows with the exponential moving average of any column."""
    return _one(segmented, column, name or f"ema{period}", lambda x: exponential(x, period))


def wilder_average(segmented: DataFrame, column: str, period: int, name: str) -> DataFrame:
    """Segmented rows with Wilder's average of any column; the first bar of a segment is left out of the seed."""
    return _one(segmented, column, name, lambda x: wilder(x, period))


def _one(segmented: DataFrame, column: str, name: str, f: Callable[[Sequence[float]], Series]) -> DataFrame:
    schema = ", ".join([f"`{n}` {t}" for n, t in segmented.dtypes] + [f"`{name}` double"])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("open_time")
        return table.append_column(name, pa.array(f(table[column].to_pylist()), pa.float64()))

    return segmented.withColumn(column, F.col(column).cast("double")).groupBy(*SEGMENT).applyInArrow(run, schema)
