"""Features of a fixed frame as columns.

Each function takes the columns it needs and a window over one segment in time order; all windows of a query are the
same specification with different frames, so that they share one sort. A frame that isn't full yet gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

SEGMENT = ["symbol", "interval", "segment_id"]

#: Standard deviation up to which a Bollinger band counts as flat.
FLAT = 1e-12


def segment_window() -> WindowSpec:
    return Window.partitionBy(*SEGMENT).orderBy("open_time")


def _full(value: Column, w: WindowSpec, first: int) -> Column:
    """The value from bar `first` of the segment on."""
    return F.when(F.row_number().over(w) > first, value)


def roc(close: Column, w: WindowSpec, period: int) -> Column:
    """Change over `period` bars in per cent."""
    past = F.lag(close, period).over(w)
    return F.when(past > 0, (close - past) / past * 100)


def slope(average: Column, w: WindowSpec, bars: int = 3) -> Column:
    """Change of an average per bar, over `bars` bars, relative to its past value."""
    return slope_from(average, F.lag(average, bars).over(w), bars)


def slope_from(average: Column, past: Column, bars: int = 3) -> Column:
    return F.when(past > 0, (average - past) / (bars * past))


def ratio(close: Column, average: Column) -> Column:
    return F.when(average > 0, close / average)


def spread(fast: Column, slow: Column) -> Column:
    return F.when(slow > 0, (fast - slow) / slow)


def true_range(high: Column, low: Column, close: Column, w: WindowSpec) -> Column:
    """Largest of the bar's range and its distances from the last close; the first bar has its range."""
    last = F.lag(close, 1).over(w)
    return F.greatest(high - low, F.abs(high - last), F.abs(low - last))


def gain_loss(close: Column, w: WindowSpec) -> tuple[Column, Column]:
    """Rise and fall against the last close; the first bar has neither."""
    change = close - F.lag(close, 1).over(w)
    return F.when(change.isNotNull(), F.greatest(change, F.lit(0.0))), F.when(change.isNotNull(), F.greatest(-change, F.lit(0.0)))


def rsi(gain: Column, loss: Column) -> Column:
    """Relative strength of two averages: 50 where nothing moves."""
    return F.when((gain == 0) & (loss == 0), 50.0).when(loss == 0, 100.0).otherwise(100 * gain / (gain + loss))


def moving_average(x: Column, w: WindowSpec, period: int = 20) -> Column:
    return _full(F.avg(x).over(w.rowsBetween(1 - period, 0)), w, period - 1)


def bollinger(close: Column, w: WindowSpec, period: int = 20, width: float = 2.0, ddof: int = 0) -> dict[str, Column]:
    """Bands around the moving average, the place of the close between them, and their width."""
    if ddof not in (0, 1):
        raise ValueError("ddof is 0 or 1")
    frame = w.rowsBetween(1 - period, 0)
    mid = moving_average(close, w, period)
    deviation = _full((F.stddev_samp if ddof else F.stddev_pop)(close).over(frame), w, period - 1)
    upper, lower = mid + width * deviation, mid - width * deviation
    flat = deviation <= FLAT
    return {
        "upper": upper,
        "mid": mid,
        "lower": lower,
        "pct_b": F.when(flat, 0.5).when(deviation > FLAT, (close - lower) / (upper - lower)),
        "bandwidth": F.when(flat | (mid <= 0), 0.0).when(mid > 0, (upper - lower) / mid),
    }


def relative_volume(volume: Column, average: Column) -> Column:
    """Volume against its average; 1 where the average is 0."""
    return F.when(average == 0, 1.0).when(average.isNotNull(), F.try_divide(volume, average))


def taker_buy_share(taker: Column, volume: Column) -> Column:
    """Share of the takers' purchases, from 0 to 1; one half of no volume."""
    return F.when(volume == 0, 0.5).when(volume > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), taker / volume)))


def percent_of(x: Column, close: Column) -> Column:
    """A quantity in per cent of the close."""
    return F.when(close > 0, x / close * 100)
