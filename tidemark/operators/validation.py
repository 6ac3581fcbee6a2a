"""Rules for candles and sequences, as a column that names the first rule a row breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import errors as E
from tidemark.operators.segments import interval_ms_column
from tidemark.types import INTERVAL_MS, PRICES, VOLUMES, epoch_ms

#: Number and error of each rule; of several broken rules the first counts.
RULES = {
    1: E.InvalidTimestampError,
    2: E.InvalidTimestampError,
    4: E.FormingCandleError,
    5: E.CorruptedCandleValueError,
    6: E.CorruptedCandleValueError,
    7: E.CorruptedCandleError,
    8: E.CorruptedCandleError,
    9: E.CorruptedCandleError,
    10: E.CorruptedCandleValueError,
    11: E.CorruptedCandleValueError,
    12: E.CorruptedCandleValueError,
    13: E.CorruptedCandleValueError,
    14: E.CorruptedCandleValueError,
    15: E.DuplicateTimestampError,
    16: E.UnsortedSequenceError,
    17: E.MalformedIntervalSpacingError,
}


def decimal(x: Column) -> Column:
    """An exact number, or NULL where the text isn't a finite one of 20 whole digits at most."""
    return x.cast("string").try_cast("decimal(38,18)")


def candle_rule(server_time_ms: int | None = None) -> Column:
    """The first rule that a candle breaks on its own, or NULL."""
    if server_time_ms is not None:
        epoch_ms(server_time_ms, "server_time_ms")
    ot, ct = F.col("open_time"), F.col("close_time")
    o, h, lo, c = (decimal(F.col(x)) for x in PRICES)
    v, qv, tb, tq = (decimal(F.col(x)) for x in VOLUMES)
    missing = lambda *xs: F.greatest(*(x.isNull() for x in xs))
    rules = [
        (1, ot.isNull() | (ot < 0)),
        (2, ct.isNull() | (ct <= ot)),
        (4, ct >= F.lit(server_time_ms).cast("long")),
        (5, missing(o, h, lo, c)),
        (6, F.least(o, h, lo, c) <= 0),
        (7, h < lo),
        (8, (h < o) | (h < c)),
        (9, (lo > o) | (lo > c)),
        (10, missing(v, qv, tb, tq)),
        (11, F.least(v, qv, tb, tq) < 0),
        (12, tb > v),
        (13, tq > qv),
        (14, F.col("number_of_trades").isNull() | (F.col("number_of_trades") < 0)),
    ]
    return F.coalesce(*(F.when(broken, F.lit(number)) for number, broken in rules))


def sequence_rule(position: str = "position") -> Column:
    """The first rule that a candle breaks against the one before it in its series, by input position, or NULL."""
    last = F.lag("open_time", 1).over(Window.partitionBy("symbol", "interval").orderBy(position))
    step = F.col("open_time") - last
    return F.when(step == 0, 15).when(step < 0, 16).when(step < interval_ms_column(F.col("interval")), 17)


def violations(candles: DataFrame, server_time_ms: int | None = None, position: str | None = "position") -> DataFrame:
    """Candles with rule (the first rule broken, NULL for none) and error (its name).

    With a position column, the order of the sequence is checked too; a row's own rules come before those.
    """
    found = candle_rule(server_time_ms)
    rule = F.coalesce(found, sequence_rule(position)) if position else found
    names = F.create_map(*(F.lit(x) for number, error in RULES.items() for x in (number, error.__name__)))
    return candles.withColumn("rule", rule).withColumn("error", F.when(F.col("rule").isNotNull(), F.element_at(names, F.col("rule"))))


def first_violations(candles: DataFrame, server_time_ms: int | None = None, position: str = "position") -> DataFrame:
    """For each series that breaks a rule, the first row and rule."""
    found = violations(candles, server_time_ms, position).filter("rule IS NOT NULL")
    first = found.groupBy("symbol", "interval").agg(F.min(F.struct(F.col(position).alias("position"), "rule", "error")).alias("x"))
    return first.select("symbol", "interval", "x.*")


def validate(candles: DataFrame, server_time_ms: int | None = None, position: str = "position") -> DataFrame:
    """The candles, if no rule is broken; raises the error of the first row of the first series that breaks one."""
    if candles.isEmpty():
        raise E.EmptySequenceError("there are no candles")
    strange = candles.filter(~F.col("interval").isin(list(INTERVAL_MS)) | F.col("interval").isNull()).first()
    if strange:
        raise E.InvalidIntervalError(f"unknown interval {strange['interval']!r}")
    found = first_violations(candles, server_time_ms, position).orderBy("symbol", "interval").first()
    if found:
        raise RULES[found["rule"]](f"{found['symbol']} {found['interval']}: row {found['position']} breaks rule {found['rule']}")
    return candles
