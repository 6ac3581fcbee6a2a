"""Gaps, coverage and repair plans of candle series on a fixed grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.segments import SERIES, interval_ms_column

GAP_TYPES = ("leading", "interior", "trailing", "full_range")


def aligned(t: Column, ms: Column) -> Column:
    """A time floored to the grid."""
    return t - F.pmod(t, ms)


def expected_count(start: Column, end: Column, ms: Column) -> Column:
    """Bars of the grid from start to end, both included."""
    return F.when((end >= start) & (ms > 0), F.floor((end - start) / ms) + 1).otherwise(0).cast("long")


def ratio(actual: Column, expected: Column) -> Column:
    """Share of bars that are there; 1 where none is expected."""
    return F.when(expected > 0, F.bround(actual / expected, 6)).otherwise(1.0)


def _steps(bars: DataFrame) -> DataFrame:
    """Distinct bars of each series, each with the bar before it."""
    return bars.select(*SERIES, "open_time").distinct().withColumn("last", F.lag("open_time", 1).over(Window.partitionBy(*SERIES).orderBy("open_time")))


def gap_report(series: DataFrame, candles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Continuity of the candles given, per row of series (symbol, interval, expected_start, expected_end, NULL for no bound).

    Returns reports (expected, actual, missing, ratio) and gaps. A gap ends at the last millisecond that is missing.
    Bounds add gaps at the ends; they don't filter candles. Without candles and bounds nothing is expected.
    """
    ms = interval_ms_column(F.col("interval"))
    steps = _steps(candles)
    ends = steps.groupBy(*SERIES).agg(F.min("open_time").alias("first"), F.max("open_time").alias("final"), F.count("*").alias("actual"))
    found = series.join(ends, SERIES, "left").withColumn("ms", ms).fillna(0, ["actual"])
    first, after = F.col("first"), F.col("final") + F.col("ms")
    lead = F.floor((first - F.col("expected_start")) / F.col("ms"))
    trail = F.floor((F.col("expected_end") - after) / F.col("ms")) + 1
    span = expected_count(F.col("expected_start"), F.col("expected_end"), F.col("ms"))
    gap = lambda start, n: F.struct(start.alias("gap_start"), (start + n * F.col("ms") - 1).alias("gap_end"), n.cast("long").alias("missing"))
    edges = F.array(
        F.when(lead > 0, gap(F.col("expected_start"), lead)),
        F.when(F.col("expected_end") >= after, gap(after, trail)),
        F.when((F.col("actual") == 0) & (span > 0), gap(F.col("expected_start"), span)),
    )
    outer = found.select(*SERIES, F.explode(F.filter(edges, lambda g: g.isNotNull())).alias("g")).select(*SERIES, "g.*")
    between = steps.withColumn("ms", ms).filter(F.col("open_time") - F.col("last") > F.col("ms")).select(
        *SERIES, (F.col("last") + F.col("ms")).alias("gap_start"), (F.floor((F.col("open_time") - F.col("last")) / F.col("ms")) - 1).cast("long").alias("missing"), "ms",
    ).filter("missing > 0")
    inner = between.select(*SERIES, "gap_start", (F.col("gap_start") + F.col("missing") * F.col("ms") - 1).alias("gap_end"), "missing")
    gaps = outer.unionByName(inner.join(series.select(*SERIES), SERIES, "left_semi"))
    lost = gaps.groupBy(*SERIES).agg(F.sum("missing").alias("missing"))
    report = found.select(*SERIES, "actual").join(lost, SERIES, "left").fillna(0, ["missing"])
    expected = F.col("actual") + F.col("missing")
    return report.select(*SERIES, expected.alias("expected"), "actual", "missing", ratio(F.col("actual"), expected).alias("coverage_ratio")), gaps


def coverage(requests: DataFrame, candles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Coverage of requested ranges (symbol, interval, start, end, server_time or NULL), one job for all of them.

    Both ends are floored to the grid, and the end is clamped to the last bar that is closed at the server's time.
    Returns reports and typed gaps, whose ends are open times of missing bars, both included. A range that holds no
    bar is complete.
    """
    ms = interval_ms_column(F.col("interval"))
    asked = requests.select(*SERIES, "start", "end", ms.alias("ms"), aligned(F.col("start"), ms).alias("aligned_start"),
        F.least(aligned(F.col("end"), ms), aligned(F.col("server_time"), ms) - ms).alias("aligned_end"))
    asked = asked.withColumn("request", F.struct(*SERIES, "start", "end", "aligned_start", "aligned_end", "ms"))
    inside = asked.join(candles.select(*SERIES, "open_time").distinct(), SERIES).filter(F.col("open_time").between(F.col("aligned_start"), F.col("aligned_end")))
    steps = inside.withColumn("last", F.lag("open_time", 1).over(Window.partitionBy("request").orderBy("open_time")))
    ends = steps.groupBy("request").agg(F.min("open_time").alias("first"), F.max("open_time").alias("final"), F.count("*").alias("actual"))
    found = asked.join(ends, "request", "left").fillna(0, ["actual"])
    size = F.col("ms")
    gap = lambda kind, start, end: F.struct(F.lit(kind).alias("gap_type"), start.alias("gap_start"), end.alias("gap_end"), (F.floor((end - start) / size) + 1).cast("long").alias("missing"))
    edges = F.array(
        F.when(F.col("first") > F.col("aligned_start"), gap("leading", F.col("aligned_start"), F.col("first") - size)),
        F.when(F.col("final") + size <= F.col("aligned_end"), gap("trailing", F.col("final") + size, F.col("aligned_end"))),
        F.when((F.col("actual") == 0) & (F.col("aligned_end") >= F.col("aligned_start")), gap("full_range", F.col("aligned_start"), F.col("aligned_end"))),
    )
    outer = found.select("request", F.explode(F.filter(edges, lambda g: g.isNotNull())).alias("g"))
    inner = steps.filter(F.col("open_time") - F.col("last") > size).select("request", gap("interior", F.col("last") + size, F.col("open_time") - size).alias("g"))
    gaps = outer.unionByName(inner).filter("g.missing > 0").select("request", "g.*")
    lost = gaps.groupBy("request").agg(F.sum("missing").alias("missing"))
    report = found.join(lost, "request", "left").fillna(0, ["missing"])
    empty = F.col("aligned_end") < F.col("aligned_start")
    expected = expected_count(F.col("aligned_start"), F.col("aligned_end"), size)
    report = report.select(
        *SERIES, "start", "end", "aligned_start", "aligned_end", expected.alias("expected"), "actual", "missing", ratio(F.col("actual"), expected).alias("coverage_ratio"),
        (empty | ((F.col("missing") == 0) & (F.col("actual") == expected))).alias("is_complete"),
    )
    return report, gaps.select("request.symbol", "request.interval", "request.start", "request.end", "gap_type", "gap_start", "gap_end", "missing")


def missing_bars(requests: DataFrame, candles: DataFrame) -> DataFrame:
    """Every bar of the grid from start to end that no candle has: (symbol, interval, open_time)."""
    ms = interval_ms_column(F.col("interval"))
    grid = requests.select(*SERIES, F.explode(F.sequence(aligned(F.col("start"), ms), aligned(F.col("end"), ms), ms)).alias("open_time"))
    return grid.join(candles.select(*SERIES, "open_time"), [*SERIES, "open_time"], "left_anti")


def repair_plan(gaps: DataFrame, interior_only: bool = False) -> DataFrame:
    """A download range for every gap: from its first open time to the last millisecond of its last bar."""
    if interior_only:
        gaps = gaps.filter(F.col("gap_type") == "interior")
    return gaps.select(*SERIES, "gap_type", "gap_start", "gap_end", "missing", F.col("gap_start").alias("download_start"), (F.col("gap_end") + interval_ms_column(F.col("interval")) - 1).alias("download_end"))
