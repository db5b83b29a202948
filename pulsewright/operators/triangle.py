"""Triangular interpolation of the beat-interval histogram.

Bins are 31.25 ms wide and identified by their integer number, so all sums are
exact integers. Sums left and right of the mode are running sums over the
bins; no bin is ever paired with another one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsewright.functions.stats import beat_interval

# Bin width in ms, and in units of 0.1 microseconds.
BIN_MS = 31.25
BIN_TENTH_US = 312500


def interval_bin(bpm: Column) -> Column:
    """Number of the histogram bin of a reading's beat interval.

    The interval is first rounded (half away from zero) to 0.1 microseconds.
    """
    return F.floor(F.round(beat_interval(bpm) * 10000) / F.lit(BIN_TENTH_US))


def bin_start(number: Column) -> Column:
    return number * F.lit(BIN_MS)


def mode_rows(hist: DataFrame, keys: list[str]) -> DataFrame:
    """The most frequent bins of each histogram, all of them on a tie.

    A key has a few dozen bins at most (beat intervals are bounded by the
    lowest valid rate), so its window is small.
    """
    group = Window.partitionBy(*keys)
    return hist.withColumn("_top", F.max("frequency").over(group)).filter(
        F.col("frequency") == F.col("_top")
    ).drop("_top")


def _side_sums(side) -> tuple[Column, Column]:
    """(sum dx*dx, sum dx*dy) of the bins on one side of the current bin."""
    b, f = F.col("bin"), F.col("frequency")
    total = lambda c: F.sum(c).over(side)
    c1, sb, sbb = total(F.lit(1).cast("long")), total(b), total(b * b)
    sf, sbf = total(f), total(b * f)
    dxdx = sbb - 2 * b * sb + b * b * c1
    dxdy = sbf - f * sb - b * sf + b * f * c1
    return dxdx, dxdy


def add_side_sums(hist: DataFrame, keys: list[str]) -> DataFrame:
    """Add the sums left and right of every bin, and the histogram's peak and total.

    A key has a few dozen rows (bins), so these windows stay small.
    """
    group = Window.partitionBy(*keys)
    upto = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    since = group.orderBy("bin").rowsBetween(0, Window.unboundedFollowing)
    left_xx, left_xy = _side_sums(upto)
    right_xx, right_xy = _side_sums(since)
    return hist.select(
        "*",
        left_xx.alias("left_xx"),
        left_xy.alias("left_xy"),
        right_xx.alias("right_xx"),
        right_xy.alias("right_xy"),
        F.max("frequency").over(group).alias("peak"),
        F.sum("frequency").over(group).alias("total"),
    )


SIDES = ("left_xx", "left_xy", "right_xx", "right_xy")


def pooled_sides() -> list[Column]:
    """Aggregates over the bins of a key; tied modes pool their sums."""
    at_mode = F.col("frequency") == F.col("peak")
    return [F.sum(F.when(at_mode, F.col(c))).alias(c) for c in SIDES] + [
        F.max("peak").alias("peak"),
        F.max("total").alias("total"),
        F.count_if(at_mode).alias("modes"),
    ]


def triangle_columns() -> list[Column]:
    """tinn, rrtri and modes; null without a usable line on both sides."""
    usable = F.lit(True)
    for c in SIDES:
        usable = usable & (F.col(c) != 0)
    base = lambda side: F.col("peak") * F.col(f"{side}_xx") * F.lit(BIN_MS) / F.col(f"{side}_xy")
    return [
        F.when(usable, base("left") - base("right")).alias("tinn"),
        F.when(usable, F.col("total") / F.col("peak")).alias("rrtri"),
        F.when(usable, F.col("modes")).alias("modes"),
    ]


def tinn_rrtri(hist: DataFrame, keys: list[str]) -> DataFrame:
    """Baseline width and triangular index of each histogram.

    ``hist`` holds keys, ``bin`` and ``frequency``. Least-squares lines through
    the mode fit the bins left and right of it; their base points span the
    triangle. With tied modes the sums pool all of them and ``modes`` tells
    their number. Keys without a usable line on both sides are left out.
    """
    pooled = add_side_sums(hist, keys).groupBy(*keys).agg(*pooled_sides())
    return pooled.select(*keys, *triangle_columns()).filter(F.col("modes").isNotNull())
