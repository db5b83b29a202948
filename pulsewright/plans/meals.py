"""Meal timing, glucose and excursion statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewright.functions.timeops import minute_boundaries, time_range
from pulsewright.operators.describe import box_stats, describe_col, histogram

# Measures of a meal, and the offset that keeps the rate finite.
METRICS = ("start_to_normal", "start_to_peak", "peak_to_end", "peak_glucose", "excursion_size", "excursion_rate")
RATE_OFFSET = 0.01

TIME_RANGE = "time_range"


def meal_metrics(meals: DataFrame) -> DataFrame:
    """Measures of each meal with its time-of-day range."""
    return meals.select(
        "pim_id",
        time_range(F.col("start_datetime_local")).alias(TIME_RANGE),
        F.col("duration").cast("double").alias("start_to_normal"),
        F.col("time_to_peak").cast("double").alias("start_to_peak"),
        minute_boundaries(F.col("return_to_baseline_datetime_local"), F.col("peak_datetime_local"))
        .cast("double")
        .alias("peak_to_end"),
        F.col("peak_glucose").cast("double").alias("peak_glucose"),
        F.col("excursion_size").cast("double").alias("excursion_size"),
        (F.col("excursion_size") / F.nullif(F.col("time_to_peak") + F.lit(RATE_OFFSET), F.lit(0.0))).alias(
            "excursion_rate"
        ),
    )


def meal_means(meals: DataFrame, by_time: bool = False) -> DataFrame:
    """Mean of every measure per participant, or per participant and range."""
    keys = ["pim_id", TIME_RANGE] if by_time else ["pim_id"]
    rows = meal_metrics(meals)
    if by_time:
        rows = rows.filter(F.col(TIME_RANGE).isNotNull())
    return rows.groupBy(*keys).agg(*[F.avg(m).alias(m) for m in METRICS])


def _rows(meals: DataFrame, per: str, by_time: bool) -> DataFrame:
    if per == "event":
        rows = meal_metrics(meals)
    elif per == "participant":
        rows = meal_means(meals, by_time)
    else:
        raise ValueError("per must be 'event' or 'participant'")
    return rows.filter(F.col(TIME_RANGE).isNotNull()) if by_time else rows


def _long(rows: DataFrame, metrics: Sequence[str], by_time: bool) -> tuple[DataFrame, list[str]]:
    """One row per measure and value, so that one plan serves all measures."""
    ids = [TIME_RANGE] if by_time else []
    # Not unpivot: two copies of its plan do not share a shuffle when it has id columns.
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])
    return rows.select(*ids, F.explode(pairs).alias("_m")).select(*ids, "_m.metric", "_m.value"), ["metric", *ids]


def _names(metrics: str | Sequence[str]) -> list[str]:
    return [metrics] if isinstance(metrics, str) else list(metrics)


def meal_stats(
    meals: DataFrame, metrics: str | Sequence[str] = METRICS, per: str = "event", by_time: bool = False
) -> DataFrame:
    """Summary of measures over meals or over participants' means."""
    long, keys = _long(_rows(meals, per, by_time), _names(metrics), by_time)
    return describe_col(long, "value", keys)


def by_time_range(meals: DataFrame, metrics: str | Sequence[str] = METRICS, per: str = "event") -> DataFrame:
    """Mean and median of measures per time-of-day range."""
    long, keys = _long(_rows(meals, per, True), _names(metrics), True)
    return describe_col(long, "value", keys).select(*keys, "mean", "median")


def meal_histogram(
    meals: DataFrame, metrics: str | Sequence[str] = METRICS, bins: int = 150, per: str = "event"
) -> DataFrame:
    """Equal-width histograms of measures."""
    long, keys = _long(_rows(meals, per, False), _names(metrics), False)
    return histogram(long, "value", bins, keys)


def meal_box(meals: DataFrame, metrics: str | Sequence[str] = METRICS, per: str = "event") -> DataFrame:
    """Box statistics of measures per time-of-day range."""
    long, keys = _long(_rows(meals, per, True), _names(metrics), True)
    return box_stats(long, keys, "value")
