"""Aggregate expressions. All of them are Column expressions, none is a UDF."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MS_PER_MINUTE = 60000.0

Metric = Callable[[Column], Column]

# Named metrics for ``aggregate_table``. Standard deviations of this family use
# the population form. There is no median here: it would hold a group's values in one
# task; see operators.quantiles.
METRICS: dict[str, Metric] = {
    "mean_bpm": F.avg,
    "sd_bpm": F.stddev_pop,
    "min_bpm": F.min,
    "max_bpm": F.max,
    "count_": F.count,
    "mean_resting_bpm": F.avg,
    "sd_resting_bpm": F.stddev_pop,
    "min_resting_bpm": F.min,
    "max_resting_bpm": F.max,
}

BPM_METRICS = ("mean_bpm", "sd_bpm", "min_bpm", "max_bpm", "count_")


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def beat_interval(bpm: Column) -> Column:
    """Milliseconds between beats at a given rate."""
    return F.lit(MS_PER_MINUTE) / bpm


def rmssd(bpm: Column, prev_bpm: Column) -> Column:
    """Root mean square of successive beat-interval differences."""
    step = F.lit(MS_PER_MINUTE) * (F.lit(1.0) / bpm - F.lit(1.0) / prev_bpm)
    return F.sqrt(F.avg(F.pow(step, F.lit(2.0))))


def poincare_minor(bpm: Column, prev_bpm: Column) -> Column:
    """Distance of a beat pair from the identity line (absolute value)."""
    return F.abs(beat_interval(bpm) - beat_interval(prev_bpm)) / F.sqrt(F.lit(2.0))


def poincare_major(bpm: Column, prev_bpm: Column, avg_rr: Column) -> Column:
    """Distance of a beat pair from the day mean along the identity line."""
    along = beat_interval(prev_bpm) + beat_interval(bpm) - F.lit(2.0) * avg_rr
    return F.abs(along) / F.sqrt(F.lit(2.0))


def exact_variance_pop(n: Column, total: Column, squares: Column) -> Column:
    """Population variance from integer moments without cancellation.

    n * sum(x^2) - sum(x)^2 is taken in decimals wide enough for 18-digit
    sums, so a constant series gives exactly zero.
    """
    wide = lambda c: c.cast("decimal(19,0)")
    spread = wide(n) * wide(squares) - wide(total) * wide(total)
    size = n.cast("double")
    return spread.cast("double") / F.nullif(size * size, F.lit(0.0))


# --- mergeable moments -------------------------------------------------------
#
# A variable ``v`` is carried as its sum ``v_sum`` and centred sum of squares
# ``v_m2`` next to a count column, which several variables may share. Small
# groups merge into larger ones without going back to the readings.


def moments(name: str, value: Column) -> list[Column]:
    """Aggregates that open the moments of a variable."""
    return [F.sum(value).alias(f"{name}_sum"), (F.var_pop(value) * F.count(value)).alias(f"{name}_m2")]


def centre_moments(df: DataFrame, keys: list[str], counts: Mapping[str, str]) -> DataFrame:
    """Recentre moments on the mean of the larger group each row belongs to.

    ``counts`` names each variable's count column. Adds ``v_centre`` and turns
    ``v_m2`` into the row's share of the group's sum of squares; the shares
    then simply add up. The window spans already reduced rows, whose number per
    key is bounded by the caller's keys (hours and bins), never raw readings.
    """
    group = Window.partitionBy(*keys)
    some = lambda c: F.nullif(c, F.lit(0)).cast("double")
    size = {c: some(F.sum(c).over(group)) for c in set(counts.values())}
    df = df.withColumns({f"{v}_centre": F.sum(f"{v}_sum").over(group) / size[c] for v, c in counts.items()})
    gap = lambda v, c: F.col(f"{v}_sum") / some(F.col(c)) - F.col(f"{v}_centre")
    return df.withColumns(
        {f"{v}_m2": F.col(f"{v}_m2") + F.col(c) * gap(v, c) * gap(v, c) for v, c in counts.items()}
    )


def merged_moments(counts: Mapping[str, str]) -> list[Column]:
    """Aggregates over recentred rows; can be applied level by level."""
    out = [F.sum(c).alias(c) for c in sorted(set(counts.values()))]
    for v in counts:
        out.append(F.first(f"{v}_centre", ignorenulls=True).alias(f"{v}_centre"))
        out.append(F.sum(f"{v}_m2").alias(f"{v}_m2"))
    return out


def merged_variance(parts: Column) -> Column:
    """Population variance of a short array of (n, total, m2) structs."""

    def merge(s: Column, x: Column) -> Column:
        n = s["n"] + x["n"]
        step = x["total"] / x["n"] - s["mean"]
        return F.struct(
            n.alias("n"),
            (s["mean"] + step * x["n"] / n).alias("mean"),
            (s["m2"] + x["m2"] + step * step * s["n"] * x["n"] / n).alias("m2"),
        )

    none = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "mean", "m2")])
    return F.aggregate(F.array_sort(parts), none, merge, lambda s: s["m2"] / F.nullif(s["n"], F.lit(0.0)))


def sample_sd(name: str, count: str) -> Column:
    """Sample standard deviation of merged moments; null below two values."""
    n = F.col(count)
    return F.when(n > 1, F.sqrt(F.col(f"{name}_m2") / (n - 1).cast("double")))
