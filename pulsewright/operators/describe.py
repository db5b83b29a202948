"""Descriptive statistics of a column: summary, histogram, box statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewright.operators.quantiles import (
    ALL,
    PRESENT,
    SLOT,
    TIMES,
    VALUE,
    folded_values,
    meet,
    over_group,
    present,
    quantiles_of,
    slot_edge,
    to_slots,
)


def _slot_moments(folded: DataFrame, keys: list[str]) -> DataFrame:
    """Per slot: count, sum, and sum of squares around the slot's own mean.

    Values of a slot lie close to its edge, so differences to it keep their digits.
    """
    off = F.col(VALUE) - slot_edge(F.col(SLOT))
    near = F.sum(F.col(TIMES) * off)
    # Both counts stay in use for all readers of the folded values, which then share a shuffle.
    return folded.filter((F.col(TIMES) > 0) & (F.col(PRESENT) >= 0)).groupBy(*keys, SLOT).agg(
        F.sum(TIMES).alias("rows"),
        F.nullif(F.sum(PRESENT), F.lit(0)).alias("_c"),
        F.sum(F.col(TIMES) * F.col(VALUE)).alias("_total"),
        F.greatest(F.sum(F.col(TIMES) * off * off) - near * near / F.sum(TIMES), F.lit(0.0)).alias("_m2"),
        F.min(VALUE).alias("_min"),
        F.max(VALUE).alias("_max"),
    )


def _summary(folded: DataFrame, keys: list[str]) -> DataFrame:
    slots = over_group(_slot_moments(folded, keys), keys, {"_group_total": (F.sum, "_total"), "_group_c": (F.sum, "_c")})
    mean = F.col("_group_total") / F.col("_group_c")
    gap = F.col("_total") / F.col("_c") - F.col("_mean")
    n, m2 = F.sum("_c"), F.sum("_m2")
    return (
        slots.withColumn("_mean", mean)
        .withColumn("_m2", F.col("_m2") + F.col("_c") * gap * gap)
        .groupBy(*keys)
        .agg(
            F.sum("rows").alias("row_count"),
            (F.sum("rows") - F.coalesce(n, F.lit(0))).alias("null_count"),
            F.max("_mean").alias("mean"),
            F.when((n > 1) & (F.min("_min") == F.max("_max")), F.lit(0.0)).when(n > 1, F.sqrt(m2 / (n - 1))).alias("sd"),
            F.min("_min").alias("min"),
            F.max("_max").alias("max"),
        )
    )


def describe_col(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows, nulls, mean, median, sample SD, min and max, per group if asked.

    Summary and median read one shuffle of the folded values.
    """
    folded, keys = folded_values(df, col, by)
    median = quantiles_of(folded, keys, [0.5], ["median"])
    right = median.withColumnsRenamed({k: f"_r{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_r{k}"))
    return _summary(folded, keys).join(right, on, "left").drop(*[f"_r{k}" for k in keys], ALL)


def histogram(df: DataFrame, col: str, bins: int = 150, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram over [min, max]; the last bin includes its end.

    Every bin is listed, empty ones with zero. A value on an inner edge belongs
    to the bin above it. A single value gets a range of one around it. Values
    take the range from their slot, to which it is joined first.
    """
    folded, keys = folded_values(df, col, by)
    values = present(folded)
    slots = values.groupBy(*keys, SLOT).agg(F.min(VALUE).alias("_min"), F.max(VALUE).alias("_max"))
    slots = over_group(slots, keys, {"_low": (F.min, "_min"), "_high": (F.max, "_max")})
    low, high = F.col("_low"), F.col("_high")
    flat = low == high
    spans = slots.select(
        *keys,
        SLOT,
        F.when(flat, low - 0.5).otherwise(low).alias("_lo"),
        F.when(flat, high + 0.5).otherwise(high).alias("_top"),
    ).select(*keys, SLOT, "_lo", ((F.col("_top") - F.col("_lo")) / F.lit(float(bins))).alias("_step"))
    edge = lambda i: F.col("_lo") + i * F.col("_step")
    guess = F.least(F.floor((F.col(VALUE) - F.col("_lo")) / F.col("_step")), F.lit(bins - 1))
    g = F.col("_guess")
    exact = (
        F.when(F.col(VALUE) < edge(g), g - 1)
        .when((g < bins - 1) & (F.col(VALUE) >= edge(g + 1)), g + 1)
        .otherwise(g)
    )
    counts = (
        meet(values, spans, [*keys, SLOT])
        .withColumn("_guess", guess)
        .groupBy(*keys, "_lo", "_step", exact.alias("bin"))
        .agg(F.sum(TIMES).alias("_c"))
    )
    # One row per group and used bin here; every bin is added from it.
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long")))
    listed = counts.select(*keys, "_lo", "_step").distinct().withColumn("bin", every).withColumn("_c", F.lit(0).cast("long"))
    return (
        counts.unionByName(listed)
        .groupBy(*keys, "_lo", "_step", "bin")
        .agg(F.sum("_c").alias("frequency"))
        .select(
            *[k for k in keys if k != ALL],
            "bin",
            edge(F.col("bin")).alias("bin_start"),
            edge(F.col("bin") + 1).alias("bin_end"),
            "frequency",
        )
    )


def box_stats(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """Quartiles and the outermost values within 1.5 interquartile ranges.

    A whisker ends in the outermost slot that reaches into the range, so values
    are looked at in two slots per group only.
    """
    folded, keys = folded_values(df, col, by)
    values = present(folded)
    quartiles = quantiles_of(folded, keys, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    slots = values.groupBy(*keys, SLOT).agg(F.min(VALUE).alias("_min"), F.max(VALUE).alias("_max"))
    reached = to_slots(slots, quartiles, keys).withColumns({"_from": F.col("q1") - reach, "_to": F.col("q3") + reach}).withColumns(
        {
            "_reaches_up": F.when(F.col("_max") >= F.col("_from"), F.col(SLOT)),
            "_reaches_down": F.when(F.col("_min") <= F.col("_to"), F.col(SLOT)),
        }
    )
    ends = (
        over_group(reached, keys, {"_first": (F.min, "_reaches_up"), "_last": (F.max, "_reaches_down")})
        .filter((F.col(SLOT) == F.col("_first")) | (F.col(SLOT) == F.col("_last")))
        .drop("_min", "_max", "_reaches_up", "_reaches_down")
    )
    v = F.col(VALUE)
    return (
        meet(values, ends, [*keys, SLOT])
        .groupBy(*keys, "q1", "median", "q3")
        .agg(
            F.min(F.when((F.col(SLOT) == F.col("_first")) & (v >= F.col("_from")), v)).alias("_low"),
            F.max(F.when((F.col(SLOT) == F.col("_last")) & (v <= F.col("_to")), v)).alias("_high"),
        )
        .select(
            *[k for k in keys if k != ALL],
            "q1",
            "median",
            "q3",
            F.least("_low", "q1").alias("whisker_low"),
            F.greatest("_high", "q3").alias("whisker_high"),
        )
    )
