"""Nested heart-rate features over trailing 1/7/10/14-day periods."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsewright.functions.rundates import RunDates
from pulsewright.functions.stats import BPM_METRICS, exact_variance_pop, merged_variance, moments
from pulsewright.operators.heartbeat import TS
from pulsewright.operators.relational import aggregate_table, flatten, require_rows, valid_bpm
from pulsewright.sinks.files import write_partition
from pulsewright.sources.scans import zone_name
from pulsewright.sources.schemas import PERIODS, ZONE_NAMES

PIM = "pim_id"
Day = str | date | None


def daily_bpm_stats(hr: DataFrame, min_bpm: int = 40) -> DataFrame:
    """Mean, population SD, min, max and count of the readings of each day."""
    readings = valid_bpm(hr, min_bpm=min_bpm).withColumn("date", F.to_date(TS))
    return aggregate_table(readings, "bpm", [PIM, "date"], BPM_METRICS)


def _whole(hr: DataFrame) -> bool:
    """Whether rates are whole numbers; their moments are then exact."""
    return isinstance(hr.schema["bpm"].dataType, T.IntegralType)


def _bpm_days(hr: DataFrame, dedupe: bool) -> DataFrame:
    """Moments per participant and day: of integers exactly, else centred.

    With ``dedupe`` a rate counts once per day, as rows that repeat in participant,
    day and rate are dropped. Whole rates fold into one row with a count in any case.
    """
    kind = "long" if _whole(hr) else "double"
    rows = hr.select(PIM, F.to_date(TS).alias("day"), F.col("bpm").cast(kind).alias("bpm"))
    # Stated here, as a later join would add it to one of two equal scans only.
    rows = rows.filter(F.col("day").isNotNull())
    bpm, once = F.col("bpm"), F.lit(1).cast("long")
    if dedupe or _whole(hr):
        rows = rows.groupBy(PIM, "day", "bpm").agg(F.count(F.lit(1)).alias("times"))
    times = once if dedupe or not _whole(hr) else F.col("times")
    spread = F.sum(times * bpm * bpm).alias("bpm_squares") if _whole(hr) else moments("bpm", bpm)[1]
    return rows.groupBy(PIM, "day").agg(
        F.sum(times).alias("bpm_n"),
        F.sum(times * bpm).alias("bpm_total"),
        spread,
        F.min(bpm).alias("bpm_min"),
        F.max(bpm).alias("bpm_max"),
    )


def _zone_days(zones: DataFrame) -> DataFrame:
    at = lambda zone, c: F.when(F.col("zone") == zone, F.col(c))
    named = zones.select(
        PIM, F.col("heart_rate_date_loc").alias("day"), zone_name(F.col("heart_rate_zone")).alias("zone"), "min_bpm", "max_bpm"
    )
    return named.groupBy(PIM, "day").agg(
        *[F.min(at(z, "min_bpm")).alias(f"min_{z}") for z in ZONE_NAMES],
        *[F.max(at(z, "max_bpm")).alias(f"max_{z}") for z in ZONE_NAMES],
    )


def _days(hr: DataFrame, rest: DataFrame, zones: DataFrame, dedupe: bool) -> DataFrame:
    """One frame of daily rows of all three inputs; absent parts are null."""
    resting = rest.select(
        PIM, F.col("resting_heart_heart_date_loc").alias("day"), F.col("resting_heart_rate").cast("double").alias("resting")
    ).distinct()
    parts = [_bpm_days(hr, dedupe), resting, _zone_days(zones)]
    first, *others = [p.filter(F.col(PIM).isNotNull()) for p in parts]
    for p in others:
        first = first.unionByName(p, allowMissingColumns=True)
    return first


def _period(n: int, whole: bool) -> Column:
    """Struct of one period; all its fields are null without any data in it."""
    inside = F.col("offset") < n
    have = F.count_if(inside) > 0
    at = lambda c: F.when(inside, F.col(c))
    size, total = F.sum(at("bpm_n")), F.sum(at("bpm_total"))
    if whole:
        variance = exact_variance_pop(size, total, F.sum(at("bpm_squares")))
    else:  # at most one struct per day of the period
        part = [F.col(c).cast("double").alias(a) for c, a in (("bpm_n", "n"), ("bpm_total", "total"), ("bpm_m2", "m2"))]
        variance = merged_variance(F.collect_list(F.when(inside & F.col("bpm_n").isNotNull(), F.struct(*part))))
    bpm_day = F.when(inside & F.col("bpm_n").isNotNull(), F.col("day"))
    fields = {
        "mean_bpm": total / F.nullif(size, F.lit(0)),
        "sd_bpm": F.sqrt(variance),
        "min_bpm": F.min(at("bpm_min")),
        "max_bpm": F.max(at("bpm_max")),
        "count_": size,
        "mean_resting_bpm": F.avg(at("resting")),
        "sd_resting_bpm": F.stddev_pop(at("resting")),
        "min_resting_bpm": F.min(at("resting")),
        "max_resting_bpm": F.max(at("resting")),
    }
    for z in ZONE_NAMES:
        fields[f"min_bpm_{z}"] = F.min(at(f"min_{z}"))
        fields[f"max_bpm_{z}"] = F.max(at(f"max_{z}"))
    fields |= {
        "days": F.when(have, F.lit(n)),
        "period_start_date": F.when(have, F.date_sub("ds", n - 1)),
        "period_end_date": F.when(have, F.col("ds")),
        "earliest_bpm_date": F.min(bpm_day),
        "latest_bpm_date": F.max(bpm_day),
    }
    return F.struct(*[c.alias(name) for name, c in fields.items()]).alias(f"period_{n}d")


def _daily_rows(
    hr: DataFrame, rest: DataFrame, zones: DataFrame, runs: RunDates, back: int, dedupe: bool, min_bpm: int
) -> DataFrame:
    """Daily rows of all days that the run dates look at."""
    readings = runs.scan(valid_bpm(hr, min_bpm=min_bpm), TS, back=back).filter(F.col(PIM).isNotNull())
    resting = runs.scan(valid_bpm(rest, "resting_heart_rate", min_bpm), "resting_heart_heart_date_loc", back=back)
    bounds = valid_bpm(valid_bpm(zones, "min_bpm", min_bpm), "max_bpm", min_bpm)
    bounds = runs.scan(bounds, "heart_rate_date_loc", back=back)
    return _days(readings, resting, bounds, dedupe)


def _spine(days: DataFrame, runs: RunDates, back: int) -> tuple[DataFrame, DataFrame]:
    """Daily rows dealt to the run dates they serve, and the run dates with readings on the day."""
    offsets = F.array(*[F.lit(k) for k in range(back + 1)])
    spine = days.withColumn("offset", F.explode(offsets)).withColumn("ds", F.date_add("day", F.col("offset")))
    # Taken from the daily rows, whose shuffle of readings serves both uses.
    with_readings = runs.clip(days.filter(F.col("bpm_n") > 0).select(F.col("day").alias("ds"))).distinct()
    return runs.clip(spine), with_readings


def bpm_days(
    hr: DataFrame,
    rest: DataFrame,
    zones: DataFrame,
    ds: Day = None,
    ds_to: Day = None,
    dedupe: bool = True,
    min_bpm: int = 40,
) -> DataFrame:
    """One row per participant and ``day``, from which features of any period can be merged.

    Counts, sums and sums of squares of the day's rates (of whole rates exactly), resting
    rate and zone bounds. Only readings of the days from ``ds`` to ``ds_to`` are read.
    """
    rows = _daily_rows(hr, rest, zones, RunDates.of(ds, ds_to), 0, dedupe, min_bpm)
    return rows.filter(F.col("day").isNotNull())


def store_bpm_days(
    hr: DataFrame,
    rest: DataFrame,
    zones: DataFrame,
    path: str,
    ds: Day = None,
    ds_to: Day = None,
    dedupe: bool = True,
    min_bpm: int = 40,
) -> None:
    """Write or rewrite the daily rows of the given days below ``path``; other days stay as they are.

    A daily run stores its own day, a late correction the day it concerns. A named day
    without data becomes empty. Without days the whole history is stored.
    """
    runs = RunDates.of(ds, ds_to)
    days = runs if runs.first is not None and runs.last is not None else None
    write_partition(bpm_days(hr, rest, zones, ds, ds_to, dedupe, min_bpm), path, "day", days=days)


def features_of_days(days: DataFrame, ds: Day = None, ds_to: Day = None, periods: Sequence[int] = PERIODS) -> DataFrame:
    """``bpm_features`` from daily rows, stored or not; each run date reads the days of its longest period.

    With ``days`` read from a table partitioned by day, only those partitions are
    listed and no reading is looked at again.
    """
    runs, back = RunDates.of(ds, ds_to), max(periods) - 1
    spine, with_readings = _spine(runs.scan(days, "day", back=back), runs, back)
    features = spine.groupBy("ds", PIM).agg(*[_period(n, "bpm_squares" in days.columns) for n in periods])
    if runs.single is not None:
        require_rows(with_readings, f"No data collected for {runs.single}.")
        return features
    # One row per calendar day, however large the readings: safe to broadcast.
    return features.join(F.broadcast(with_readings), "ds", "left_semi")


def bpm_features(
    hr: DataFrame,
    rest: DataFrame,
    zones: DataFrame,
    ds: Day = None,
    ds_to: Day = None,
    periods: Sequence[int] = PERIODS,
    dedupe: bool = True,
    min_bpm: int = 40,
) -> DataFrame:
    """One row per participant and run date with a struct per period.

    Readings are reduced to daily rows first; a daily row then serves the run
    dates of the following days, so any number of run dates costs one scan of
    the readings. A participant appears on a run date with data of any of the
    three inputs in its longest period.

    A single run date without readings on the day itself raises. In a range,
    such run dates are left out; ``skipped_run_dates`` lists them.
    """
    days = _daily_rows(hr, rest, zones, RunDates.of(ds, ds_to), max(periods) - 1, dedupe, min_bpm)
    return features_of_days(days, ds, ds_to, periods)


def skipped_run_dates(
    hr: DataFrame,
    rest: DataFrame,
    zones: DataFrame,
    ds: Day = None,
    ds_to: Day = None,
    periods: Sequence[int] = PERIODS,
    min_bpm: int = 40,
) -> DataFrame:
    """Run dates ``bpm_features`` leaves out, with the participants that have other data for them.

    They have data in their longest period, but no readings on the day itself.
    """
    runs, back = RunDates.of(ds, ds_to), max(periods) - 1
    spine, with_readings = _spine(_daily_rows(hr, rest, zones, runs, back, True, min_bpm), runs, back)
    left = spine.select("ds", PIM).distinct().join(F.broadcast(with_readings), "ds", "left_anti")
    return left.groupBy("ds").agg(F.count(F.lit(1)).alias("participants"))


def flat_bpm_features(features: DataFrame, keep: Sequence[str] = ("ds", PIM)) -> DataFrame:
    """Period structs as flat columns ``p<days>_<field>`` next to ``keep``."""
    structs = [c for c in features.columns if c.startswith("period_")]
    prefix = {c: "p" + c.removeprefix("period_").removesuffix("d") for c in structs}
    return flatten(features, structs, list(keep), prefix)
