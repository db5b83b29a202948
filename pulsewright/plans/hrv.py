"""Heart-rate-variability features per day and per 1/3/6/12/24-hour bucket.

Flow: readings -> (one pass) moments per hour and histogram bin -> everything
else. The moments table has a bounded number of rows per participant and day
(24 hours times a few dozen bins), is placed once by (participant, day), and
yields statistics and histograms of every bucket width without another shuffle
of readings.

``dense`` takes ``operators.heartbeat.dense_cuts`` of the readings, for data that is
crowded into single five-minute slices; results are the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewright.functions.rundates import RunDates
from pulsewright.functions.stats import (
    MS_PER_MINUTE,
    beat_interval,
    centre_moments,
    merged_moments,
    moments,
    nan_to_null,
    poincare_major,
    poincare_minor,
    sample_sd,
)
from pulsewright.functions.timeops import bucket_seconds, from_epoch
from pulsewright.operators.heartbeat import PIM, TS, consecutive_readings, weighted_readings
from pulsewright.operators.relational import union_all
from pulsewright.operators.triangle import (
    add_side_sums,
    interval_bin,
    mode_rows,
    pooled_sides,
    tinn_rrtri,
    triangle_columns,
)

DAY_HOURS = 24
BUCKET = [PIM, "date", "seconds", "start"]

# Variables carried as moments, with the column that counts their values.
PAIR_VARIABLES = ("bpm", "rr", "sd1", "sd2")
COUNTS = {**dict.fromkeys(PAIR_VARIABLES, "n"), "slice": "slices"}

# Statistics of one bucket, in output order.
SHAPE_COLUMNS = (
    "beat_interval_ms_mean",
    "beat_interval_ms_stddev",
    "beat_interval_ms_min",
    "beat_interval_ms_max",
    "beat_interval_ms_rmssd",
    "geom_poincare_sd1",
    "geom_poincare_sd2",
    "tinn",
    "rrtri",
    "sdann",
)
BUCKET_COLUMNS = ("record_count", "bpm_mean", "bpm_stddev", "bpm_min", "bpm_max") + SHAPE_COLUMNS

Day = str | date | None


def interval_moments(readings: DataFrame, grain: int = 3600) -> DataFrame:
    """Moments per (participant, ``grain`` seconds, histogram bin).

    Readings without a predecessor count in the histogram and in the slice's
    mean interval only; all other statistics use pairs. Slices lie inside the
    grain, so their values are averaged and spread here as well.
    """
    bpm, prev = F.col("bpm"), F.col("prev_bpm")
    rr, step = beat_interval(bpm), beat_interval(bpm) - beat_interval(prev)
    paired = lambda c: F.when(prev.isNotNull(), c)
    rows = readings.withColumns({"bin": interval_bin(bpm), "part": bucket_seconds(F.col("slice"), grain)})
    return (
        rows.groupBy(PIM, "date", "part", "bin")
        .agg(
            F.count(F.lit(1)).alias("frequency"),
            F.count(prev).alias("n"),
            F.min(paired(bpm)).alias("bpm_min"),
            F.max(paired(bpm)).alias("bpm_max"),
            F.sum(step * step).alias("step_squares"),
            *moments("bpm", paired(bpm).cast("double")),
            *moments("rr", paired(rr)),
            *moments("sd1", poincare_minor(bpm, prev)),
            *moments("sd2", poincare_major(bpm, prev, F.col("avg_rr"))),
            F.count("slice_interval").alias("slices"),
            *moments("slice", F.col("slice_interval")),
            *[F.sum(f"slice_{s}").alias(f"{s}_sum") for s in ("rmssd", "sdrr")],
            *[F.count(f"slice_{s}").alias(f"{s}_count") for s in ("rmssd", "sdrr")],
        )
        .repartition(PIM, "date")
    )


def _at_widths(rows: DataFrame, seconds: Sequence[int], at: str) -> DataFrame:
    """Repeat already reduced rows once per bucket width."""
    widths = F.array(*[F.lit(s) for s in seconds])
    return rows.withColumn("seconds", F.explode(widths)).withColumn(
        "start", bucket_seconds(F.col(at), F.col("seconds"))
    )


ADDED = ("step_squares", "rmssd_sum", "rmssd_count", "sdrr_sum", "sdrr_count")


def _bucket_features(base: DataFrame, seconds: Sequence[int]) -> DataFrame:
    """One row per bucket: BUCKET, BUCKET_COLUMNS, ``modes``, five-minute means.

    The moments table is already placed by (participant, day), which covers
    every key used here: buckets and their bins. So nothing below shuffles
    again.
    """
    carried = [
        F.min("bpm_min").alias("bpm_min"),
        F.max("bpm_max").alias("bpm_max"),
        *[F.sum(c).alias(c) for c in ADDED],
        *merged_moments(COUNTS),
    ]
    bins = (
        centre_moments(_at_widths(base, seconds, "part"), BUCKET, COUNTS)
        .groupBy(*BUCKET, "bin")
        .agg(F.sum("frequency").alias("frequency"), *carried)
    )
    buckets = add_side_sums(bins, BUCKET).groupBy(*BUCKET).agg(*pooled_sides(), *carried)
    ms, n = F.lit(MS_PER_MINUTE), F.col("n")
    return buckets.filter(n > 0).select(
        *BUCKET,
        n.alias("record_count"),
        F.col("bpm_centre").alias("bpm_mean"),
        sample_sd("bpm", "n").alias("bpm_stddev"),
        "bpm_min",
        "bpm_max",
        F.col("rr_centre").alias("beat_interval_ms_mean"),
        sample_sd("rr", "n").alias("beat_interval_ms_stddev"),
        (ms / F.col("bpm_max")).alias("beat_interval_ms_min"),
        (ms / F.col("bpm_min")).alias("beat_interval_ms_max"),
        F.sqrt(F.col("step_squares") / n).alias("beat_interval_ms_rmssd"),
        sample_sd("sd1", "n").alias("geom_poincare_sd1"),
        sample_sd("sd2", "n").alias("geom_poincare_sd2"),
        *triangle_columns(),
        sample_sd("slice", "slices").alias("sdann"),
        *[
            (F.col(f"{s}_sum") / F.nullif(F.col(f"{s}_count"), F.lit(0))).alias(f"mean_{s}")
            for s in ("rmssd", "sdrr")
        ],
    )


def _seconds(hours: Sequence[int]) -> list[int]:
    return [h * 3600 for h in hours]


def nn_histogram(hr: DataFrame, hours: Sequence[int], min_bpm: int = 40, dense: DataFrame | None = None) -> DataFrame:
    """Beat-interval histogram per bucket: bin number and frequency.

    Hourly counts come first; wider buckets add those up.
    """
    hourly = (
        consecutive_readings(hr, min_bpm, dense)
        .withColumn("hour", bucket_seconds(F.col("slice"), 3600))
        .groupBy(PIM, "date", "hour", interval_bin(F.col("bpm")).alias("bin"))
        .agg(F.count(F.lit(1)).alias("frequency"))
    )
    return (
        _at_widths(hourly, _seconds(hours), "hour")
        .groupBy(*BUCKET, "bin")
        .agg(F.sum("frequency").alias("frequency"))
    )


def nn_modes(hr: DataFrame, hours: Sequence[int], min_bpm: int = 40, dense: DataFrame | None = None) -> DataFrame:
    """Most frequent bins of each bucket's histogram, ties kept."""
    return mode_rows(nn_histogram(hr, hours, min_bpm, dense), BUCKET)


def tinn_features(hr: DataFrame, hours: Sequence[int], min_bpm: int = 40, dense: DataFrame | None = None) -> DataFrame:
    """tinn, rrtri and the number of tied modes per bucket."""
    return tinn_rrtri(nn_histogram(hr, hours, min_bpm, dense), BUCKET)


def sdann(hr: DataFrame, hours: Sequence[int], min_bpm: int = 40, dense: DataFrame | None = None) -> DataFrame:
    """Spread of the five-minute mean intervals inside each bucket."""
    slices = (
        consecutive_readings(hr, min_bpm, dense)
        .groupBy(PIM, "date", "slice")
        .agg(F.avg(beat_interval(F.col("bpm"))).alias("slice_mean"))
    )
    return (
        _at_widths(slices, _seconds(hours), "slice")
        .groupBy(*BUCKET)
        .agg(F.stddev_samp("slice_mean").alias("sdann"), F.count(F.lit(1)).alias("record_count"))
    )


def poincare_features(hr: DataFrame, hours: Sequence[int], min_bpm: int = 40, dense: DataFrame | None = None) -> DataFrame:
    """Rate, interval and Poincare statistics per bucket."""
    features = _bucket_features(interval_moments(consecutive_readings(hr, min_bpm, dense)), _seconds(hours))
    return features.drop("tinn", "rrtri", "modes", "sdann", "mean_rmssd", "mean_sdrr")


def _one_row_per_mode(features: DataFrame) -> DataFrame:
    """Tied modes give equal rows, one each (a histogram has few bins)."""
    one = F.lit(1).cast("long")
    return features.withColumn("_mode", F.explode(F.sequence(one, F.coalesce(F.col("modes"), one)))).drop("_mode")


def _bucket_rows(features: DataFrame) -> DataFrame:
    hours = (F.col("seconds") / 3600).cast("int")
    return _one_row_per_mode(features).select(
        F.date_add("date", 1).alias("ds"),
        PIM,
        F.concat(hours.cast("string"), F.lit(" hour")).alias("hrv_type"),
        from_epoch(F.col("start")).alias("start_time_local"),
        from_epoch(F.col("start") + F.col("seconds")).alias("end_time_local"),
        *BUCKET_COLUMNS,
    )


def hrv_x_hour(
    hr: DataFrame,
    ds: Day = None,
    ds_to: Day = None,
    hours: Sequence[int] = (1, 3, 6, 12),
    min_bpm: int = 40,
    dense: DataFrame | None = None,
) -> DataFrame:
    """Features of the day before the run date, one row per bucket (20 columns).

    All widths come from one pass. A bucket whose histogram has tied modes
    yields that many equal rows.
    """
    scanned = RunDates.of(ds, ds_to).scan(hr, TS, lag=1)
    base = interval_moments(consecutive_readings(scanned, min_bpm, dense))
    return _bucket_rows(_bucket_features(base, _seconds(hours)))


def hrv_bucket(
    hr: DataFrame, ds: Day = None, ds_to: Day = None, hours: int = 1, min_bpm: int = 40, dense: DataFrame | None = None
) -> DataFrame:
    """Features of the run date itself for one bucket width.

    Widths below a day carry no ``ds`` column. The 24-hour form has ``ds``,
    ``participantid`` and the ten shape statistics.
    """
    scanned = RunDates.of(ds, ds_to).scan(hr, TS)
    width = hours * 3600
    features = _bucket_features(interval_moments(consecutive_readings(scanned, min_bpm, dense), width), [width])
    if hours == DAY_HOURS:
        return _one_row_per_mode(features).select(
            F.col("date").alias("ds"), F.col(PIM).alias("participantid"), *SHAPE_COLUMNS
        )
    return _bucket_rows(features).drop("ds")


def hrv_daily(
    hr: DataFrame,
    ds: Day = None,
    ds_to: Day = None,
    strict: bool = True,
    min_bpm: int = 40,
    dense: DataFrame | None = None,
) -> DataFrame:
    """Daily features: means of five-minute statistics next to 24-hour ones.

    Both halves summarise the same pairs and so cover the same participants;
    they come out of one pass instead of a full outer join. ``strict`` keeps
    the published column name ``eom_poincare_sd2``; otherwise it is
    ``geom_poincare_sd2``.
    """
    scanned = RunDates.of(ds, ds_to).scan(hr, TS)
    width = DAY_HOURS * 3600
    day = _bucket_features(interval_moments(consecutive_readings(scanned, min_bpm, dense), width), [width])
    output = {"geom_poincare_sd2": "eom_poincare_sd2"} if strict else {}
    return day.select(
        F.col("date").alias("ds"),
        PIM,
        "mean_rmssd",
        "mean_sdrr",
        *[F.col(c).alias(output.get(c, c)) for c in SHAPE_COLUMNS],
    )


def hrv_5min(
    hr: DataFrame, ds: Day = None, ds_to: Day = None, min_bpm: int = 40, dense: DataFrame | None = None
) -> DataFrame:
    """Five-minute stage over all stored pairs; repeated readings count each time.

    The spread is summed around a value of the slice itself, which keeps a
    constant slice at exactly zero.
    """
    rows = weighted_readings(RunDates.of(ds, ds_to).scan(hr, TS), min_bpm, dense).filter(F.col("prev_bpm").isNotNull())
    w, bpm, rr = F.col("weight"), F.col("bpm"), beat_interval(F.col("bpm"))
    off = rr - beat_interval(F.col("slice_last_bpm"))
    step = rr - beat_interval(F.col("prev_bpm"))
    sums = rows.groupBy(PIM, "slice", "date").agg(
        F.sum(w).alias("n"),
        F.sum(w * bpm).alias("bpm_total"),
        F.sum(w * rr).alias("rr_total"),
        F.sum(w * off).alias("off_total"),
        F.sum(w * off * off).alias("off_squares"),
        F.sum(w * step * step).alias("step_squares"),
        F.min(rr).alias("beat_interval_ms_min"),
        F.max(rr).alias("beat_interval_ms_max"),
    )
    n = F.col("n").cast("double")
    spread = F.greatest(F.col("off_squares") - F.col("off_total") * F.col("off_total") / n, F.lit(0.0))
    return sums.select(
        F.col("date").alias("ds"),
        F.col(PIM).alias("participant_id"),
        from_epoch(F.col("slice")).alias("datetime_local"),
        (F.col("bpm_total") / n).alias("bpm_mean"),
        (F.col("rr_total") / n).alias("beat_interval_ms_mean"),
        F.when(n > 1, F.sqrt(spread / (n - 1))).alias("beat_interval_ms_stddev"),
        "beat_interval_ms_min",
        "beat_interval_ms_max",
        F.sqrt(F.col("step_squares") / n).alias("beat_interval_ms_rmssd"),
    )


def hrv_summary(stage: DataFrame) -> DataFrame:
    """Daily means of the five-minute stage; missing values are skipped."""
    mean = lambda c: F.avg(nan_to_null(F.col(c)))
    return stage.groupBy("ds", F.col("participant_id").alias(PIM)).agg(
        mean("beat_interval_ms_rmssd").alias("mean_rmssd"),
        mean("beat_interval_ms_stddev").alias("mean_sdrr"),
    )


def combine_hrv(tables: Sequence[DataFrame], ds: str | date) -> DataFrame:
    """Stored single-width tables stacked, with the run date in front."""
    stacked = union_all(tables)
    day = F.lit(date.fromisoformat(ds) if isinstance(ds, str) else ds)
    return stacked.select(day.alias("ds"), "*")
