"""Date and time expressions on zone-less local timestamps."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Labels of the four time-of-day ranges.
TIME_RANGES = ("Sleep (0,6]", "Morning (6,12]", "Afternoon (12,18]", "Night (18,24]")


def parse_day(ds: str | date) -> date:
    """Accept a run date as ``date`` or ``yyyy-mm-dd`` text."""
    return date.fromisoformat(ds) if isinstance(ds, str) else ds


def midnight(day: date) -> Column:
    """The zone-less timestamp at the start of a day, as a constant."""
    return F.lit(day).cast("timestamp_ntz")


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def bucket_seconds(seconds: Column, width: Column | int) -> Column:
    """Start of the epoch-aligned tumbling bucket, in epoch seconds."""
    return seconds - seconds % width


def epoch_bucket(ts: Column, width: Column | int) -> Column:
    """Start of the epoch-aligned tumbling bucket holding ``ts``."""
    return from_epoch(bucket_seconds(epoch_seconds(ts), width))


def plus_seconds(ts: Column, seconds: Column | int) -> Column:
    secs = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def minute_boundaries(later: Column, earlier: Column) -> Column:
    """Minute marks crossed between two instants (not elapsed whole minutes)."""
    minute = lambda ts: F.floor(epoch_seconds(ts) / F.lit(60))
    return minute(later) - minute(earlier)


def time_range(ts: Column) -> Column:
    """Time-of-day range of a timestamp; midnight's hour counts as night."""
    hour = F.hour(ts)
    sleep, morning, afternoon, night = TIME_RANGES
    return (
        F.when((hour > 0) & (hour <= 6), sleep)
        .when((hour > 6) & (hour <= 12), morning)
        .when((hour > 12) & (hour <= 18), afternoon)
        .when(hour.isNotNull(), night)
    )


def _is_date(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.DateType)


def between_days(df: DataFrame, col: str, first: date | None, last: date | None) -> DataFrame:
    """Keep rows whose day lies in [first, last]; an open end is not tested.

    Written as a plain range on the stored column so that it is pushed to the
    scan, for date and for timestamp columns alike.
    """
    c = F.col(col)
    if _is_date(df, col):
        lo, hi = (lambda d: c >= F.lit(d)), (lambda d: c <= F.lit(d))
    else:
        lo = lambda d: c >= midnight(d)
        hi = lambda d: c < midnight(d + timedelta(days=1))
    if first is not None:
        df = df.filter(lo(first))
    if last is not None:
        df = df.filter(hi(last))
    return df


def trailing_days(df: DataFrame, col: str, ds: str | date, days: int) -> DataFrame:
    """Keep the ``days`` calendar days that end with the run date."""
    last = parse_day(ds)
    return between_days(df, col, last - timedelta(days=days - 1), last)


def on_day(df: DataFrame, col: str, ds: str | date, lag: int = 0) -> DataFrame:
    """Keep the single day ``lag`` days before the run date."""
    day = parse_day(ds) - timedelta(days=lag)
    return between_days(df, col, day, day)
