"""Source scans of a run date, and the CSV table source."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsewright.functions.stats import nan_to_null
from pulsewright.functions.timeops import parse_day, trailing_days
from pulsewright.operators.heartbeat import TS
from pulsewright.operators.relational import valid_bpm

Ds = str | date

# Written CSV text forms that keep microseconds. The default
# reader understands them.
CSV_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}


def run_date(ds: Ds) -> Column:
    return F.lit(parse_day(ds)).alias("ds")


def clean(df: DataFrame) -> DataFrame:
    """Bring a table to the library's conventions: bigint ids, no NaN."""
    cols = []
    for field in df.schema:
        c = F.col(field.name)
        if field.name in ("pim_id", "participant_id"):
            c = c.cast("bigint")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = nan_to_null(c)
        elif isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(field.name))
    return df.select(*cols)


def scan_bpm(hr: DataFrame, ds: Ds, days: int = 14, min_bpm: int = 40) -> DataFrame:
    """Valid readings of the trailing days, reduced to their day."""
    return trailing_days(valid_bpm(hr, min_bpm=min_bpm), TS, ds, days).select(
        run_date(ds),
        F.col("pim_id").alias("participant_id"),
        F.to_date(TS).alias("datetime_local"),
        "bpm",
    )


def scan_resting(rest: DataFrame, ds: Ds, days: int = 14, min_bpm: int = 40) -> DataFrame:
    """Resting rates of the trailing days."""
    valid = valid_bpm(rest, "resting_heart_rate", min_bpm)
    return trailing_days(valid, "resting_heart_heart_date_loc", ds, days).select(
        run_date(ds),
        F.col("pim_id").alias("participant_id"),
        "resting_heart_rate",
        F.col("resting_heart_heart_date_loc").alias("datetime_local"),
    )


def zone_name(zone: Column) -> Column:
    return F.lower(F.replace(zone, F.lit(" "), F.lit("")))


def scan_zones(zones: DataFrame, ds: Ds, days: int = 14, min_bpm: int = 40) -> DataFrame:
    """Heart-rate zones of the trailing days, names without case and blanks."""
    valid = valid_bpm(valid_bpm(zones, "min_bpm", min_bpm), "max_bpm", min_bpm)
    return trailing_days(valid, "heart_rate_date_loc", ds, days).select(
        run_date(ds),
        F.col("pim_id").alias("participant_id"),
        F.col("heart_rate_date_loc").alias("datetime_local"),
        zone_name(F.col("heart_rate_zone")).alias("heart_rate_zone"),
        "min_bpm",
        "max_bpm",
    )


def bpm_stream(hr: DataFrame, ds: Ds, days: int = 2, min_bpm: int = 40) -> DataFrame:
    """Valid readings of the trailing days with their time."""
    return trailing_days(valid_bpm(hr, min_bpm=min_bpm), TS, ds, days).select(
        "pim_id", F.col(TS).alias("datetime_local"), "bpm"
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV table with a header row and an explicit schema."""
    return spark.read.schema(schema).csv(path, header=True)
