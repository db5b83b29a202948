"""Registered queries over the sample tables.

Pipelines run in their all-run-dates form, so each query reads its whole
table. Doubles are rounded to six decimals for comparison.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsewright.functions.rundates import RunDates
from pulsewright.functions.stats import beat_interval, poincare_major, poincare_minor, rmssd
from pulsewright.functions.timeops import on_day
from pulsewright.operators import heartbeat
from pulsewright.operators.describe import describe_col
from pulsewright.operators.heartbeat import TS, consecutive_readings
from pulsewright.operators.relational import aggregate_table, cohort, outer_all, rename, require_rows, value_counts
from pulsewright.operators.triangle import bin_start
from pulsewright.plans import bpm, events, glycemic, hrv, job, meals
from pulsewright.plans.publish import publish
from pulsewright.session import configure, scratch_path
from pulsewright.sinks import envelope
from pulsewright.sinks.conform import conform
from pulsewright.sinks.files import (
    file_order,
    with_batch_time,
    write_clustered,
    write_csv,
    write_json,
    write_partition,
    write_range_partitioned,
)
from pulsewright.sources import scans, schemas
from pulsewright.sources.adapters import SensorTables, sensor_tables

Query = Callable[[SparkSession, str], DataFrame]

# The latest run date of the sample tables, for the forms that take a single one.
LAST_DAY = "2024-01-30"
DAY_BEFORE = "2024-01-29"
CORRECTED_DAY = "2024-01-17"
BATCH_TIME = datetime(2024, 2, 1, 12, 0, 0)
WIDTHS = (1, 3, 6, 12)

_QUERIES: dict[str, Query] = {}


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six decimals; a negative zero becomes zero."""
    cols = [
        (F.round(f.name, 6) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema
    ]
    return df.select(*cols)


def query(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Register ``fn(tables)`` or ``fn(tables, spark)`` under its own name."""
    wants_spark = fn.__code__.co_argcount == 2

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = sensor_tables(configure(spark), sf_dir)
        return rounded(fn(tables, spark) if wants_spark else fn(tables))

    _QUERIES[fn.__name__] = run
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- sources and sinks -------------------------------------------------------


@query
def scan_bpm(t: SensorTables) -> DataFrame:
    return scans.scan_bpm(t.heart_rate, LAST_DAY)


@query
def scan_resting(t: SensorTables) -> DataFrame:
    return scans.scan_resting(t.resting_heart_rate, LAST_DAY)


@query
def scan_zones(t: SensorTables) -> DataFrame:
    return scans.scan_zones(t.heart_rate_zones, LAST_DAY)


@query
def bpm_stream_2d(t: SensorTables) -> DataFrame:
    return scans.bpm_stream(t.heart_rate, LAST_DAY)


@query
def bpm_stream_4d(t: SensorTables) -> DataFrame:
    return scans.bpm_stream(t.heart_rate, LAST_DAY, days=4)


@query
def csv_roundtrip(t: SensorTables, spark: SparkSession) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_csv(t.meal_events, path)
    return scans.read_csv(spark, path, t.meal_events.schema)


@query
def json_roundtrip(t: SensorTables, spark: SparkSession) -> DataFrame:
    path = scratch_path(spark, "json")
    stage = hrv.hrv_summary(hrv.hrv_5min(t.heart_rate))
    write_json(stage, path, now=BATCH_TIME)
    schema = T.StructType([*stage.schema.fields, T.StructField("batch_time", T.TimestampType())])
    return spark.read.schema(schema).json(path).withColumn("batch_time", F.col("batch_time").cast("timestamp_ntz"))


@query
def partition_replace(t: SensorTables, spark: SparkSession) -> DataFrame:
    path = scratch_path(spark, "partitions")
    stats = bpm.daily_bpm_stats(t.heart_rate).withColumnRenamed("date", "ds")
    write_partition(stats.withColumn("mean_bpm", F.lit(0.0)), path, sort=("pim_id",))
    write_partition(stats, path, sort=("pim_id",))
    return spark.read.schema(stats.schema).parquet(path).select(*stats.columns)


@query
def clustered_files(t: SensorTables, spark: SparkSession) -> DataFrame:
    """Readings in files that follow each other by participant and time, read back by their position."""
    path = scratch_path(spark, "clustered")
    write_clustered(t.heart_rate, path, ["pim_id", TS, "bpm"], files=6)
    return file_order(spark, path, ["pim_id", TS, "bpm"]).agg(
        F.sum("rows").alias("rows_read"),
        F.sum("unordered").alias("unordered"),
        F.count_if("overlaps").alias("overlapping_files"),
        (F.count(F.lit(1)) > 1).alias("several_files"),
        F.min("first.pim_id").alias("first_pim_id"),
        F.max("last.pim_id").alias("last_pim_id"),
    )


@query
def range_partition(t: SensorTables, spark: SparkSession) -> DataFrame:
    path = scratch_path(spark, "ranges")
    joined = glycemic.glycemic_medications(t.glycemic_features, t.individual_medications)
    write_range_partitioned(joined, path, "insulin", 0, 1, 10)
    return spark.read.parquet(path).withColumn("range_start", F.col("range_start").cast("bigint"))


def _rerun_stats(hr: DataFrame) -> DataFrame:
    """Daily statistics of a rerun over the last two days: a stricter cut, and no reading on the last day."""
    return bpm.daily_bpm_stats(on_day(hr, TS, DAY_BEFORE), min_bpm=100).withColumnRenamed("date", "ds")


@query
def partition_emptied(t: SensorTables, spark: SparkSession) -> DataFrame:
    """A rerun of two days, one of which has no rows any more."""
    path = scratch_path(spark, "emptied")
    stats = bpm.daily_bpm_stats(t.heart_rate).withColumnRenamed("date", "ds")
    write_partition(stats, path)
    write_partition(_rerun_stats(t.heart_rate), path, days=RunDates.of(DAY_BEFORE, LAST_DAY))
    return spark.read.schema(stats.schema).parquet(path).select(*stats.columns)


@query
def run_job_emptied(t: SensorTables, spark: SparkSession) -> DataFrame:
    """The same rerun as a job."""
    path = scratch_path(spark, "job-emptied")
    schema = [schemas.field("ds", "DATE"), schemas.field("pim_id", "INTEGER"), *schemas.floats([*schemas.STATS, "count_"])]
    every = lambda heart_rate: rename(bpm.daily_bpm_stats(heart_rate), {"date": "ds"})
    job.run_job({"heart_rate": t.heart_rate}, every, schema, path)
    job.run_job({"hr": t.heart_rate}, _rerun_stats, schema, path, DAY_BEFORE, ds_to=LAST_DAY)
    return spark.read.schema(schemas.struct_of(schema)).parquet(path).select("ds", "pim_id", *schemas.STATS, "count_")


@query
def range_replace(t: SensorTables, spark: SparkSession) -> DataFrame:
    """Two ranges are replaced, one of them by nothing."""
    path = scratch_path(spark, "ranges-replaced")
    joined = glycemic.glycemic_medications(t.glycemic_features, t.individual_medications)
    joined = joined.withColumn("level", F.col("insulin") + 2 * F.col("biguanides"))
    again = joined.filter("level = 0").withColumn("mean_glucose", F.col("mean_glucose") + 1)
    write_range_partitioned(joined, path, "level", 0, 1, 10)
    write_range_partitioned(again, path, "level", 0, 1, 10, ranges=[0, 1])
    return spark.read.parquet(path).withColumn("range_start", F.col("range_start").cast("bigint"))


@query
def conform_schema(t: SensorTables) -> DataFrame:
    summary = hrv.hrv_summary(hrv.hrv_5min(t.heart_rate)).withColumn("pim_id", F.col("pim_id").cast("string"))
    return conform(summary, schemas.HRV_SUMMARY).drop("batch_time")


@query
def cloud_event(t: SensorTables) -> DataFrame:
    rows = bpm.daily_bpm_stats(t.heart_rate)
    return envelope.cloud_event(rows, "features", "daily", "sample").select(
        "datacontenttype", "source", "type", "referenceprojectid", "data.*"
    )


@query
def messages(t: SensorTables) -> DataFrame:
    rows = rounded(meals.meal_means(t.meal_events))
    sent = envelope.to_messages(rows, {"kind": "meal"})
    back = sent.select(F.from_json("value", rows.schema).alias("row"), F.expr("headers[0]").alias("h"))
    return back.select("row.*", F.col("h.key").alias("header_key"), F.col("h.value").cast("string").alias("header"))


@query
def published_rows(t: SensorTables) -> DataFrame:
    rows = rounded(bpm.daily_bpm_stats(t.heart_rate))
    wrapped = T.StructType(
        [T.StructField(n, T.StringType()) for n in ("source", "type", "referenceprojectid")]
        + [T.StructField("data", rows.schema)]
    )
    sent = publish(rows, "features", "daily", "sample")
    return sent.select(F.from_json("value", wrapped).alias("e")).select(
        "e.source", "e.type", "e.referenceprojectid", "e.data.*"
    )


@query
def run_job(t: SensorTables, spark: SparkSession) -> DataFrame:
    path = scratch_path(spark, "job")
    schema = [schemas.field("ds", "DATE"), schemas.field("pim_id", "INTEGER"), *schemas.floats([*schemas.STATS, "count_"])]

    def transform(heart_rate: DataFrame) -> DataFrame:
        return rename(bpm.daily_bpm_stats(heart_rate), {"date": "ds"})

    job.run_job({"heart_rate": t.heart_rate}, transform, schema, path)
    return spark.read.schema(schemas.struct_of(schema)).parquet(path).select("ds", "pim_id", *schemas.STATS, "count_")


@query
def cohort_filter(t: SensorTables) -> DataFrame:
    medicated = t.individual_medications.select(F.col("pim_id").cast("bigint").alias("pim_id"))
    return cohort(t.heart_rate, medicated)


# --- aggregates and joins ----------------------------------------------------


@query
def daily_bpm_stats(t: SensorTables) -> DataFrame:
    return bpm.daily_bpm_stats(t.heart_rate)


@query
def outer_fold(t: SensorTables) -> DataFrame:
    hr = t.heart_rate.filter("bpm >= 40").withColumnRenamed("pim_id", "participant_id")
    rest = t.resting_heart_rate.withColumnRenamed("pim_id", "participant_id")
    meal = t.meal_events.withColumnRenamed("pim_id", "participant_id")
    return outer_all(
        [
            aggregate_table(hr, "bpm", "participant_id", ["mean_bpm", "count_"]),
            aggregate_table(rest, "resting_heart_rate", "participant_id", ["mean_resting_bpm", "max_resting_bpm"]),
            aggregate_table(meal, "peak_glucose", ["participant_id"], {"mean_glucose": F.avg, "sd_glucose": F.stddev_samp}),
        ]
    )


@query
def glycemic_medications(t: SensorTables) -> DataFrame:
    return glycemic.glycemic_medications(t.glycemic_features, t.individual_medications)


@query
def stage_intervals(t: SensorTables) -> DataFrame:
    return events.sleep_stage_intervals(t.sleeps, t.sleep_detail)


# --- heart-rate variability --------------------------------------------------


@query
def consecutive_beats(t: SensorTables) -> DataFrame:
    return consecutive_readings(t.heart_rate).select("pim_id", "date", "heart_rate_datetime_loc", "bpm", "prev_bpm", "avg_rr")


def _squeezed(hr: DataFrame) -> DataFrame:
    """Readings with each day pressed into its first five minutes, so that a slice holds a whole day."""
    micros, day = F.unix_micros(F.col(TS).cast("timestamp")), F.lit(86_400_000_000)
    into = F.floor((micros % day) / 288)
    return hr.withColumn(TS, F.timestamp_micros(micros - micros % day + into).cast("timestamp_ntz"))


def _cut(hr: DataFrame) -> DataFrame:
    return heartbeat.dense_cuts(hr, largest=1)


@query
def dense_beats(t: SensorTables) -> DataFrame:
    hr = _squeezed(t.heart_rate)
    beats = consecutive_readings(hr, dense=_cut(hr))
    return beats.select("pim_id", "date", "heart_rate_datetime_loc", "bpm", "prev_bpm", "avg_rr")


@query
def dense_hrv_daily(t: SensorTables) -> DataFrame:
    hr = _squeezed(t.heart_rate)
    return hrv.hrv_daily(hr, dense=_cut(hr))


@query
def dense_hrv_5min(t: SensorTables) -> DataFrame:
    hr = _squeezed(t.heart_rate)
    return hrv.hrv_5min(hr, dense=_cut(hr))


@query
def rmssd_poincare(t: SensorTables) -> DataFrame:
    b, p = F.col("bpm"), F.col("prev_bpm")
    return (
        consecutive_readings(t.heart_rate)
        .groupBy("pim_id", "date")
        .agg(
            F.stddev_samp(beat_interval(b)).alias("interval_sd"),
            rmssd(b, p).alias("rmssd"),
            F.stddev_samp(poincare_minor(b, p)).alias("sd1"),
            F.stddev_samp(poincare_major(b, p, F.col("avg_rr"))).alias("sd2"),
        )
    )


@query
def sdann(t: SensorTables) -> DataFrame:
    return _bucketed(hrv.sdann(t.heart_rate, WIDTHS))


@query
def nn_histogram(t: SensorTables) -> DataFrame:
    return _bins(hrv.nn_histogram(t.heart_rate, WIDTHS))


@query
def nn_modes(t: SensorTables) -> DataFrame:
    return _bins(hrv.nn_modes(t.heart_rate, WIDTHS))


@query
def tinn_rrtri(t: SensorTables) -> DataFrame:
    return _bucketed(hrv.tinn_features(t.heart_rate, WIDTHS))


def _bucketed(df: DataFrame) -> DataFrame:
    return df.withColumn("start", F.timestamp_seconds("start").cast("timestamp_ntz")).withColumn(
        "hours", (F.col("seconds") / 3600).cast("int")
    ).drop("seconds")


def _bins(df: DataFrame) -> DataFrame:
    return _bucketed(df).withColumn("bin_start", bin_start(F.col("bin"))).drop("bin")


@query
def hrv_5min(t: SensorTables) -> DataFrame:
    return hrv.hrv_5min(t.heart_rate)


@query
def hrv_summary(t: SensorTables) -> DataFrame:
    return hrv.hrv_summary(hrv.hrv_5min(t.heart_rate))


@query
def hrv_1h(t: SensorTables) -> DataFrame:
    return hrv.hrv_bucket(t.heart_rate, hours=1)


@query
def hrv_3h(t: SensorTables) -> DataFrame:
    return hrv.hrv_bucket(t.heart_rate, hours=3)


@query
def hrv_6h(t: SensorTables) -> DataFrame:
    return hrv.hrv_bucket(t.heart_rate, hours=6)


@query
def hrv_12h(t: SensorTables) -> DataFrame:
    return hrv.hrv_bucket(t.heart_rate, hours=12)


@query
def hrv_24h(t: SensorTables) -> DataFrame:
    return hrv.hrv_bucket(t.heart_rate, hours=24)


@query
def hrv_x_hour(t: SensorTables) -> DataFrame:
    return hrv.hrv_x_hour(t.heart_rate)


@query
def combine_hrv(t: SensorTables, spark: SparkSession) -> DataFrame:
    """The four single-width tables are stored first, as they are in use."""
    path = scratch_path(spark, "hrv")
    stored = []
    for hours in WIDTHS:
        hrv.hrv_bucket(t.heart_rate, hours=hours).write.parquet(f"{path}/{hours}h")
        stored.append(spark.read.parquet(f"{path}/{hours}h"))
    return hrv.combine_hrv(stored, LAST_DAY)


@query
def hrv_daily(t: SensorTables) -> DataFrame:
    return hrv.hrv_daily(t.heart_rate)


# --- events ------------------------------------------------------------------


def _event_readings(t: SensorTables, strict: bool = True, ds: str | None = None) -> DataFrame:
    return events.event_readings(t.heart_rate, t.sleeps, t.sleep_detail, t.meal_events, ds, strict=strict)


def _event_intervals(t: SensorTables, strict: bool = True, ds: str | None = None) -> DataFrame:
    return events.event_intervals(t.sleeps, t.sleep_detail, t.meal_events, ds, strict=strict)


@query
def event_readings(t: SensorTables) -> DataFrame:
    return _event_readings(t)


@query
def event_readings_fixed(t: SensorTables) -> DataFrame:
    return _event_readings(t, strict=False)


@query
def sleep_bpm_flags(t: SensorTables) -> DataFrame:
    return events.sleep_bpm_flags(t.heart_rate, t.sleeps, t.sleep_detail)


@query
def sleep_stage_readings(t: SensorTables) -> DataFrame:
    return events.sleep_stage_readings(t.heart_rate, t.sleeps, t.sleep_detail)


@query
def bedtime_readings(t: SensorTables) -> DataFrame:
    return events.bedtime_readings(t.heart_rate, t.sleeps)


@query
def sleep_readings(t: SensorTables) -> DataFrame:
    return events.sleep_readings(t.heart_rate, t.sleeps, t.sleep_detail)


@query
def sleep_readings_4d(t: SensorTables) -> DataFrame:
    return events.sleep_readings(t.heart_rate, t.sleeps, t.sleep_detail, days=4)


@query
def meal_readings(t: SensorTables) -> DataFrame:
    return events.meal_readings(t.heart_rate, t.meal_events)


@query
def events_detail(t: SensorTables) -> DataFrame:
    return events.detail_of(t.heart_rate, _event_intervals(t))


@query
def events_detail_fixed(t: SensorTables) -> DataFrame:
    return events.detail_of(t.heart_rate, _event_intervals(t, strict=False))


@query
def events_daily(t: SensorTables) -> DataFrame:
    return events.daily_of(t.heart_rate, _event_intervals(t))


@query
def events_daily_fixed(t: SensorTables) -> DataFrame:
    return events.daily_of(t.heart_rate, _event_intervals(t, strict=False))


def _sleep_intervals(t: SensorTables) -> DataFrame:
    return events.sleep_intervals(t.sleeps, t.sleep_detail)


@query
def sleep_events_detail(t: SensorTables) -> DataFrame:
    return events.detail_of(t.heart_rate, _sleep_intervals(t), labels=schemas.SLEEP_LABELS)


@query
def sleep_events_summary(t: SensorTables) -> DataFrame:
    return events.daily_of(t.heart_rate, _sleep_intervals(t), labels=schemas.SLEEP_LABELS)


@query
def events_detail_duration(t: SensorTables) -> DataFrame:
    return events.detail_of(t.heart_rate, _sleep_intervals(t), labels=schemas.SLEEP_LABELS, with_duration=True)


@query
def event_value_counts(t: SensorTables) -> DataFrame:
    return value_counts(events.detail_of(t.heart_rate, _event_intervals(t)), "event")


# --- period features ---------------------------------------------------------


def _bpm_features(t: SensorTables, ds: str | None = None, dedupe: bool = True) -> DataFrame:
    nested = bpm.bpm_features(t.heart_rate, t.resting_heart_rate, t.heart_rate_zones, ds, dedupe=dedupe)
    return bpm.flat_bpm_features(nested)


@query
def bpm_features(t: SensorTables) -> DataFrame:
    return _bpm_features(t, LAST_DAY)


@query
def bpm_features_backfill(t: SensorTables) -> DataFrame:
    return _bpm_features(t)


def _stored_days(t: SensorTables, spark: SparkSession, hr: DataFrame) -> str:
    """Daily rows of the history up to the day before the last, then the last day merged in."""
    path = scratch_path(spark, "bpm-days")
    bpm.store_bpm_days(hr, t.resting_heart_rate, t.heart_rate_zones, path, ds_to=DAY_BEFORE)
    bpm.store_bpm_days(hr, t.resting_heart_rate, t.heart_rate_zones, path, LAST_DAY)
    return path


@query
def bpm_features_incremental(t: SensorTables, spark: SparkSession) -> DataFrame:
    """Features of the last day from stored daily rows: a day's run reads the readings of that day only."""
    stored = spark.read.parquet(_stored_days(t, spark, t.heart_rate))
    return bpm.flat_bpm_features(bpm.features_of_days(stored, LAST_DAY))


@query
def bpm_features_corrected(t: SensorTables, spark: SparkSession) -> DataFrame:
    """All run dates from stored daily rows, one day of which is stored again with a stricter cut."""
    path = _stored_days(t, spark, t.heart_rate)
    bpm.store_bpm_days(t.heart_rate, t.resting_heart_rate, t.heart_rate_zones, path, CORRECTED_DAY, min_bpm=100)
    return bpm.flat_bpm_features(bpm.features_of_days(spark.read.parquet(path)))


@query
def bpm_features_fractional_incremental(t: SensorTables, spark: SparkSession) -> DataFrame:
    stored = spark.read.parquet(_stored_days(t, spark, t.heart_rate_fractional))
    return bpm.flat_bpm_features(bpm.features_of_days(stored))


@query
def bpm_features_nodedupe(t: SensorTables) -> DataFrame:
    return _bpm_features(t, dedupe=False)


@query
def bpm_features_fractional(t: SensorTables) -> DataFrame:
    nested = bpm.bpm_features(t.heart_rate_fractional, t.resting_heart_rate, t.heart_rate_zones)
    return bpm.flat_bpm_features(nested)


@query
def bpm_features_fractional_nodedupe(t: SensorTables) -> DataFrame:
    nested = bpm.bpm_features(t.heart_rate_fractional, t.resting_heart_rate, t.heart_rate_zones, dedupe=False)
    return bpm.flat_bpm_features(nested)


@query
def bpm_features_cleaned(t: SensorTables) -> DataFrame:
    """Inputs as loaders leave them: ids as text, rates that are no number, rows without a time."""
    text_ids = lambda df: df.withColumn("pim_id", F.col("pim_id").cast("string"))
    without = lambda df, col: df.unionByName(df.withColumn(col, F.lit(None).cast(df.schema[col].dataType)))
    no_number = lambda df, *cols: df.unionByName(df.withColumns({c: F.lit(float("nan")) for c in cols}))
    bounds = {c: F.col(c).cast("double") for c in ("min_bpm", "max_bpm")}
    hr = scans.clean(text_ids(without(t.heart_rate_fractional, TS)))
    rest = scans.clean(text_ids(without(no_number(t.resting_heart_rate, "resting_heart_rate"), "resting_heart_heart_date_loc")))
    zones = scans.clean(text_ids(without(no_number(t.heart_rate_zones.withColumns(bounds), *bounds), "heart_rate_date_loc")))
    whole = {c: F.col(c).cast("bigint") for c in bounds}
    return bpm.flat_bpm_features(bpm.bpm_features(hr, rest, zones.withColumns(whole)))


@query
def nan_readings(t: SensorTables) -> DataFrame:
    return bpm.daily_bpm_stats(t.heart_rate_fractional)


@query
def skipped_run_dates(t: SensorTables) -> DataFrame:
    return bpm.skipped_run_dates(t.heart_rate, t.resting_heart_rate, t.heart_rate_zones)


# --- stored feature tables ---------------------------------------------------


def _stored(spark: SparkSession, name: str, schema: schemas.FieldList, first: DataFrame, again: DataFrame) -> DataFrame:
    """Write a table by days, write some days again, and read the table back."""
    path = scratch_path(spark, name)
    for rows in (first, again):
        write_partition(conform(with_batch_time(rows, BATCH_TIME), schema), path)
    kind = schemas.struct_of(schema)
    back = spark.read.schema(kind).parquet(path).select(*kind.fieldNames())
    return back.withColumn("batch_time", F.col("batch_time").cast("timestamp_ntz"))


def _flat_table(table: DataFrame) -> DataFrame:
    return bpm.flat_bpm_features(table, keep=("ds", "pim_id", "batch_time"))


@query
def bpm_table(t: SensorTables, spark: SparkSession) -> DataFrame:
    """The last day is written again with a stricter validity cut."""
    sources = (t.heart_rate, t.resting_heart_rate, t.heart_rate_zones)
    every, last = bpm.bpm_features(*sources), bpm.bpm_features(*sources, LAST_DAY, min_bpm=100)
    return _flat_table(_stored(spark, "bpm-table", schemas.BPM_FEATURES, every, last))


@query
def bpm_ndjson(t: SensorTables, spark: SparkSession) -> DataFrame:
    """Nested records as NDJSON and back."""
    path = scratch_path(spark, "bpm-ndjson")
    nested = bpm.bpm_features(t.heart_rate, t.resting_heart_rate, t.heart_rate_zones, LAST_DAY)
    write_json(nested, path, now=BATCH_TIME)
    back = spark.read.schema(schemas.struct_of(schemas.BPM_FEATURES)).json(path)
    return _flat_table(back.withColumn("batch_time", F.col("batch_time").cast("timestamp_ntz")))


@query
def events_detail_table(t: SensorTables, spark: SparkSession) -> DataFrame:
    every = events.detail_of(t.heart_rate, _event_intervals(t))
    fixed = events.detail_of(t.heart_rate, _event_intervals(t, strict=False, ds=LAST_DAY), LAST_DAY)
    return _stored(spark, "events-detail", schemas.EVENTS_DETAIL, every, fixed)


@query
def events_daily_table(t: SensorTables, spark: SparkSession) -> DataFrame:
    every = events.daily_of(t.heart_rate, _event_intervals(t))
    fixed = events.daily_of(t.heart_rate, _event_intervals(t, strict=False, ds=LAST_DAY), LAST_DAY)
    return _stored(spark, "events-daily", schemas.EVENTS_DAILY, every, fixed)


# --- single run dates --------------------------------------------------------


@query
def hrv_daily_ds(t: SensorTables) -> DataFrame:
    return hrv.hrv_daily(t.heart_rate, LAST_DAY)


@query
def hrv_x_hour_ds(t: SensorTables) -> DataFrame:
    return hrv.hrv_x_hour(t.heart_rate, LAST_DAY)


@query
def event_readings_ds(t: SensorTables) -> DataFrame:
    return _event_readings(t, ds=LAST_DAY)


@query
def events_daily_ds(t: SensorTables) -> DataFrame:
    return events.daily_of(t.heart_rate, _event_intervals(t, ds=LAST_DAY), LAST_DAY)


@query
def sleep_readings_ds(t: SensorTables) -> DataFrame:
    return events.sleep_readings(t.heart_rate, t.sleeps, t.sleep_detail, LAST_DAY)


@query
def sleep_stage_readings_ds(t: SensorTables) -> DataFrame:
    return events.sleep_stage_readings(t.heart_rate, t.sleeps, t.sleep_detail, LAST_DAY)


@query
def sleep_bpm_flags_ds(t: SensorTables) -> DataFrame:
    return events.sleep_bpm_flags(t.heart_rate, t.sleeps, t.sleep_detail, LAST_DAY)


# --- small table operators ---------------------------------------------------


@query
def guarded_readings(t: SensorTables) -> DataFrame:
    return require_rows(t.heart_rate, "no readings")


MEAL_ORDER = ("pim_id", "start_datetime_local", "duration", "time_to_peak", "peak_glucose", "excursion_size")


@query
def sorted_meals(t: SensorTables) -> DataFrame:
    return t.meal_events.orderBy(*MEAL_ORDER)


@query
def first_meals(t: SensorTables) -> DataFrame:
    """The first rows of the sorted table."""
    return t.meal_events.orderBy(*MEAL_ORDER).limit(25)


@query
def unplaced_readings(t: SensorTables) -> DataFrame:
    """Readings of one participant lose their owner, those of one rate their time."""
    holes = t.heart_rate.withColumns(
        {
            "pim_id": F.nullif("pim_id", F.lit(3)),
            "heart_rate_datetime_loc": F.when(F.col("bpm") != 77, F.col("heart_rate_datetime_loc")),
        }
    )
    return heartbeat.unplaced_readings(holes)


# --- meals -------------------------------------------------------------------


@query
def meal_means(t: SensorTables) -> DataFrame:
    return meals.meal_means(t.meal_events)


@query
def meal_means_by_time(t: SensorTables) -> DataFrame:
    return meals.meal_means(t.meal_events, by_time=True)


@query
def meal_describe(t: SensorTables) -> DataFrame:
    return meals.meal_stats(t.meal_events)


@query
def meal_describe_participants(t: SensorTables) -> DataFrame:
    return meals.meal_stats(t.meal_events, per="participant")


@query
def meal_describe_by_time(t: SensorTables) -> DataFrame:
    return meals.meal_stats(t.meal_events, by_time=True)


@query
def meal_by_time_range(t: SensorTables) -> DataFrame:
    return meals.by_time_range(t.meal_events)


@query
def meal_histogram(t: SensorTables) -> DataFrame:
    return meals.meal_histogram(t.meal_events)


@query
def meal_box(t: SensorTables) -> DataFrame:
    return meals.meal_box(t.meal_events)


@query
def meal_histogram_participants(t: SensorTables) -> DataFrame:
    return meals.meal_histogram(t.meal_events, per="participant")


@query
def meal_box_participants(t: SensorTables) -> DataFrame:
    return meals.meal_box(t.meal_events, per="participant")


@query
def meal_by_time_range_participants(t: SensorTables) -> DataFrame:
    return meals.by_time_range(t.meal_events, per="participant")


@query
def excursion_rate(t: SensorTables) -> DataFrame:
    return meals.by_time_range(t.meal_events, "excursion_rate").drop("metric")


@query
def describe_by_participant(t: SensorTables) -> DataFrame:
    return describe_col(t.meal_events, "peak_glucose", ["pim_id"])
