"""Sensor tables derived from the sample star schema's event stream.

The select expressions are plain SQL that reads the same in other engines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIM_EXPR = "user_id % 10 as pim_id"

STAGE_CASE = (
    "case event_id % 7 when 0 then 'WAKE' when 1 then 'Light' when 2 then 'deep' when 3 then 'REM' "
    "when 4 then 'awake' when 5 then 'asleep' else 'restless' end"
)

# Some sessions reach back beyond the two days a run date usually looks at.
SESSION_BACK = "cast(case when event_id % 20 = 0 then 36 else 0 end as int) * interval '1' hour"

# Rates with quarters, and some that are not a number.
FRACTIONAL_BPM = (
    "case when event_id % 50 = 0 then cast('NaN' as double) "
    "else cast(35 + floor(value) % 150 as double) + event_id % 4 * cast(0.25 as double) end"
)

# Zone name, lower and upper bound.
ZONES = (("Out of Range", 30, 79), ("Fat Burn", 79, 111), ("Cardio", 111, 135), ("Peak", 135, 220))


@dataclass(frozen=True)
class SensorTables:
    """The input tables of the pipelines."""

    heart_rate: DataFrame
    heart_rate_fractional: DataFrame
    sleeps: DataFrame
    sleep_detail: DataFrame
    meal_events: DataFrame
    resting_heart_rate: DataFrame
    heart_rate_zones: DataFrame
    glycemic_features: DataFrame
    individual_medications: DataFrame


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def sensor_tables(spark: SparkSession, sf_dir: str) -> SensorTables:
    events = load_events(spark, sf_dir)
    person_days = events.selectExpr(PIM_EXPR, "cast(ts as date) as dt", "value")
    zones = F.array(
        *[
            F.struct(
                F.lit(name).alias("heart_rate_zone"),
                F.lit(lo).cast("bigint").alias("min_bpm"),
                F.lit(hi).cast("bigint").alias("max_bpm"),
            )
            for name, lo, hi in ZONES
        ]
    )
    return SensorTables(
        heart_rate=events.selectExpr(
            PIM_EXPR, "ts as heart_rate_datetime_loc", "cast(35 + floor(value) % 150 as bigint) as bpm"
        ),
        heart_rate_fractional=events.selectExpr(
            PIM_EXPR, "ts as heart_rate_datetime_loc", f"{FRACTIONAL_BPM} as bpm"
        ),
        sleeps=events.filter("event_type = 'signup'").selectExpr(
            PIM_EXPR,
            "cast(ts as date) as sleep_date_loc",
            f"ts - {SESSION_BACK} as start_time_loc",
            "ts + interval '7' hour as end_time_loc",
        ),
        sleep_detail=events.filter("event_type = 'view'").selectExpr(
            PIM_EXPR,
            "ts as sleep_datetime_loc",
            "600 + 300 * (event_id % 20) as sleep_duration",
            f"{STAGE_CASE} as sleep_stage",
        ),
        meal_events=events.filter("event_type = 'purchase'").selectExpr(
            PIM_EXPR,
            "ts as start_datetime_local",
            "ts + cast(20 + event_id % 100 as int) * interval '1' minute as peak_datetime_local",
            "ts + cast(50 + event_id % 100 + event_id % 180 as int) * interval '1' minute"
            " as return_to_baseline_datetime_local",
            "50 + event_id % 100 + event_id % 180 as duration",
            "20 + event_id % 100 as time_to_peak",
            "80 + value as peak_glucose",
            "value / 2 as excursion_size",
        ),
        resting_heart_rate=person_days.groupBy("pim_id", "dt")
        .agg(F.expr("cast(45 + count(*) % 30 as double)").alias("resting_heart_rate"))
        .selectExpr("pim_id", "resting_heart_rate", "dt as resting_heart_heart_date_loc"),
        heart_rate_zones=person_days.select("pim_id", "dt")
        .distinct()
        .withColumn("z", F.explode(zones))
        .selectExpr("pim_id", "dt as heart_rate_date_loc", "z.heart_rate_zone", "z.min_bpm", "z.max_bpm"),
        glycemic_features=person_days.groupBy("pim_id", F.col("dt").alias("ds")).agg(
            F.avg("value").alias("mean_glucose")
        ),
        individual_medications=events.filter("user_id % 2 = 0")
        .selectExpr(
            "cast(user_id % 10 as string) as pim_id",
            "cast(ts as date) as ds",
            "cast((user_id % 10) % 4 = 0 as int) as insulin",
            "cast((user_id % 10) % 4 = 2 as int) as biguanides",
            "cast((user_id % 10) % 3 = 0 as int) as sulfonylureas",
        )
        .distinct(),
    )
