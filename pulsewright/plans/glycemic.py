"""Glycemic features next to current medications."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewright.functions.rundates import RunDates

MEDICATIONS = ("insulin", "biguanides", "sulfonylureas")


def glycemic_medications(
    features: DataFrame, medications: DataFrame, ds: str | date | None = None, ds_to: str | date | None = None
) -> DataFrame:
    """Join on participant and day.

    The text participant id of the medications is cast to a number. Days are
    tested on both sides, so features without medications drop out.
    """
    runs = RunDates.of(ds, ds_to)
    left = runs.clip(features)
    right = runs.clip(medications).select(F.col("pim_id").cast("bigint").alias("pim_id"), "ds", *MEDICATIONS)
    payload = [c for c in features.columns if c not in ("pim_id", "ds")]
    return left.join(right, ["pim_id", "ds"]).select("pim_id", "ds", *payload, *MEDICATIONS)
