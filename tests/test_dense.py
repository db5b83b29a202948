"""Slices that hold a large share of all readings."""

import pytest
from pyspark.sql import functions as F

from pulsewright.catalog.queries import rounded
from pulsewright.operators import heartbeat
from pulsewright.operators.heartbeat import PIECE, PIM, TS, consecutive_readings, dense_cuts
from pulsewright.plans import hrv


def burst(spark, n, every_micros, start="2024-01-01 08:00:00", pim=1):
    """``n`` readings, one in ``every_micros`` microseconds, with some copies and equal instants."""
    at = F.expr(f"timestamp_ntz '{start}'") + F.make_dt_interval(secs=F.floor(F.col("id") / 2) * 2 * every_micros / 1e6)
    rows = spark.range(n, numPartitions=4)
    return rows.select(F.lit(pim).cast("long").alias(PIM), at.alias(TS), (F.lit(50) + F.pmod(F.xxhash64("id"), F.lit(90))).alias("bpm"))


@pytest.fixture(scope="module")
def crowded(spark):
    """A crowded slice next to ordinary ones before and after it."""
    calm = burst(spark, 200, 5_000_000, "2024-01-01 07:55:00").unionByName(burst(spark, 300, 4_000_000, pim=2))
    return calm.unionByName(burst(spark, 20_000, 900)).unionByName(burst(spark, 40, 900)).cache()


def rows(df):
    return sorted(map(str, rounded(df).collect()))


def test_rows_are_those_of_uncut_slices(crowded):
    cuts = dense_cuts(crowded, largest=700)
    assert rows(consecutive_readings(crowded, dense=cuts).drop(*heartbeat.SLICE_STATISTICS)) == rows(
        consecutive_readings(crowded).drop(*heartbeat.SLICE_STATISTICS)
    )
    statistics = lambda df: df.select(PIM, "slice", *heartbeat.SLICE_STATISTICS).filter("slice_interval is not null")
    assert rows(statistics(consecutive_readings(crowded, dense=cuts))) == rows(statistics(consecutive_readings(crowded)))


@pytest.mark.parametrize(
    "make",
    [
        hrv.hrv_daily,
        hrv.hrv_x_hour,
        hrv.hrv_5min,
        lambda hr, **k: hrv.hrv_bucket(hr, hours=3, **k),
        lambda hr, **k: hrv.sdann(hr, [1, 12], **k),
        lambda hr, **k: hrv.tinn_features(hr, [1, 12], **k),
        lambda hr, **k: hrv.nn_modes(hr, [1], **k),
        lambda hr, **k: hrv.poincare_features(hr, [1], **k),
    ],
)
def test_features_are_those_of_uncut_slices(crowded, make):
    assert rows(make(crowded, dense=dense_cuts(crowded, largest=3000))) == rows(make(crowded))


def test_constant_crowded_slice_has_no_spread(spark):
    flat = burst(spark, 5000, 900).withColumn("bpm", F.lit(70).cast("long")).distinct()
    row = hrv.hrv_5min(flat, dense=dense_cuts(flat, largest=300)).first()
    assert row.beat_interval_ms_stddev == 0.0 and row.beat_interval_ms_rmssd == 0.0


def test_a_million_readings_of_one_slice_use_many_tasks(spark):
    hr = burst(spark, 1_000_000, 250)
    cuts = dense_cuts(hr, largest=100_000)
    assert len(cuts.first().cuts) == 10
    placed = heartbeat._folded_copies(hr, 40, cuts)
    sizes = [r["count"] for r in placed.groupBy(PIECE).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 110_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        by_task = placed.groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(by_task) >= 3 and max(r["count"] for r in by_task) < 700_000


def test_cuts_follow_a_share_of_all_readings_and_stay_few(spark):
    hr = burst(spark, 3000, 900).unionByName(burst(spark, 3000, 900, "2024-01-02 10:00:00", pim=3))
    cuts = dense_cuts(hr, largest=1, most=20).collect()
    assert len(cuts) == 2 and sum(len(r.cuts) for r in cuts) <= 2 * 20
    assert dense_cuts(hr).isEmpty() and dense_cuts(hr.limit(0)).isEmpty()


def test_bursts_inside_a_slice_are_cut_where_they_are(spark):
    """Nearly all readings fall into one of the slice's 300 seconds."""
    hr = burst(spark, 4000, 100).unionByName(burst(spark, 4, 60_000_000))
    cuts = dense_cuts(hr, largest=500).first().cuts
    assert len(cuts) >= 7 and cuts[0] == 0 and cuts[-2] < 1000
    sizes = heartbeat._folded_copies(hr, 40, dense_cuts(hr, largest=500)).groupBy(PIECE).count().collect()
    assert max(r["count"] for r in sizes) < 540


def test_no_cartesian_join_and_one_broadcast_of_cuts(spark, crowded):
    text = hrv.hrv_daily(crowded, dense=dense_cuts(crowded))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text
