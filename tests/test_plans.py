"""Plan shapes that matter at scale."""

import re

import pytest

from pulsewright.catalog.queries import WIDTHS
from pulsewright.operators.describe import describe_col
from pulsewright.operators.relational import cohort
from pulsewright.plans import bpm, events, hrv, meals
from pulsewright.session import scratch_path
from pulsewright.sinks.files import write_clustered
from pulsewright.sources.adapters import sensor_tables


@pytest.fixture(scope="module")
def tables(spark):
    return sensor_tables(spark, "/root/testdata/sf0.001")


@pytest.fixture
def large(spark):
    """Plan as for large inputs: nothing is small enough to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    """Shuffles of a plan, reused ones not counted."""
    return [line for line in text.splitlines() if re.search(r"[+:]- Exchange ", line)]


def test_variability_shuffles(large, tables):
    text = plan(hrv.hrv_x_hour(tables.heart_rate))
    assert "ReusedExchange" in text and text.count("FileScan") == 1
    # copies, slices, day of the slice table and back, moments twice.
    assert len(exchanges(text)) == 6
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text


def test_event_join_is_an_equi_join_and_distinct_stays_in_place(large, tables):
    t = tables
    text = plan(events.event_readings(t.heart_rate, t.sleeps, t.sleep_detail, t.meal_events))
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    # Readings twice, stages three times, sessions once, intervals twice, counts of buckets
    # twice; those of readings read the readings' first shuffle.
    found = [line for line in exchanges(text) if "SinglePartition" not in line]
    assert len(found) == 10
    assert len([line for line in found if "datetime_local" in line and "_salt" not in line]) == 1
    assert len([line for line in text.splitlines() if "ReusedExchange" in line]) >= 3


def test_scan_reads_used_columns_only(tables):
    explain = tables.heart_rate.sparkSession._jvm.PythonSQLUtils.explainString(
        hrv.hrv_daily(tables.heart_rate, "2024-01-10")._jdf.queryExecution(), "formatted"
    )
    schemas = {line.strip() for line in explain.splitlines() if line.startswith("ReadSchema")}
    assert schemas == {"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>"}
    assert "GreaterThanOrEqual(ts,2024-01-10" in explain


@pytest.mark.parametrize(
    "make",
    [
        hrv.hrv_5min,
        lambda hr: hrv.hrv_summary(hrv.hrv_5min(hr)),
        lambda hr: hrv.sdann(hr, WIDTHS),
        lambda hr: hrv.nn_histogram(hr, WIDTHS),
        lambda hr: hrv.nn_modes(hr, WIDTHS),
        lambda hr: hrv.tinn_features(hr, WIDTHS),
        hrv.hrv_daily,
    ],
)
def test_readings_are_scanned_once(large, tables, make):
    text = plan(make(tables.heart_rate))
    assert text.count("FileScan") == 1 and "ReusedExchange" in text


@pytest.mark.parametrize("dedupe", [True, False])
def test_backfill_scans_readings_once(large, spark, tables, dedupe, tmp_path):
    # Other inputs come from files of their own, to tell the scans apart.
    tables.resting_heart_rate.write.parquet(str(tmp_path / "rest"))
    tables.heart_rate_zones.write.parquet(str(tmp_path / "zones"))
    rest, zones = (spark.read.parquet(str(tmp_path / n)) for n in ("rest", "zones"))
    text = plan(bpm.bpm_features(tables.heart_rate, rest, zones, dedupe=dedupe))
    assert text.count("events.parquet") == 1


def test_meal_statistics_scan_once(large, tables):
    for make in (meals.meal_stats, meals.meal_box, meals.by_time_range, lambda t: meals.meal_stats(t, per="participant")):
        assert plan(make(tables.meal_events)).count("FileScan") == 1
    text = plan(describe_col(tables.meal_events, "peak_glucose", ["pim_id"]))
    assert text.count("FileScan") == 1 and "Broadcast" not in text
    # Only the two one-row-per-group sides meet on the group alone.
    joins = [line for line in text.splitlines() if "SortMergeJoin" in line]
    assert len([line for line in joins if "_slot" not in line and "_stride" not in line]) == 1
    # No window holds all slots of a group: each runs inside a stride, over strides, or inside a slot.
    for frame in (describe_col(tables.meal_events, "peak_glucose", ["pim_id"]), meals.meal_box(tables.meal_events), meals.meal_histogram(tables.meal_events)):
        windows = [line for line in plan(frame).splitlines() if re.search(r"[+:]- \*?\(?\d*\)? ?Window ", line)]
        assert windows and all("_stride" in w or "_subslot" in w or "_sum#" in w or "_low" in w or "_group" in w or "_first" in w for w in windows)


def test_single_run_date_bounds_the_stage_scan(tables):
    t = tables
    for df in (
        events.event_readings(t.heart_rate, t.sleeps, t.sleep_detail, t.meal_events, "2024-01-20"),
        events.sleep_readings(t.heart_rate, t.sleeps, t.sleep_detail, "2024-01-20"),
        events.sleep_stage_readings(t.heart_rate, t.sleeps, t.sleep_detail, "2024-01-20"),
        events.sleep_bpm_flags(t.heart_rate, t.sleeps, t.sleep_detail, "2024-01-20"),
    ):
        # Both bounds, in the filter on top of the scan of stages.
        filters = [line for line in plan(df).splitlines() if "Filter" in line and "FileScan" not in line and "= view" in line]
        assert filters and all(re.search(r"ts#\d+ >= Subquery.*ts#\d+ <= Subquery", line) for line in filters)


def test_scratch_folder_needs_a_shared_place_on_a_cluster():
    class Session:
        def __init__(self, **conf):
            self.conf = self
            self.get = lambda key, default=None: conf.get(key.split(".")[-1] if "checkpoint" not in key else "shared", default)

    assert scratch_path(Session(shared="file:///x/", master="spark://a:7077"), "n").startswith("file:///x/n-")
    assert "pulsewright-" in scratch_path(Session(master="local[4]"), "n")
    for master in ("spark://a:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_path(Session(master=master), "n")


def test_cohort_bounds_reach_the_scan(large, spark, tables, tmp_path):
    write_clustered(tables.heart_rate, str(tmp_path / "hr"), ["pim_id"], files=5)
    stored = spark.read.parquet(str(tmp_path / "hr"))
    people = spark.createDataFrame([("7",), ("8",), ("8",), (None,)], "pim_id string")
    got = cohort(stored, people)
    text = plan(got)
    scan = next(line for line in text.splitlines() if "FileScan" in line and "bpm#" in line)
    assert "NestedLoop" not in text and "Broadcast" not in text
    # One subquery gives both bounds.
    assert re.search(r"DataFilters: \[.*pim_id#\d+L >= Subquery", scan) and text.count("- Subquery scalar-subquery") == 1
    want = stored.filter("pim_id in (7, 8)").collect()
    assert sorted(got.select(*stored.columns).collect()) == sorted(want) and want
    assert cohort(stored, people.limit(0)).isEmpty()
