"""Period features: hand-worked cases and run-date ranges."""

import json

import numpy as np
import pytest

from pulsewright.catalog.queries import rounded
from pulsewright.plans.bpm import (
    bpm_days,
    bpm_features,
    daily_bpm_stats,
    features_of_days,
    flat_bpm_features,
    skipped_run_dates,
    store_bpm_days,
)
from pulsewright.sinks.conform import conform
from pulsewright.sources.scans import scan_bpm, scan_zones
from pulsewright.sources.schemas import BPM_FEATURES

REST = "pim_id bigint,resting_heart_rate double,resting_heart_heart_date_loc date"
ZONES = "pim_id bigint,heart_rate_date_loc date,heart_rate_zone string,min_bpm bigint,max_bpm bigint"
DS = "2019-11-01"


@pytest.fixture(scope="module")
def tables(make, hr):
    readings = [(1, f"{DS} 00:00:0{i}", b) for i, b in enumerate([60, 60, 60, 62])]
    readings += [(1, "2019-10-24 08:00:00", 70), (2, "2019-10-23 08:00:00", 80), (4, "2019-10-30 08:00:00", 30)]
    # Seven resting values with sum 431 and sum of squares 26549.
    rest = [(1, float(v), f"2019-10-{26 + i}") for i, v in enumerate([62, 60, 60, 61, 62, 64])] + [(1, 62.0, DS)]
    zones = [
        (1, DS, "Out of Range", 30, 79),
        (1, DS, "Fat Burn", 79, 111),
        (1, DS, "Cardio", 111, 135),
        (1, DS, "Peak", 135, 220),
        (3, DS, "Something Else", 50, 60),
    ]
    return hr(readings), make(rest, REST), make(zones, ZONES)


@pytest.fixture(scope="module")
def rows(tables):
    return {r.pim_id: r for r in bpm_features(*tables, DS).collect()}


def test_population_sd(rows):
    week = rows[1].period_7d
    assert week.mean_resting_bpm == pytest.approx(431 / 7)
    assert week.sd_resting_bpm == pytest.approx(1.293626448305345, abs=1e-12)
    assert week.min_resting_bpm == 60 and week.max_resting_bpm == 64


def test_event_sample_sd(hr):
    # Eleven readings with sum 833 and sum of squares 63155.
    values = [73, 73, 74, 74, 75, 75, 75, 76, 77, 79, 82]
    assert sum(values) == 833 and sum(v * v for v in values) == 63155
    row = daily_bpm_stats(hr([(1, f"{DS} 00:00:{i:02d}", v) for i, v in enumerate(values)])).first()
    assert row.sd_bpm == pytest.approx(2.596883064924673, abs=1e-12)


def test_a_rate_counts_once_per_day_unless_told_otherwise(tables, rows):
    assert rows[1].period_1d.count_ == 2 and rows[1].period_1d.mean_bpm == 61
    kept = {r.pim_id: r for r in bpm_features(*tables, DS, dedupe=False).collect()}
    assert kept[1].period_1d.count_ == 4 and kept[1].period_1d.mean_bpm == 60.5


def test_period_bounds(rows):
    starts = [str(rows[1][f"period_{n}d"].period_start_date) for n in (1, 7, 10, 14)]
    assert starts == ["2019-11-01", "2019-10-26", "2019-10-23", "2019-10-19"]
    assert str(rows[1].period_10d.earliest_bpm_date) == "2019-10-24"
    assert rows[1].period_10d.days == 10


def test_absent_period_is_a_struct_of_nulls(rows):
    two = rows[2]
    assert two.period_1d is not None and all(v is None for v in two.period_1d)
    assert all(v is None for v in two.period_7d)
    assert two.period_10d.count_ == 1 and two.period_10d.sd_bpm == 0.0


def test_zone_bounds_and_low_zone_cut(rows):
    day = rows[1].period_1d
    assert (day.min_bpm_fatburn, day.max_bpm_fatburn) == (79, 111)
    assert day.min_bpm_outofrange is None and day.max_bpm_peak == 220


def test_participant_with_only_an_unknown_zone_is_present(rows):
    assert rows[3].period_1d.days == 1 and rows[3].period_1d.count_ is None
    assert 4 not in rows


def test_no_readings_on_the_day(tables):
    with pytest.raises(ValueError, match="No data collected for 2019-10-31"):
        bpm_features(*tables, "2019-10-31")


def test_range_equals_single_runs_and_skips_empty_days(tables):
    ranged = flat_bpm_features(bpm_features(*tables, "2019-10-20", "2019-11-02"))
    assert {str(r.ds) for r in ranged.select("ds").distinct().collect()} == {"2019-10-23", "2019-10-24", DS}
    single = flat_bpm_features(bpm_features(*tables, DS))
    assert sorted(ranged.filter(f"ds = '{DS}'").collect()) == sorted(single.collect())


def test_output_schema(tables):
    out = conform(bpm_features(*tables, DS), BPM_FEATURES)
    assert out.columns == [f["name"] for f in BPM_FEATURES]
    assert len(out.schema["period_14d"].dataType.fields) == 22
    payload = json.loads(out.filter("pim_id = 2").toJSON().first())
    assert payload["period_10d"]["count_"] == 1.0


def test_scans(tables):
    hr_rows = scan_bpm(tables[0], DS).collect()
    assert {str(r.datetime_local) for r in hr_rows} == {DS, "2019-10-24", "2019-10-23"}
    assert scan_bpm(tables[0], DS, days=9).count() == 5
    assert {r.heart_rate_zone for r in scan_zones(tables[2], DS).collect()} == {
        "fatburn", "cardio", "peak", "somethingelse"
    }


def test_scan_filter_reaches_the_files(spark, tables, tmp_path):
    path = str(tmp_path / "hr")
    tables[0].write.parquet(path)
    scan = scan_bpm(spark.read.parquet(path), DS)
    explain = spark._jvm.PythonSQLUtils.explainString(scan._jdf.queryExecution(), "formatted")
    pushed = next(line for line in explain.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(heart_rate_datetime_loc,2019-10-19" in pushed
    assert "LessThan(heart_rate_datetime_loc,2019-11-02" in pushed and "GreaterThanOrEqual(bpm,40)" in pushed


def test_skipped_run_dates_are_reported(tables):
    ranged = {str(r.ds) for r in bpm_features(*tables, "2019-10-20", "2019-11-02").select("ds").distinct().collect()}
    skipped = {str(r.ds): r.participants for r in skipped_run_dates(*tables, "2019-10-20", "2019-11-02").collect()}
    assert not ranged & set(skipped) and "2019-10-25" in skipped
    assert all(n > 0 for n in skipped.values())


@pytest.mark.parametrize("dedupe", [True, False])
def test_fractional_rates_keep_their_fractions(make, tables, dedupe):
    rates = [60.5, 60.9, 60.9, 75.25, float("nan"), 12.0]
    rows = [(9, f"2019-11-01 08:00:{i:02d}", v) for i, v in enumerate(rates)] + [(9, "2019-10-30 08:00:00", 100.5), (8, "2019-11-01 08:00:00", 60.7), (8, "2019-10-31 09:00:00", 60.7)]
    hr = make(rows, "pim_id bigint,heart_rate_datetime_loc timestamp_ntz,bpm double")
    made = {r.pim_id: r for r in bpm_features(hr, tables[1], tables[2], DS, dedupe=dedupe).collect()}
    day = sorted(set(rates[:4])) if dedupe else rates[:4]
    one, week = made[9].period_1d, made[9].period_7d
    assert (one.count_, one.min_bpm, one.max_bpm) == (len(day), 60.5, 75.25)
    assert one.mean_bpm == pytest.approx(np.mean(day)) and one.sd_bpm == pytest.approx(np.std(day))
    assert week.mean_bpm == pytest.approx(np.mean([*day, 100.5])) and week.sd_bpm == pytest.approx(np.std([*day, 100.5]))
    assert made[8].period_7d.sd_bpm == pytest.approx(0.0, abs=1e-9)


def same_rows(a, b):
    """Equal up to the order in which doubles are summed."""
    a, b = (rounded(flat_bpm_features(f)) for f in (a, b))
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


@pytest.mark.parametrize("dedupe", [True, False])
def test_stored_days_give_the_features_of_a_full_run(spark, tables, tmp_path, dedupe):
    path = str(tmp_path / "days")
    store_bpm_days(*tables, path, ds_to="2019-10-25", dedupe=dedupe)
    store_bpm_days(*tables, path, "2019-10-26", DS, dedupe=dedupe)
    stored = spark.read.parquet(path)
    assert same_rows(features_of_days(stored, DS), bpm_features(*tables, DS, dedupe=dedupe))
    assert same_rows(features_of_days(stored), bpm_features(*tables, dedupe=dedupe))
    assert same_rows(features_of_days(stored, "2019-10-23", DS), bpm_features(*tables, "2019-10-23", DS, dedupe=dedupe))


def test_a_day_is_corrected_and_emptied(spark, tables, tmp_path):
    hr, rest, zones = tables
    path = str(tmp_path / "days")
    store_bpm_days(*tables, path)
    # One rate of the run date was wrong, and the readings of another day are withdrawn.
    right = hr.filter("bpm <> 62 and bpm <> 70")
    store_bpm_days(right, rest, zones, path, DS)
    store_bpm_days(right, rest, zones, path, "2019-10-24")
    stored = spark.read.parquet(path)
    assert same_rows(features_of_days(stored, DS), bpm_features(right, rest, zones, DS))
    assert stored.filter("day = '2019-10-24'").isEmpty()


def test_a_new_day_reads_that_day_only(spark, tables, tmp_path):
    hr, rest, zones = tables
    hr.write.parquet(str(tmp_path / "hr"))
    stored_hr = spark.read.parquet(str(tmp_path / "hr"))
    formatted = lambda df: spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    text = formatted(bpm_days(stored_hr, rest, zones, DS))
    assert "GreaterThanOrEqual(heart_rate_datetime_loc,2019-11-01" in text and "LessThan(heart_rate_datetime_loc,2019-11-02" in text

    path = str(tmp_path / "days")
    store_bpm_days(*tables, path)
    text = formatted(features_of_days(spark.read.parquet(path), DS, DS))
    scans = [line for line in text.splitlines() if line.startswith("PartitionFilters")]
    assert scans and all("2019-10-19" in line and "2019-11-01" in line for line in scans)
    assert "days" in text and "heart_rate_datetime_loc" not in text
