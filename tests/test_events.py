"""Event windows, labels and features."""

import pytest

from pulsewright.plans import events
from pulsewright.sources.schemas import EVENT_LABELS, EVENTS_DAILY, EVENTS_DETAIL
from pulsewright.sinks.conform import conform

SLEEPS = "pim_id bigint,sleep_date_loc date,start_time_loc timestamp_ntz,end_time_loc timestamp_ntz"
DETAIL = "pim_id bigint,sleep_datetime_loc timestamp_ntz,sleep_duration bigint,sleep_stage string"
MEALS = (
    "pim_id bigint,start_datetime_local timestamp_ntz,peak_datetime_local timestamp_ntz,"
    "return_to_baseline_datetime_local timestamp_ntz"
)
DS = "2021-05-04"


@pytest.fixture(scope="module")
def sleeps(make):
    return make([(1, "2021-05-03", "2021-05-03 06:30:00", "2021-05-03 07:30:00")], SLEEPS)


@pytest.fixture(scope="module")
def detail(make):
    return make(
        [
            (1, "2021-05-03 06:38:30", 690, "WAKE"),
            (1, "2021-05-03 06:38:30", 690, "WAKE"),
            (1, "2021-05-03 07:30:00", 60, "Odd"),
            (1, "2021-05-03 09:00:00", 600, "deep"),
            (1, "2021-05-03 07:00:00", 60, None),
            (2, "2021-05-03 06:38:30", 690, "rem"),
        ],
        DETAIL,
    )


@pytest.fixture(scope="module")
def meals(make):
    return make(
        [
            (1, f"{DS} 12:00:00", f"{DS} 13:00:00", f"{DS} 15:00:00"),
            (3, f"{DS} 12:00:00", f"{DS} 13:00:00", None),
        ],
        MEALS,
    )


READINGS = [
    (1, "2021-05-03 06:38:29", 70),
    (1, "2021-05-03 06:38:30", 71),
    (1, "2021-05-03 06:38:30", 71),
    (1, "2021-05-03 06:49:59", 73),
    (1, "2021-05-03 06:50:00", 74),
    (1, "2021-05-03 07:30:10", 75),
    (1, "2021-05-03 07:40:00", 76),
    (1, f"{DS} 12:10:00", 80),
    (1, f"{DS} 12:10:01", 81),
    (1, f"{DS} 13:05:00", 82),
    (1, f"{DS} 15:05:00", 83),
    (2, "2021-05-03 06:39:00", 90),
    (3, f"{DS} 13:05:00", 91),
    (1, "2021-05-03 06:39:00", 39),
]


@pytest.fixture(scope="module")
def readings(hr, sleeps, detail, meals):
    return events.event_readings(hr(READINGS), sleeps, detail, meals, DS).cache()


@pytest.fixture(scope="module")
def fixed(hr, sleeps, detail, meals):
    return events.event_readings(hr(READINGS), sleeps, detail, meals, DS, strict=False).cache()


def labels(frame):
    return sorted((r.participant_id, r.event, r.bpm) for r in frame.collect())


def test_labels_and_inclusive_ends(readings):
    assert labels(readings) == [
        (1, "bedtime_end", 75),
        (1, "bedtime_end", 76),
        (1, "bedtime_start", 70),
        (1, "bedtime_start", 71),
        (1, "meal_return_baseline", 82),
        (1, "meal_start", 80),
        (1, "odd", 75),
        (1, "peak_postpandrial_start", 82),
        (1, "wake", 71),
        (1, "wake", 73),
        (3, "meal_return_baseline", 91),
        (3, "peak_postpandrial_start", 91),
    ]


def test_corrected_spelling_and_window(fixed):
    got = labels(fixed)
    assert (1, "meal_return_baseline", 83) in got and (1, "meal_return_baseline", 82) not in got
    assert (1, "peak_postprandial_start", 82) in got


def test_stage_end_and_minutes(readings):
    row = readings.filter("event = 'wake'").first()
    assert str(row.end_time) == "2021-05-03 06:49:59" and row.duration == 11


def test_minute_marks_not_elapsed(make):
    from pyspark.sql import functions as F

    from pulsewright.functions.timeops import minute_boundaries, time_range

    frame = make([("2021-01-01 06:38:59", "2021-01-01 06:40:00")], "a timestamp_ntz,b timestamp_ntz")
    assert frame.select(minute_boundaries(F.col("b"), F.col("a"))).first()[0] == 2
    hours = make([(f"2021-01-01 {h:02d}:30:00",) for h in (0, 1, 6, 7, 12, 13, 18, 19)], "t timestamp_ntz")
    names = [r[0].split()[0] for r in hours.select(time_range(F.col("t"))).collect()]
    assert names == ["Night", "Sleep", "Sleep", "Morning", "Morning", "Afternoon", "Afternoon", "Night"]


def test_long_form(readings):
    rows = {(r.pim_id, r.event): r for r in events.events_detail(readings).collect()}
    assert set(rows) == {(1, e) for e in ("bedtime_end", "bedtime_start", "meal_return_baseline", "meal_start", "wake")}
    assert rows[1, "wake"].mean_bpm == 72 and rows[1, "wake"].sd_bpm == 1 and rows[1, "wake"].count_ == 2


def test_wide_form(readings):
    rows = {r.pim_id: r for r in events.events_daily(readings).collect()}
    assert rows[1].count_wake == 2 and rows[1].count_rem is None
    assert rows[1].mean_bpm_peak_postprandial_start is None
    assert rows[3].count_meal_return_baseline == 1


def test_participant_with_other_labels_only_keeps_a_row(readings):
    rows = events.events_daily(readings.filter("event = 'odd'")).collect()
    assert len(rows) == 1 and all(v is None for v in rows[0][2:])


def test_long_counts_add_up_to_wide_counts(fixed):
    long = events.events_detail(fixed).groupBy().sum("count_").first()[0]
    wide = events.events_daily(fixed).first()
    rows = events.events_daily(fixed).collect()
    assert long == sum(r[f"count_{e}"] or 0 for r in rows for e in EVENT_LABELS) and wide is not None


def test_output_schemas(fixed):
    assert conform(events.events_detail(fixed), EVENTS_DETAIL).columns == [f["name"] for f in EVENTS_DETAIL]
    assert conform(events.events_daily(fixed), EVENTS_DAILY).count() == events.events_daily(fixed).count()


def test_range_of_run_dates_equals_single_ones(hr, sleeps, detail, meals, readings):
    ranged = events.event_readings(hr(READINGS), sleeps, detail, meals, "2021-05-01", "2021-05-09")
    everything = events.event_readings(hr(READINGS), sleeps, detail, meals)
    assert labels(ranged) == labels(readings) and {str(r.ds) for r in ranged.collect()} == {DS}
    assert labels(everything) == labels(readings)


def test_flags_keep_copies_and_unmatched_sides(hr, sleeps, detail):
    rows = events.sleep_bpm_flags(hr(READINGS), sleeps, detail, DS).collect()
    got = sorted((r.bpm, r.sleep_stage or "", r.sleep_start_10mins or 0) for r in rows)
    # The stage is stored twice and the reading 71 twice: four rows.
    assert got == [(70, "", 1)] + [(71, "wake", 1)] * 4 + [(73, "wake", 0)] * 2 + [(75, "odd", 0)]


def test_meal_form_reads_the_run_date_only(hr, make):
    meals = make([(1, f"{DS} 23:59:00", f"{DS} 23:30:00", None)], MEALS)
    frame = hr([(1, f"{DS} 23:59:30", 60), (1, "2021-05-05 00:01:00", 61)])
    rows = events.meal_readings(frame, meals, DS).collect()
    assert [(r.bpm, r.meal_event) for r in rows] == [(60, "meal_start")]


def test_stage_of_extreme_length(hr, sleeps, make):
    detail = make([(1, "2021-05-03 06:38:30", 4_000_000_000, "deep")], DETAIL)
    rows = events.sleep_stage_readings(hr(READINGS), sleeps, detail, DS).collect()
    assert sorted(r.bpm for r in rows) == [71, 73, 74, 75, 76, 80, 81, 82, 83]


def test_duration_form(readings):
    rows = events.events_detail(readings, with_duration=True).collect()
    assert {r.duration for r in rows if r.event == "wake"} == {11}


def test_features_need_no_listed_readings(hr, sleeps, detail, meals):
    for strict in (True, False):
        rows = events.event_readings(hr(READINGS), sleeps, detail, meals, DS, strict=strict)
        intervals = events.event_intervals(sleeps, detail, meals, DS, strict=strict)
        straight = events.detail_of(hr(READINGS), intervals, DS, with_duration=True)
        assert straight.schema == events.events_detail(rows, with_duration=True).schema
        assert sorted(map(str, straight.collect())) == sorted(map(str, events.events_detail(rows, with_duration=True).collect()))
        daily = events.daily_of(hr(READINGS), intervals, DS)
        assert daily.dtypes == events.events_daily(rows).dtypes
        assert sorted(map(str, daily.collect())) == sorted(map(str, events.events_daily(rows).collect()))


def test_features_of_rates_with_fractions(make, sleeps, detail):
    frame = make([(1, "2021-05-03 06:39:00", 70.5)], "pim_id bigint,heart_rate_datetime_loc timestamp_ntz,bpm double")
    rows = events.detail_of(frame, events.sleep_intervals(sleeps, detail, DS), DS).collect()
    assert {(r.event, r.mean_bpm, r.count_) for r in rows} == {("wake", 70.5, 1), ("bedtime_start", 70.5, 1)}


def test_stage_meets_a_run_date_once(detail, make):
    sleeps = make([(1, "2021-05-03", f"2021-05-03 06:{m:02d}:00", "2021-05-03 09:30:00") for m in range(30)] * 2, SLEEPS)
    rows = events.stage_event_intervals(sleeps, detail, DS).collect()
    assert sorted(r.event for r in rows) == ["deep", "odd", "wake"]


def test_flags_hold_counts_not_lists(hr, make):
    sleeps = make([(1, "2021-05-03", "2021-05-03 06:30:00", "2021-05-03 07:30:00")] * 5, SLEEPS)
    detail = make([(1, "2021-05-03 06:31:00", 600, s) for s in ("WAKE", "wake", "deep")] * 4, DETAIL)
    rows = events.sleep_bpm_flags(hr([(1, "2021-05-03 06:32:00", 70)] * 3), sleeps, detail, DS)
    got = {(r.sleep_stage, r.sleep_start_10mins): r["count"] for r in rows.groupBy("sleep_stage", "sleep_start_10mins").count().collect()}
    # copies * stages in their sessions * starts
    assert got == {("wake", 1): 3 * 8 * 5 * 5, ("deep", 1): 3 * 4 * 5 * 5}
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "_times" in plan
