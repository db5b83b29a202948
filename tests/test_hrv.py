"""Heart-rate variability against hand-worked cases and a plain restatement."""

import math
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta
from statistics import mean, stdev

import pytest

from pulsewright.operators.heartbeat import consecutive_readings, weighted_readings
from pulsewright.plans import hrv

DAY = "2024-01-01"


def at(seconds, bpms, pim=1, step=1, day=DAY):
    start = datetime.fromisoformat(day) + timedelta(seconds=seconds)
    return [(pim, str(start + timedelta(seconds=i * step)), b) for i, b in enumerate(bpms)]


def one(rows):
    assert len(rows) == 1
    return rows[0]


# --- hand-worked cases -------------------------------------------------------


def test_tinn_with_one_mode(hr):
    row = one(hrv.tinn_features(hr(at(0, [64, 62, 60, 60, 60, 60, 58])), [1]).collect())
    assert row.tinn == pytest.approx(166.666667, abs=1e-6)
    assert row.rrtri == 1.75 and row.modes == 1


def test_histogram_bins(hr):
    rows = hrv.nn_histogram(hr(at(0, [64, 62, 60, 60, 60, 60, 58])), [1]).collect()
    assert {r.bin * 31.25: r.frequency for r in rows} == {937.5: 2, 1000.0: 4, 1031.25: 1}


def test_tinn_with_one_bin_is_absent(hr):
    frame = hr(at(0, [60] * 5))
    assert hrv.tinn_features(frame, [1]).count() == 0
    row = one(hrv.hrv_bucket(frame).collect())
    assert row.tinn is None and row.rrtri is None and row.beat_interval_ms_stddev == 0.0


def test_tied_modes_repeat_the_row(hr):
    frame = hr(at(0, [60, 60, 62, 62, 58, 66]))
    rows = hrv.hrv_bucket(frame).collect()
    assert len(rows) == 2 and rows[0] == rows[1]
    assert rows[0].tinn == pytest.approx(437.5) and rows[0].rrtri == 3.0
    assert one(hrv.hrv_daily(frame).collect()).tinn == pytest.approx(437.5)


def test_windows_run_before_distinct(hr):
    frame = hr([(1, f"{DAY} 00:00:00", 60), (1, f"{DAY} 00:00:00", 60), (1, f"{DAY} 00:00:01", 70)])
    rows = consecutive_readings(frame).collect()
    assert sorted((r.bpm, r.prev_bpm or 0) for r in rows) == [(60, 0), (60, 60), (70, 60)]


def test_repeats_after_an_equal_rate_merge(hr):
    frame = hr(at(0, [60]) + at(1, [60]) * 3)
    rows = consecutive_readings(frame).collect()
    assert sorted((r.bpm, r.prev_bpm or 0) for r in rows) == [(60, 0), (60, 60)]
    weights = weighted_readings(frame).collect()
    assert sum(r.weight for r in weights) == 4


def test_twelve_hour_bucket(hr):
    frame = hr(at(0, [60, 61], day="2021-06-12 16:07:31"))
    rows = hrv.hrv_x_hour(frame, hours=(12,)).collect()
    assert str(one(rows).start_time_local) == "2021-06-12 12:00:00"
    assert str(rows[0].ds) == "2021-06-13" and rows[0].hrv_type == "12 hour"
    assert str(rows[0].end_time_local) == "2021-06-13 00:00:00"


def test_previous_reading_crosses_slices_and_hours_but_not_days(hr):
    frame = hr(at(10, [60]) + at(4000, [70]) + at(86390, [80]) + at(86400 + 5, [90]) + [(2, f"{DAY} 05:00:00", 50)])
    got = {(r.pim_id, r.bpm): r.prev_bpm for r in consecutive_readings(frame).collect()}
    assert got == {(1, 60): None, (1, 70): 60, (1, 80): 70, (1, 90): None, (2, 50): None}


def test_single_value_has_no_spread(hr):
    row = one(hrv.hrv_bucket(hr(at(0, [60, 62]))).collect())
    assert row.record_count == 1 and row.bpm_stddev is None and row.geom_poincare_sd1 is None


def test_low_and_missing_rates_are_left_out(hr):
    frame = hr(at(0, [60, 39, None, 62]))
    assert [r.prev_bpm for r in consecutive_readings(frame).collect() if r.bpm == 62] == [60]


# --- restatement over plain rows ---------------------------------------------


def beat(bpm):
    return 60000.0 / bpm


def sd(values):
    return stdev(values) if len(values) > 1 else None


def pairs_of(rows):
    """Per (pim, day): stored pairs in order, and the day's mean interval."""
    days = defaultdict(list)
    for pim, ts, bpm in rows:
        if bpm is not None and bpm >= 40:
            days[pim, ts[:10]].append((ts, bpm))
    out = {}
    for key, readings in days.items():
        readings.sort()
        stored = [(t, b, readings[i - 1][1] if i else None) for i, (t, b) in enumerate(readings)]
        out[key] = stored, mean(beat(b) for _, b, _ in stored)
    return out


def floor_to(ts, seconds):
    t = datetime.fromisoformat(ts)
    base = datetime(1970, 1, 1)
    return base + timedelta(seconds=int((t - base).total_seconds()) // seconds * seconds)


def expected_buckets(rows, hours):
    out = []
    for (pim, _), (stored, avg_rr) in pairs_of(rows).items():
        groups = defaultdict(list)
        for row in sorted(set(stored), key=str):
            groups[floor_to(row[0], hours * 3600)].append(row)
        for start, members in groups.items():
            paired = [m for m in members if m[2] is not None]
            if not paired:
                continue
            slices = defaultdict(list)
            for t, b, _ in members:
                slices[floor_to(t, 300)].append(beat(b))
            hist = Counter(math.floor(round(beat(b) * 10000) / 312500) for _, b, _ in members)
            top = max(hist.values())
            modes = [k for k, f in hist.items() if f == top]
            sums = {}
            for side, keep in (("l", lambda d: d <= 0), ("r", lambda d: d >= 0)):
                steps = [(k - m, f - top) for m in modes for k, f in hist.items() if keep(k - m)]
                sums[side] = sum(x * x for x, _ in steps), sum(x * y for x, y in steps)
            usable = all(sums["l"]) and all(sums["r"])
            slope = {s: v[1] / (31.25 * v[0]) for s, v in sums.items()} if usable else None
            row = (
                pim,
                start,
                len(paired),
                mean(b for _, b, _ in paired),
                sd([beat(b) for _, b, _ in paired]),
                math.sqrt(mean((beat(b) - beat(p)) ** 2 for _, b, p in paired)),
                sd([abs(beat(b) - beat(p)) / math.sqrt(2) for _, b, p in paired]),
                sd([abs(beat(b) + beat(p) - 2 * avg_rr) / math.sqrt(2) for _, b, p in paired]),
                top / slope["l"] - top / slope["r"] if usable else None,
                len(members) / top if usable else None,
                sd([mean(v) for v in slices.values()]),
            )
            out += [row] * (len(modes) if usable else 1)
    return out


def random_rows(seed, n=700):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        pim = rnd.choice([1, 1, 1, 2, 3])
        second = rnd.choice([rnd.randrange(86400), rnd.randrange(7200, 7800)])
        t = datetime(2024, 1, rnd.choice([1, 2])) + timedelta(seconds=second)
        rows.append((pim, str(t), rnd.choice([38, 55, 58, 60, 60, 61, 64, 90, 120])))
    return rows + rnd.choices(rows, k=n // 3)


COLUMNS = (
    "pim_id start_time_local record_count bpm_mean beat_interval_ms_stddev beat_interval_ms_rmssd "
    "geom_poincare_sd1 geom_poincare_sd2 tinn rrtri sdann"
).split()


def normal(rows):
    flat = [tuple("-" if v is None else f"{v:.6f}" if isinstance(v, float) else str(v) for v in r) for r in rows]
    return sorted(flat)


@pytest.mark.parametrize("seed", [1, 2])
def test_buckets_match_a_plain_restatement(hr, seed):
    rows = random_rows(seed)
    got = hrv.hrv_x_hour(hr(rows), hours=(1, 12))
    for hours in (1, 12):
        part = got.filter(f"hrv_type = '{hours} hour'").select(*COLUMNS).collect()
        want = [r[:2] + (r[2], float(r[3])) + r[4:] for r in expected_buckets(rows, hours)]
        assert normal(part) == normal(want)


def test_five_minutes_count_repeats(hr):
    rows = random_rows(5)
    got = hrv.hrv_5min(hr(rows)).collect()
    want = []
    for (pim, _), (stored, _) in pairs_of(rows).items():
        groups = defaultdict(list)
        for t, b, p in stored:
            if p is not None:
                groups[floor_to(t, 300)].append((b, p))
        for start, members in groups.items():
            values = [beat(b) for b, _ in members]
            want.append(
                (pim, start, float(mean(b for b, _ in members)), mean(values), sd(values), min(values), max(values),
                 math.sqrt(mean((beat(b) - beat(p)) ** 2 for b, p in members)))
            )
    names = ("participant_id datetime_local bpm_mean beat_interval_ms_mean beat_interval_ms_stddev "
             "beat_interval_ms_min beat_interval_ms_max beat_interval_ms_rmssd").split()
    assert normal([tuple(r[c] for c in names) for r in got]) == normal(want)


# --- invariants --------------------------------------------------------------


def test_record_counts_agree_across_widths(hr):
    totals = hrv.poincare_features(hr(random_rows(3)), (1, 3, 6, 12, 24)).groupBy("seconds").sum("record_count")
    assert len({r[1] for r in totals.collect()}) == 1


@pytest.mark.parametrize("pipeline", [hrv.hrv_daily, hrv.hrv_x_hour, hrv.hrv_5min])
def test_one_run_date_equals_its_part_of_all(hr, pipeline):
    frame = hr(random_rows(4))
    whole = pipeline(frame).filter("ds = '2024-01-02'")
    assert normal(whole.collect()) == normal(pipeline(frame, "2024-01-02").collect())


def test_combine_puts_the_run_date_first(hr):
    frame = hr(random_rows(6, 100))
    parts = [hrv.hrv_bucket(frame, hours=h) for h in (1, 3)]
    both = hrv.combine_hrv(parts, "2024-01-03")
    assert both.columns[0] == "ds" and both.count() == sum(p.count() for p in parts)


def test_daily_column_name(hr):
    frame = hr(at(0, [60, 61]))
    assert "eom_poincare_sd2" in hrv.hrv_daily(frame).columns
    assert "geom_poincare_sd2" in hrv.hrv_daily(frame, strict=False).columns


def test_day_form_columns(hr):
    got = hrv.hrv_bucket(hr(at(0, [60, 61])), hours=24)
    assert got.columns[:2] == ["ds", "participantid"] and len(got.columns) == 12
