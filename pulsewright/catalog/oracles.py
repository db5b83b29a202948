"""SQL equivalents of the registered queries for DuckDB."""

from __future__ import annotations

from pulsewright.catalog.queries import CORRECTED_DAY, DAY_BEFORE, LAST_DAY, WIDTHS
from pulsewright.plans.hrv import BUCKET_COLUMNS, SHAPE_COLUMNS
from pulsewright.plans.meals import METRICS
from pulsewright.sources.adapters import FRACTIONAL_BPM, SESSION_BACK, STAGE_CASE, ZONES
from pulsewright.sources.schemas import EVENT_LABELS, PERIOD_DATES, PERIODS, SLEEP_LABELS, ZONE_NAMES

PIM = "user_id % 10 as pim_id"
ZONE_ROWS = ", ".join(f"('{n}', {lo}, {hi})" for n, lo, hi in ZONES)

TABLES = {
    "heart_rate": f"""select {PIM}, ts as heart_rate_datetime_loc,
        cast(35 + floor(value) % 150 as bigint) as bpm from events""",
    "sleeps": f"""select {PIM}, cast(ts as date) as sleep_date_loc, ts - {SESSION_BACK} as start_time_loc,
        ts + interval '7' hour as end_time_loc from events where event_type = 'signup'""",
    "sleep_detail": f"""select {PIM}, ts as sleep_datetime_loc, 600 + 300 * (event_id % 20) as sleep_duration,
        {STAGE_CASE} as sleep_stage from events where event_type = 'view'""",
    "meal_events": f"""select {PIM}, ts as start_datetime_local,
        ts + cast(20 + event_id % 100 as int) * interval '1' minute as peak_datetime_local,
        ts + cast(50 + event_id % 100 + event_id % 180 as int) * interval '1' minute
            as return_to_baseline_datetime_local,
        50 + event_id % 100 + event_id % 180 as duration, 20 + event_id % 100 as time_to_peak,
        80 + value as peak_glucose, value / 2 as excursion_size
        from events where event_type = 'purchase'""",
    "resting_heart_rate": f"""select {PIM}, cast(45 + count(*) % 30 as double) as resting_heart_rate,
        cast(ts as date) as resting_heart_heart_date_loc from events group by 1, 3""",
    "heart_rate_zones": f"""select d.pim_id, d.dt as heart_rate_date_loc, z.name as heart_rate_zone,
        cast(z.lo as bigint) as min_bpm, cast(z.hi as bigint) as max_bpm
        from (select distinct {PIM}, cast(ts as date) as dt from events) d
        cross join (values {ZONE_ROWS}) z(name, lo, hi)""",
    "glycemic_features": f"""select {PIM}, cast(ts as date) as ds, avg(value) as mean_glucose
        from events group by 1, 2""",
    "individual_medications": """select distinct cast(user_id % 10 as varchar) as pim_id, cast(ts as date) as ds,
        cast((user_id % 10) % 4 = 0 as int) as insulin, cast((user_id % 10) % 4 = 2 as int) as biguanides,
        cast((user_id % 10) % 3 = 0 as int) as sulfonylureas from events
        where user_id % 2 = 0""",
    "valid": """select pim_id, heart_rate_datetime_loc as ts, cast(heart_rate_datetime_loc as date) as d, bpm
        from heart_rate where bpm >= 40""",
}

# Readings with their predecessor and the day's mean interval.
BEATS = {
    "beats": """select distinct pim_id, d, ts, bpm,
        lag(bpm) over (partition by pim_id, d order by ts, bpm) as prev,
        avg(60000.0 / bpm) over (partition by pim_id, d) as avg_rr from valid""",
}


def at(width: str, ts: str = "ts") -> str:
    """Start of the bucket of ``width`` seconds."""
    micros = f"(1000000 * cast({width} as bigint))"
    return f"make_timestamp(epoch_us({ts}) // {micros} * {micros})"


def with_(parts: dict[str, str], body: str) -> str:
    return "with " + ",\n".join(f"{k} as ({v})" for k, v in parts.items()) + "\n" + body


def rounded(body: str, doubles: list[str]) -> str:
    fixed = ", ".join(f"round({c}, 6) + 0.0 as {c}" for c in doubles)
    return f"select * replace ({fixed}) from ({body})"


def needs(*names: str) -> dict[str, str]:
    """Tables by name; ``valid`` brings the readings it is taken from."""
    wanted = [n for n in TABLES if n in names or (n == "heart_rate" and "valid" in names)]
    return {n: TABLES[n] for n in wanted}


def simple(tables: tuple[str, ...], body: str, doubles: list[str] | None = None) -> str:
    return with_(needs(*tables), rounded(body, doubles) if doubles else body)


STATS = {
    "mean_bpm": "avg(bpm)",
    "sd_bpm": "stddev_pop(bpm)",
    "min_bpm": "min(bpm)",
    "max_bpm": "max(bpm)",
    "count_": "count(bpm)",
}
STAT_LIST = ", ".join(f"{e} as {n}" for n, e in STATS.items())
MEANS = ["mean_bpm", "sd_bpm"]


def scans() -> dict[str, str]:
    day = f"date '{LAST_DAY}'"
    ds = f"{day} as ds, pim_id as participant_id"
    stream = "select pim_id, ts as datetime_local, bpm from valid where d > {day} - {n} and d <= {day}"
    roundtrip = f"""select pim_id, start_datetime_local, peak_datetime_local, return_to_baseline_datetime_local,
        duration, time_to_peak, peak_glucose, excursion_size from meal_events"""
    daily = f"select pim_id, d as date, {STAT_LIST} from valid group by pim_id, d"
    envelope = "'features' as source, 'daily' as type, 'sample' as referenceprojectid"
    joined = """select f.pim_id, f.ds, mean_glucose, insulin, biguanides, sulfonylureas
        from glycemic_features f join individual_medications m
        on f.pim_id = cast(m.pim_id as bigint) and f.ds = m.ds"""
    summary, summary_cols = hrv_summary_body(), ["mean_rmssd", "mean_sdrr"]
    means = "select pim_id, " + ", ".join(f"avg({m}) as {m}" for m in METRICS) + " from measures group by pim_id"
    return {
        "scan_bpm": simple(("valid",), f"select {ds}, d as datetime_local, bpm from valid where d between {day} - 13 and {day}"),
        "scan_resting": simple(
            ("resting_heart_rate",),
            f"""select {ds}, resting_heart_rate, resting_heart_heart_date_loc as datetime_local
            from resting_heart_rate where resting_heart_rate >= 40
            and resting_heart_heart_date_loc between {day} - 13 and {day}""",
            ["resting_heart_rate"],
        ),
        "scan_zones": simple(
            ("heart_rate_zones",),
            f"""select {ds}, heart_rate_date_loc as datetime_local,
            lower(replace(heart_rate_zone, ' ', '')) as heart_rate_zone, min_bpm, max_bpm from heart_rate_zones
            where min_bpm >= 40 and max_bpm >= 40 and heart_rate_date_loc between {day} - 13 and {day}""",
        ),
        "bpm_stream_2d": simple(("valid",), stream.format(day=day, n=2)),
        "bpm_stream_4d": simple(("valid",), stream.format(day=day, n=4)),
        "csv_roundtrip": simple(("meal_events",), roundtrip, ["peak_glucose", "excursion_size"]),
        "json_roundtrip": with_(
            {**needs("valid"), **PAIRS},
            rounded(f"select *, timestamp '2024-02-01 12:00:00' as batch_time from ({summary})", summary_cols),
        ),
        "partition_replace": simple(
            ("valid",), f"select pim_id, d as ds, {STAT_LIST} from valid group by pim_id, d", MEANS
        ),
        "clustered_files": simple(
            ("heart_rate",),
            """select count(*) as rows_read, 0 as unordered, 0 as overlapping_files, true as several_files,
            min(pim_id) as first_pim_id, max(pim_id) as last_pim_id from heart_rate""",
        ),
        "range_partition": simple(
            ("glycemic_features", "individual_medications"),
            f"select *, cast(insulin as bigint) as range_start from ({joined})",
            ["mean_glucose"],
        ),
        "conform_schema": with_({**needs("valid"), **PAIRS}, rounded(summary, summary_cols)),
        "cloud_event": simple(
            ("valid",), f"select 'application/json' as datacontenttype, {envelope}, * from ({daily})", MEANS
        ),
        "messages": with_(
            {**needs("meal_events"), **MEASURES},
            rounded(f"select *, 'kind' as header_key, 'meal' as header from ({means})", list(METRICS)),
        ),
        "published_rows": simple(("valid",), f"select {envelope}, * from ({daily})", MEANS),
        "run_job": simple(
            ("valid",),
            f"""select d as ds, pim_id, avg(bpm) as mean_bpm, stddev_pop(bpm) as sd_bpm,
            cast(min(bpm) as double) as min_bpm, cast(max(bpm) as double) as max_bpm,
            cast(count(bpm) as double) as count_ from valid group by pim_id, d""",
            MEANS,
        ),
        "cohort_filter": simple(
            ("heart_rate", "individual_medications"),
            """select * from heart_rate
            where pim_id in (select cast(pim_id as bigint) from individual_medications)""",
        ),
        "daily_bpm_stats": simple(("valid",), daily, MEANS),
        "outer_fold": simple(
            ("valid", "resting_heart_rate", "meal_events"),
            """select participant_id, mean_bpm, count_, mean_resting_bpm, max_resting_bpm, mean_glucose, sd_glucose
            from (select pim_id as participant_id, avg(bpm) as mean_bpm, count(bpm) as count_ from valid group by 1)
            full join (select pim_id as participant_id, avg(resting_heart_rate) as mean_resting_bpm,
                max(resting_heart_rate) as max_resting_bpm from resting_heart_rate group by 1) using (participant_id)
            full join (select pim_id as participant_id, avg(peak_glucose) as mean_glucose,
                stddev_samp(peak_glucose) as sd_glucose from meal_events group by 1) using (participant_id)""",
            ["mean_bpm", "mean_resting_bpm", "max_resting_bpm", "mean_glucose", "sd_glucose"],
        ),
        "glycemic_medications": simple(("glycemic_features", "individual_medications"), joined, ["mean_glucose"]),
    }


# --- heart-rate variability --------------------------------------------------

PAIRS = {
    "pairs": """select pim_id, d, ts, bpm, lag(bpm) over (partition by pim_id, d order by ts, bpm) as prev
        from valid""",
}


def hrv_5min_body() -> str:
    return f"""select d as ds, pim_id as participant_id, {at('300')} as datetime_local, avg(bpm) as bpm_mean,
        avg(60000.0 / bpm) as beat_interval_ms_mean, stddev_samp(60000.0 / bpm) as beat_interval_ms_stddev,
        min(60000.0 / bpm) as beat_interval_ms_min, max(60000.0 / bpm) as beat_interval_ms_max,
        sqrt(avg(power(60000.0 / bpm - 60000.0 / prev, 2))) as beat_interval_ms_rmssd
        from pairs where prev is not null group by 1, 2, 3"""


def hrv_summary_body() -> str:
    return f"""select ds, participant_id as pim_id, avg(beat_interval_ms_rmssd) as mean_rmssd,
        avg(beat_interval_ms_stddev) as mean_sdrr from ({hrv_5min_body()}) group by 1, 2"""


FIVE_MINUTE_DOUBLES = ["bpm_mean"] + [f"beat_interval_ms_{s}" for s in ("mean", "stddev", "min", "max", "rmssd")]

KEY = "pim_id, d, hours, start"


def bucket_parts(hours: tuple[int, ...]) -> dict[str, str]:
    """Statistics of all buckets in ``features``, tied modes as extra rows."""
    widths = ", ".join(f"({h})" for h in hours)
    return {
        **needs("valid"),
        **BEATS,
        "placed": f"""select b.*, w.hours, {at('(3600 * w.hours)')} as start, {at('300')} as slice
            from beats b cross join (values {widths}) w(hours)""",
        "pair_stats": f"""select {KEY}, count(*) as record_count, avg(bpm) as bpm_mean,
            stddev_samp(bpm) as bpm_stddev, min(bpm) as bpm_min, max(bpm) as bpm_max,
            avg(60000.0 / bpm) as beat_interval_ms_mean, stddev_samp(60000.0 / bpm) as beat_interval_ms_stddev,
            min(60000.0 / bpm) as beat_interval_ms_min, max(60000.0 / bpm) as beat_interval_ms_max,
            sqrt(avg(power(60000.0 / bpm - 60000.0 / prev, 2))) as beat_interval_ms_rmssd,
            stddev_samp(abs(60000.0 / bpm - 60000.0 / prev) / sqrt(2)) as geom_poincare_sd1,
            stddev_samp(abs(60000.0 / prev + 60000.0 / bpm - 2 * avg_rr) / sqrt(2)) as geom_poincare_sd2
            from placed where prev is not null group by {KEY}""",
        "hist": f"""select {KEY}, 31.25 * floor(round(60000.0 / bpm * 10000) / 312500) as bin, count(*) as f
            from placed group by {KEY}, bin""",
        "modes": f"""select * from hist qualify f = max(f) over (partition by {KEY})""",
        "offsets": f"""select {KEY}, h.bin - m.bin as dx, h.f - m.f as dy
            from hist h join (select {KEY}, bin, f from modes) m using ({KEY})""",
        "slopes": f"""select {KEY},
            sum(dx * dy) filter (dx <= 0) / nullif(sum(dx * dx) filter (dx <= 0), 0) as sl,
            sum(dx * dy) filter (dx >= 0) / nullif(sum(dx * dx) filter (dx >= 0), 0) as sr
            from offsets group by {KEY}""",
        "triangles": f"""select {KEY}, (m.bin - m.f / sr) - (m.bin - m.f / sl) as tinn, t.n / m.f as rrtri
            from modes m join slopes using ({KEY})
            join (select {KEY}, sum(f) as n from hist group by {KEY}) t using ({KEY})
            where sl <> 0 and sr <> 0""",
        "slice_spread": f"""select {KEY}, stddev_samp(m) as sdann, count(*) as record_count
            from (select {KEY}, slice, avg(60000.0 / bpm) as m from placed group by {KEY}, slice) group by {KEY}""",
        "features": f"""select {KEY}, p.* exclude ({KEY}), tinn, rrtri, sdann from pair_stats p
            left join triangles using ({KEY}) left join (select {KEY}, sdann from slice_spread) s using ({KEY})""",
    }


BUCKET_DOUBLES = [c for c in BUCKET_COLUMNS if c not in ("record_count", "bpm_min", "bpm_max")]


def bucket_rows() -> str:
    cols = ", ".join(BUCKET_COLUMNS)
    return f"""select d, pim_id, hours || ' hour' as hrv_type, start as start_time_local,
        start + to_hours(hours) as end_time_local, {cols} from features"""


def hrv() -> dict[str, str]:
    parts = bucket_parts(WIDTHS)
    body = bucket_rows()
    key = "pim_id, d as date, hours, start"
    day = bucket_parts((24,))
    shape = ", ".join(SHAPE_COLUMNS)
    out = {
        "consecutive_beats": with_(
            {**needs("valid"), **BEATS},
            rounded(
                """select pim_id, d as date, ts as heart_rate_datetime_loc, bpm, prev as prev_bpm, avg_rr from beats""",
                ["avg_rr"],
            ),
        ),
        "rmssd_poincare": with_(
            {**needs("valid"), **BEATS},
            rounded(
                """select pim_id, d as date, stddev_samp(60000.0 / bpm) as interval_sd,
                sqrt(avg(power(60000.0 * (1.0 / bpm - 1.0 / prev), 2))) as rmssd,
                stddev_samp(abs(60000.0 / bpm - 60000.0 / prev) / sqrt(2)) as sd1,
                stddev_samp(abs(60000.0 / bpm + 60000.0 / prev - 2 * avg_rr) / sqrt(2)) as sd2
                from beats group by pim_id, d""",
                ["interval_sd", "rmssd", "sd1", "sd2"],
            ),
        ),
        "sdann": with_(parts, rounded(f"select {key}, sdann, record_count from slice_spread", ["sdann"])),
        "nn_histogram": with_(parts, f"select {key}, cast(bin as double) as bin_start, f as frequency from hist"),
        "nn_modes": with_(parts, f"select {key}, cast(bin as double) as bin_start, f as frequency from modes"),
        "tinn_rrtri": with_(
            parts,
            rounded(
                f"select {key}, any_value(tinn) as tinn, any_value(rrtri) as rrtri, count(*) as modes from triangles group by all",
                ["tinn", "rrtri"],
            ),
        ),
        "hrv_5min": with_({**needs("valid"), **PAIRS}, rounded(hrv_5min_body(), FIVE_MINUTE_DOUBLES)),
        "hrv_summary": with_({**needs("valid"), **PAIRS}, rounded(hrv_summary_body(), ["mean_rmssd", "mean_sdrr"])),
        "hrv_x_hour": with_(
            parts, rounded(f"select d + 1 as ds, * exclude (d) from ({body})", BUCKET_DOUBLES)
        ),
        "combine_hrv": with_(
            parts, rounded(f"select date '{LAST_DAY}' as ds, * exclude (d) from ({body})", BUCKET_DOUBLES)
        ),
        "hrv_24h": with_(
            day, rounded(f"select d as ds, pim_id as participantid, {shape} from features", list(SHAPE_COLUMNS))
        ),
        "hrv_daily": with_(
            {
                **day,
                "slices": f"""select d, pim_id, {at('300')} as slice, stddev_samp(60000.0 / bpm) as sdrr,
                    sqrt(avg(power(60000.0 / bpm - 60000.0 / prev, 2))) as rmssd
                    from beats where prev is not null group by 1, 2, 3""",
            },
            rounded(
                "select a.ds, a.pim_id, mean_rmssd, mean_sdrr, b.* exclude (ds, pim_id) from "
                "(select d as ds, pim_id, avg(rmssd) as mean_rmssd, avg(sdrr) as mean_sdrr from slices group by 1, 2) a "
                "full join (select d as ds, pim_id, "
                + ", ".join(f"avg({c}) as {'eom_poincare_sd2' if c == 'geom_poincare_sd2' else c}" for c in SHAPE_COLUMNS)
                + " from features group by 1, 2) b on a.ds = b.ds and a.pim_id = b.pim_id",
                ["mean_rmssd", "mean_sdrr"]
                + ["eom_poincare_sd2" if c == "geom_poincare_sd2" else c for c in SHAPE_COLUMNS],
            ),
        ),
    }
    for h in WIDTHS:
        out[f"hrv_{h}h"] = with_(
            bucket_parts((h,)), rounded(f"select * exclude (d) from ({body})", BUCKET_DOUBLES)
        )
    return out


# --- events ------------------------------------------------------------------

SLEEP_PARTS = {
    "sessions": """select pim_id, sleep_date_loc + 1 as ds, sleep_date_loc, start_time_loc as s0, end_time_loc as s1
        from sleeps""",
    "stages": """select distinct pim_id, sleep_datetime_loc as g0,
        sleep_datetime_loc + to_seconds(sleep_duration - 1) as g1, sleep_stage from sleep_detail
        where sleep_stage is not null""",
    "staged": """select s.*, g0, g1, sleep_stage from sessions s
        join stages g on s.pim_id = g.pim_id and g0 between s0 and s1""",
}
STAGE_IV = "select ds, pim_id, g0 as lo, g1 as hi, g0 as t0, g1 as t1, lower(sleep_stage) as event from staged"


def after(moment: str, label: str, source: str, by: str | None = None) -> str:
    by = by or moment
    ten = "interval '10' minute"
    return f"select ds, pim_id, {by}, {by} + {ten}, {moment}, {moment} + {ten}, '{label}' from {source}"


BEDTIME_IV = after("s0", "bedtime_start", "sessions") + " union all " + after("s1", "bedtime_end", "sessions")
MEALS = {
    "meals": """select pim_id, cast(start_datetime_local as date) as ds, start_datetime_local as m0,
        peak_datetime_local as m1, return_to_baseline_datetime_local as m2 from meal_events"""
}


def meal_iv(strict: bool, baseline: bool = True) -> str:
    parts = [
        after("m0", "meal_start", "meals"),
        after("m1", "peak_postpandrial_start" if strict else "peak_postprandial_start", "meals"),
    ]
    if baseline:
        parts.append(after("m2", "meal_return_baseline", "meals", "m1" if strict else None))
    return " union all ".join(parts)


def labelled(intervals: str, days: int = 2) -> dict[str, str]:
    return {
        "iv": f"select * from ({intervals}) x(ds, pim_id, lo, hi, t0, t1, event)",
        "labelled": f"""select distinct iv.ds, r.pim_id, r.ts, r.bpm, t0, t1, date_diff('minute', t0, t1) as duration,
            event from valid r join iv on r.pim_id = iv.pim_id and r.ts between lo and hi
            and r.d between iv.ds - {days - 1} and iv.ds""",
    }


def reading_rows(participant: str, label: str, duration: bool = True) -> str:
    minutes = "duration, " if duration else ""
    return f"""select ds, pim_id as {participant}, ts as datetime_local, bpm, t0 as start_time, t1 as end_time,
        {minutes}event as {label} from labelled"""


def wide(labels: tuple[str, ...]) -> tuple[str, list[str]]:
    cols, doubles = [], []
    for label in labels:
        only = f"filter (event = '{label}')"
        for stat, expr in STATS.items():
            name = f"{stat.rstrip('_')}_{label}"
            value = f"nullif({expr} {only}, 0)" if stat == "count_" else f"{expr} {only}"
            cols.append(f"{value} as {name}")
            if stat in MEANS:
                doubles.append(name)
    return f"select ds, pim_id, {', '.join(cols)} from labelled group by ds, pim_id", doubles


def events() -> dict[str, str]:
    sleep = {**needs("valid", "sleeps", "sleep_detail"), **SLEEP_PARTS}
    everything = {**needs("valid", "sleeps", "sleep_detail", "meal_events"), **SLEEP_PARTS, **MEALS}
    strict = {**everything, **labelled(f"{STAGE_IV} union all {BEDTIME_IV} union all {meal_iv(True)}")}
    fixed = {**everything, **labelled(f"{STAGE_IV} union all {BEDTIME_IV} union all {meal_iv(False)}")}
    sleeping = {**sleep, **labelled(f"{STAGE_IV} union all {BEDTIME_IV}")}
    long = lambda labels, extra="": (
        f"select ds, pim_id, t0 as start_time, t1 as end_time, {extra}event, {STAT_LIST} from labelled "
        f"where event in ({', '.join(repr(x) for x in labels)}) group by all"
    )
    wide_all, wide_doubles = wide(EVENT_LABELS)
    wide_sleep, sleep_doubles = wide(SLEEP_LABELS)
    return {
        "stage_intervals": with_(
            sleep,
            """select ds, pim_id, sleep_date_loc, s0 as sleep_start_time, s1 as sleep_end_time,
            g0 as sleep_stage_start_loc, g1 as sleep_stage_end_loc, sleep_stage from staged""",
        ),
        "event_readings": with_(strict, reading_rows("participant_id", "event")),
        "event_readings_fixed": with_(fixed, reading_rows("participant_id", "event")),
        "sleep_bpm_flags": with_(
            sleep,
            """select r.ds, r.pim_id as participant_id, r.ts as datetime_local, r.bpm,
            lower(b.sleep_stage) as sleep_stage, c.flag as sleep_start_10mins
            from (select d + k as ds, valid.* from valid cross join (values (0), (1)) o(k)) r
            left join staged b on r.pim_id = b.pim_id and r.ds = b.ds and r.ts between b.g0 and b.g1
            left join (select *, 1 as flag from sessions) c on r.pim_id = c.pim_id and r.ds = c.ds
                and r.ts between c.s0 and c.s0 + interval '10' minute
            where b.sleep_stage is not null or c.flag = 1""",
        ),
        "sleep_stage_readings": with_(
            {**sleep, **labelled(STAGE_IV)},
            """select ds, pim_id, ts as datetime_local, bpm, t0 as sleep_stage_start_loc, t1 as sleep_stage_end_loc,
            event as sleep_stage from labelled""",
        ),
        "bedtime_readings": with_({**sleep, **labelled(BEDTIME_IV)}, reading_rows("pim_id", "sleep_event", False)),
        "sleep_readings": with_(sleeping, reading_rows("participant_id", "sleep_event")),
        "sleep_readings_4d": with_(
            {**sleep, **labelled(f"{STAGE_IV} union all {BEDTIME_IV}", 4)}, reading_rows("pim_id", "sleep_event")
        ),
        "meal_readings": with_(
            {**needs("valid", "meal_events"), **MEALS, **labelled(meal_iv(True, False), 1)},
            reading_rows("participant_id", "meal_event"),
        ),
        "events_detail": with_(strict, rounded(long(EVENT_LABELS), MEANS)),
        "events_detail_fixed": with_(fixed, rounded(long(EVENT_LABELS), MEANS)),
        "events_daily": with_(strict, rounded(wide_all, wide_doubles)),
        "events_daily_fixed": with_(fixed, rounded(wide_all, wide_doubles)),
        "sleep_events_detail": with_(sleeping, rounded(long(SLEEP_LABELS), MEANS)),
        "sleep_events_summary": with_(sleeping, rounded(wide_sleep, sleep_doubles)),
        "events_detail_duration": with_(sleeping, rounded(long(SLEEP_LABELS, "duration, "), MEANS)),
        "event_value_counts": with_(
            strict, f"select event, count(*) as count_ from ({long(EVENT_LABELS)}) group by event"
        ),
    }


# --- period features ---------------------------------------------------------


def fractional(sql: str) -> str:
    """The same over readings with fractions and NaN, of which the latter are no readings."""
    whole = "cast(35 + floor(value) % 150 as bigint) as bpm from events"
    return sql.replace(whole, f"{FRACTIONAL_BPM} as bpm from events").replace(
        "from heart_rate where bpm >= 40", "from heart_rate where bpm >= 40 and not isnan(bpm)"
    )


def bpm_features(dedupe: bool, only: str | None = None) -> str:
    """Every period of every run date on its own, then one row per run date."""
    spans = ", ".join(f"({n})" for n in PERIODS)
    runs = "select distinct d as ds from valid" + (f" where d = date '{only}'" if only else "")
    zone_cols = ", ".join(
        f"{fn}({fn}_bpm) filter (zone = '{z}') as {fn}_bpm_{z}" for z in ZONE_NAMES for fn in ("min", "max")
    )
    over = lambda table: f"from spans s join {table} r on r.d between s.ds - (s.n - 1) and s.ds group by s.ds, s.n, r.pim_id"
    parts = {
        **needs("valid", "resting_heart_rate", "heart_rate_zones"),
        "spans": f"select ds, n from ({runs}) cross join (values {spans}) p(n)",
        "readings": f"select {'distinct ' if dedupe else ''}pim_id, d, bpm from valid",
        "resting": """select distinct pim_id, resting_heart_heart_date_loc as d, resting_heart_rate as rate
            from resting_heart_rate where resting_heart_rate >= 40""",
        "zones": """select pim_id, heart_rate_date_loc as d, lower(replace(heart_rate_zone, ' ', '')) as zone,
            min_bpm, max_bpm from heart_rate_zones where min_bpm >= 40 and max_bpm >= 40""",
        "b": f"""select s.ds, s.n, r.pim_id, {STAT_LIST}, min(r.d) as earliest_bpm_date, max(r.d) as latest_bpm_date
            {over('readings')}""",
        "h": f"""select s.ds, s.n, r.pim_id, avg(rate) as mean_resting_bpm, stddev_pop(rate) as sd_resting_bpm,
            min(rate) as min_resting_bpm, max(rate) as max_resting_bpm {over('resting')}""",
        "z": f"select s.ds, s.n, r.pim_id, {zone_cols} {over('zones')}",
        "periods": """select *, n as days, ds - (n - 1) as period_start_date, ds as period_end_date
            from b full join h using (ds, n, pim_id) full join z using (ds, n, pim_id)""",
    }
    fields = list(STATS) + [f"{s}_resting_bpm" for s in ("mean", "sd", "min", "max")]
    fields += [f"{s}_bpm_{z}" for z in ZONE_NAMES for s in ("min", "max")]
    fields += ["days", "period_start_date", "period_end_date", "earliest_bpm_date", "latest_bpm_date"]
    cols = ", ".join(f"any_value({f}) filter (n = {n}) as p{n}_{f}" for n in PERIODS for f in fields)
    doubles = [f"p{n}_{f}" for n in PERIODS for f in fields if f.startswith(("mean_", "sd_")) or "resting" in f]
    return with_(parts, rounded(f"select ds, pim_id, {cols} from periods group by ds, pim_id", doubles))


def corrected(sql: str) -> str:
    """The same with a stricter validity cut on one day."""
    cut = lambda day: f"case when {day} = date '{CORRECTED_DAY}' then 100 else 40 end"
    for col, day in (
        ("where bpm", "cast(heart_rate_datetime_loc as date)"),
        ("where resting_heart_rate", "resting_heart_heart_date_loc"),
        ("where min_bpm", "heart_rate_date_loc"),
        ("and max_bpm", "heart_rate_date_loc"),
    ):
        sql = sql.replace(f"{col} >= 40", f"{col} >= {cut(day)}")
    return sql


def squeezed(sql: str) -> str:
    """The same over readings pressed into the first five minutes of their day."""
    day = 86_400_000_000
    pressed = f"make_timestamp(epoch_us(ts) - epoch_us(ts) % {day} + epoch_us(ts) % {day} // 288)"
    readings = TABLES["heart_rate"]
    return sql.replace(readings, readings.replace("ts as", f"{pressed} as"))


# --- meals -------------------------------------------------------------------

MEASURES = {
    "measures": """select pim_id, case when hour(start_datetime_local) between 1 and 6 then 'Sleep (0,6]'
        when hour(start_datetime_local) between 7 and 12 then 'Morning (6,12]'
        when hour(start_datetime_local) between 13 and 18 then 'Afternoon (12,18]' else 'Night (18,24]' end as time_range,
        cast(duration as double) as start_to_normal, cast(time_to_peak as double) as start_to_peak,
        cast(date_diff('minute', peak_datetime_local, return_to_baseline_datetime_local) as double) as peak_to_end,
        peak_glucose, excursion_size, excursion_size / (time_to_peak + 0.01) as excursion_rate from meal_events""",
}


def stacked(body: str, metrics: tuple[str, ...]) -> str:
    return " union all ".join(body.format(m=m) for m in metrics)


def meals() -> dict[str, str]:
    base = {**needs("meal_events"), **MEASURES}
    means = ", ".join(f"avg({m}) as {m}" for m in METRICS)
    summary = """select '{m}' as metric, count(*) as row_count, count(*) - count({m}) as null_count, avg({m}) as mean,
        stddev_samp({m}) as sd, min({m}) as min, max({m}) as max, quantile_cont({m}, 0.5) as median from %s"""
    spread = ["mean", "sd", "min", "max", "median"]
    ranges = "select '{m}' as metric, time_range, avg({m}) as mean, quantile_cont({m}, 0.5) as median from measures group by time_range"
    participants = {**base, "per_person": f"select pim_id, {means} from measures group by pim_id"}
    ranged = {**base, "per_range": f"select pim_id, time_range, {means} from measures group by pim_id, time_range"}
    bars = """select '{m}' as metric, i as bin, lo + i * step as bin_start, lo + (i + 1) * step as bin_end,
        count({m}) as frequency
        from (select min({m}) as lo, (max({m}) - min({m})) / 150.0 as step from measures)
        cross join range(150) r(i)
        left join measures on {m} >= lo + i * step and ({m} < lo + (i + 1) * step or i = 149)
        group by i, lo, step"""
    boxes = """select '{m}' as metric, time_range, q1, median, q3,
        min({m}) filter ({m} >= q1 - 1.5 * (q3 - q1)) as whisker_low,
        max({m}) filter ({m} <= q3 + 1.5 * (q3 - q1)) as whisker_high
        from measures join (select time_range, quantile_cont({m}, 0.25) as q1, quantile_cont({m}, 0.5) as median,
            quantile_cont({m}, 0.75) as q3 from measures group by time_range) using (time_range)
        group by time_range, q1, median, q3"""
    box_cols = ["q1", "median", "q3", "whisker_low", "whisker_high"]
    return {
        "meal_means": with_(base, rounded(f"select pim_id, {means} from measures group by pim_id", list(METRICS))),
        "meal_means_by_time": with_(
            base, rounded(f"select pim_id, time_range, {means} from measures group by pim_id, time_range", list(METRICS))
        ),
        "meal_describe": with_(base, rounded(stacked(summary % "measures", METRICS), spread)),
        "meal_describe_participants": with_(participants, rounded(stacked(summary % "per_person", METRICS), spread)),
        "meal_describe_by_time": with_(
            base,
            rounded(
                stacked(
                    (summary % "measures group by time_range").replace("as metric,", "as metric, time_range,"), METRICS
                ),
                spread,
            ),
        ),
        "meal_by_time_range": with_(base, rounded(stacked(ranges, METRICS), ["mean", "median"])),
        "meal_histogram": with_(base, rounded(stacked(bars, METRICS), ["bin_start", "bin_end"])),
        "meal_box": with_(base, rounded(stacked(boxes, METRICS), box_cols)),
        "meal_histogram_participants": with_(
            participants, rounded(stacked(bars.replace("measures", "per_person"), METRICS), ["bin_start", "bin_end"])
        ),
        "meal_box_participants": with_(
            ranged, rounded(stacked(boxes.replace("measures", "per_range"), METRICS), box_cols)
        ),
        "meal_by_time_range_participants": with_(
            ranged, rounded(stacked(ranges.replace("measures", "per_range"), METRICS), ["mean", "median"])
        ),
        "excursion_rate": with_(
            base,
            rounded(
                """select time_range, avg(excursion_rate) as mean, quantile_cont(excursion_rate, 0.5) as median
                from measures group by time_range""",
                ["mean", "median"],
            ),
        ),
        "describe_by_participant": with_(
            base,
            rounded(
                "select pim_id, * exclude (pim_id, metric) from ("
                + (summary.format(m="peak_glucose") % "measures").replace("select", "select pim_id,", 1)
                + " group by pim_id)",
                spread,
            ),
        ),
    }


# --- stored tables, single run dates, small operators ------------------------

STAMP = "timestamp '2024-02-01 12:00:00' as batch_time"


def skipped_run_dates() -> str:
    """Run dates within the longest period of some data, without readings on the day."""
    days = "select pim_id, d from valid where pim_id is not null"
    days += " union select pim_id, resting_heart_heart_date_loc from resting_heart_rate where resting_heart_rate >= 40"
    days += " union select pim_id, heart_rate_date_loc from heart_rate_zones where min_bpm >= 40 and max_bpm >= 40"
    return with_(
        {**needs("valid", "resting_heart_rate", "heart_rate_zones"), "days": days},
        f"""select ds, count(*) as participants from (
            select distinct d + cast(k as int) as ds, pim_id from days cross join range({max(PERIODS)}) r(k))
        where ds not in (select d from valid) group by ds""",
    )


def as_floats(sql: str, keep: str = "ds, pim_id") -> str:
    """Every column but the named ones as a double."""
    return f"select {keep}, {STAMP}, cast(columns(* exclude ({keep})) as double) from ({sql})"


def replaced(first: str, second: str) -> str:
    """The table after the last day is written again with other rows."""
    day = f"date '{LAST_DAY}'"
    return f"select * from ({first}) where ds <> {day} union all by name select * from ({second}) where ds = {day}"


def tables() -> dict[str, str]:
    dates = ", ".join(f"p{n}_{d}" for n in PERIODS for d in PERIOD_DATES)
    flat = lambda sql: as_floats(sql, f"ds, pim_id, {dates}")
    event = events()
    detail = lambda name: as_floats(event[name], "ds, pim_id, start_time, end_time, event")
    strict_day = bpm_features(True, LAST_DAY).replace(">= 40", ">= 100")
    return {
        "bpm_table": replaced(flat(bpm_features(True)), flat(strict_day)),
        "bpm_ndjson": flat(bpm_features(True, LAST_DAY)),
        "events_detail_table": replaced(detail("events_detail"), detail("events_detail_fixed")),
        "events_daily_table": replaced(as_floats(event["events_daily"]), as_floats(event["events_daily_fixed"])),
    }


def reruns() -> dict[str, str]:
    """Days and ranges replaced as named, without rows for one of them."""
    kept = f"select * from valid where d < date '{DAY_BEFORE}' or d > date '{LAST_DAY}' or d = date '{DAY_BEFORE}' and bpm >= 100"
    stats = f"select pim_id, d as ds, {STAT_LIST} from ({kept}) group by pim_id, d"
    return {
        "partition_emptied": simple(("valid",), stats, MEANS),
        "run_job_emptied": simple(
            ("valid",), f"select ds, pim_id, cast(columns(* exclude (ds, pim_id)) as double) from ({stats})", MEANS
        ),
        "range_replace": simple(
            ("glycemic_features", "individual_medications"),
            """select f.pim_id, f.ds, mean_glucose + cast(insulin + 2 * biguanides = 0 as int) as mean_glucose,
            insulin, biguanides, sulfonylureas, insulin + 2 * biguanides as level,
            cast(insulin + 2 * biguanides as bigint) as range_start
            from glycemic_features f join individual_medications m
            on f.pim_id = cast(m.pim_id as bigint) and f.ds = m.ds where insulin + 2 * biguanides <> 1""",
            ["mean_glucose"],
        ),
    }


def one_day() -> dict[str, str]:
    day = lambda sql: f"select * from ({sql}) where ds = date '{LAST_DAY}'"
    names = {**hrv(), **events()}
    wanted = ("hrv_daily", "hrv_x_hour", "event_readings", "events_daily", "sleep_readings", "sleep_stage_readings", "sleep_bpm_flags")
    return {f"{n}_ds": day(names[n]) for n in wanted}


def small() -> dict[str, str]:
    meals_ = "select * from meal_events"
    doubles = ["peak_glucose", "excursion_size"]
    return {
        "guarded_readings": simple(("heart_rate",), "select * from heart_rate"),
        "sorted_meals": simple(("meal_events",), meals_, doubles),
        "first_meals": simple(
            ("meal_events",),
            f"""{meals_} order by pim_id, start_datetime_local, duration, time_to_peak, peak_glucose, excursion_size limit 25""",
            doubles,
        ),
        "unplaced_readings": simple(
            ("heart_rate",),
            """select count_if(pim_id is null) as no_participant, count_if(ts is null) as no_time from
            (select nullif(pim_id, 3) as pim_id, case when bpm = 77 then null else heart_rate_datetime_loc end as ts, bpm
             from heart_rate) where bpm >= 40""",
        ),
    }


def all_oracles() -> dict[str, str]:
    return {
        **scans(),
        **hrv(),
        **events(),
        "bpm_features": bpm_features(True, LAST_DAY),
        "bpm_features_backfill": bpm_features(True),
        "bpm_features_nodedupe": bpm_features(False),
        "bpm_features_fractional": fractional(bpm_features(True)),
        "bpm_features_fractional_nodedupe": fractional(bpm_features(False)),
        **{f"dense_{n.removeprefix('consecutive_')}": squeezed(hrv()[n]) for n in ("consecutive_beats", "hrv_daily", "hrv_5min")},
        "bpm_features_incremental": bpm_features(True, LAST_DAY),
        "bpm_features_corrected": corrected(bpm_features(True)),
        "bpm_features_fractional_incremental": fractional(bpm_features(True)),
        "bpm_features_cleaned": fractional(bpm_features(True)),
        "nan_readings": fractional(scans()["daily_bpm_stats"]),
        "skipped_run_dates": skipped_run_dates(),
        **meals(),
        **tables(),
        **reruns(),
        **one_day(),
        **small(),
    }
