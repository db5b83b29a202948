"""Heart rate during sleep and meal events.

Every event kind becomes rows of one interval table; a single interval join
labels the readings of all kinds and all run dates at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsewright.functions.rundates import RunDates
from pulsewright.functions.stats import BPM_METRICS, METRICS, exact_variance_pop
from pulsewright.functions.timeops import between_days, minute_boundaries, plus_seconds
from pulsewright.operators.heartbeat import TS
from pulsewright.operators.intervals import BUCKET, SALT, interval_moments, merged_intervals, points_in_intervals
from pulsewright.operators.relational import union_all, valid_bpm
from pulsewright.sources.schemas import EVENT_LABELS, SLEEP_LABELS

PIM = "pim_id"
Day = str | date | None

# Length of the windows that follow a moment, in seconds, and the
# two spellings of the peak label (the first is the one readings carry).
WINDOW_SECONDS = 600
PEAK_READING_LABEL = "peak_postpandrial_start"
PEAK_FEATURE_LABEL = "peak_postprandial_start"

SESSION_BUCKET_SECONDS = 3600


# --- intervals ---------------------------------------------------------------


def sleep_sessions(sleeps: DataFrame, runs: RunDates) -> DataFrame:
    """Sessions with the run date that handles them: the day after."""
    return runs.scan(sleeps, "sleep_date_loc", lag=1).select(
        PIM,
        F.date_add("sleep_date_loc", 1).alias("ds"),
        "sleep_date_loc",
        F.col("start_time_loc").alias("sleep_start_time"),
        F.col("end_time_loc").alias("sleep_end_time"),
    )


def sleep_stages(
    detail: DataFrame, since: Day = None, distinct: bool = True, sleeps: DataFrame | None = None, runs: RunDates | None = None
) -> DataFrame:
    """Sleep stages with their last second. ``since`` narrows the scan.

    For a range of run dates the scan is bound by the sessions that ``runs``
    selects from ``sleeps``: a stage outside them joins none of them. Their bounds
    are known when the job runs and reach the scan.
    """
    if since is not None:
        detail = between_days(detail, "sleep_datetime_loc", RunDates.of(since).first, None)
    if sleeps is not None and runs is not None and (runs.first or runs.last):
        sessions = sleep_sessions(sleeps, runs)
        at = F.col("sleep_datetime_loc")
        first = sessions.agg(F.min("sleep_start_time")).scalar()
        last = sessions.agg(F.max("sleep_end_time")).scalar()
        detail = detail.filter((at >= first) & (at <= last))
    stages = detail.filter(F.col("sleep_stage").isNotNull()).select(
        PIM,
        F.col("sleep_datetime_loc").alias("sleep_stage_start_loc"),
        plus_seconds(F.col("sleep_datetime_loc"), F.col("sleep_duration") - 1).alias("sleep_stage_end_loc"),
        "sleep_stage",
    )
    return stages.distinct() if distinct else stages


def sleep_stage_intervals(
    sleeps: DataFrame,
    detail: DataFrame,
    ds: Day = None,
    ds_to: Day = None,
    since: Day = None,
    distinct: bool = True,
) -> DataFrame:
    """Stages that start inside a session of the same participant."""
    runs = RunDates.of(ds, ds_to)
    stages = sleep_stages(detail, since, distinct, sleeps, runs)
    spread = None
    if not distinct:  # copies of a stage spread over the salts
        stages, spread = stages.withColumn("_copy", F.monotonically_increasing_id()), F.col("_copy")
    pairs = points_in_intervals(
        stages,
        sleep_sessions(sleeps, runs),
        PIM,
        at="sleep_stage_start_loc",
        lo="sleep_start_time",
        hi="sleep_end_time",
        bucket_seconds=SESSION_BUCKET_SECONDS,
        spread=spread,
    )
    return pairs.select(
        "ds",
        PIM,
        "sleep_date_loc",
        "sleep_start_time",
        "sleep_end_time",
        "sleep_stage_start_loc",
        "sleep_stage_end_loc",
        "sleep_stage",
    )


def _interval(lo: Column, hi: Column, start: Column, end: Column, label: Column) -> Column:
    return F.struct(
        lo.alias("match_lo"), hi.alias("match_hi"), start.alias("start_time"), end.alias("end_time"), label.alias("event")
    )


def _after(moment: str, label: str, matched_at: str | None = None) -> Column:
    """The window after a moment; it may select by another moment's window."""
    m, by = F.col(moment), F.col(matched_at or moment)
    return _interval(by, plus_seconds(by, WINDOW_SECONDS), m, plus_seconds(m, WINDOW_SECONDS), F.lit(label))


EVENT_KEYS = ["ds", PIM, "start_time", "end_time", "event"]


def _exploded(df: DataFrame, intervals: Sequence[Column]) -> DataFrame:
    return df.select("ds", PIM, F.explode(F.array(*intervals)).alias("iv")).select("ds", PIM, "iv.*")


def stage_event_intervals(sleeps: DataFrame, detail: DataFrame, ds: Day = None, ds_to: Day = None, since: Day = None) -> DataFrame:
    """Stages that start inside some session of the run date, once each.

    Which session does not matter here, so the sessions of a person's run date that overlap
    are one where they meet stages, and a stage meets a run date once however many sessions
    hold it (once more for each further width of buckets, if some sessions last over two days;
    whoever reads the intervals folds them).
    """
    runs = RunDates.of(ds, ds_to)
    met = points_in_intervals(
        sleep_stages(detail, since, True, sleeps, runs),
        sleep_sessions(sleeps, runs),
        PIM,
        at="sleep_stage_start_loc",
        lo="sleep_start_time",
        hi="sleep_end_time",
        bucket_seconds=SESSION_BUCKET_SECONDS,
        fold=["ds"],
    )
    start, end = F.col("sleep_stage_start_loc"), F.col("sleep_stage_end_loc")
    return met.select("ds", PIM, _interval(start, end, start, end, F.lower("sleep_stage")).alias("iv")).select(
        "ds", PIM, "iv.*"
    )


def bedtime_intervals(sleeps: DataFrame, runs: RunDates) -> DataFrame:
    return _exploded(
        sleep_sessions(sleeps, runs),
        [_after("sleep_start_time", "bedtime_start"), _after("sleep_end_time", "bedtime_end")],
    )


def meal_intervals(meals: DataFrame, runs: RunDates, strict: bool = True, baseline: bool = True) -> DataFrame:
    """Meal start, glucose peak and return to baseline.

    ``strict`` keeps two habits of the published query: the peak label that no
    feature column matches, and baseline rows chosen by the peak's window.
    """
    moments = runs.scan(meals, "start_datetime_local").select(
        F.to_date("start_datetime_local").alias("ds"),
        PIM,
        "start_datetime_local",
        "peak_datetime_local",
        "return_to_baseline_datetime_local",
    )
    kinds = [
        _after("start_datetime_local", "meal_start"),
        _after("peak_datetime_local", PEAK_READING_LABEL if strict else PEAK_FEATURE_LABEL),
    ]
    if baseline:
        matched_at = "peak_datetime_local" if strict else None
        kinds.append(_after("return_to_baseline_datetime_local", "meal_return_baseline", matched_at))
    return _exploded(moments, kinds)


def sleep_intervals(sleeps: DataFrame, detail: DataFrame, ds: Day = None, ds_to: Day = None, stages_since: Day = None) -> DataFrame:
    """Sleep stages, session starts and session ends."""
    return union_all(
        [stage_event_intervals(sleeps, detail, ds, ds_to, stages_since), bedtime_intervals(sleeps, RunDates.of(ds, ds_to))]
    )


def event_intervals(
    sleeps: DataFrame,
    detail: DataFrame,
    meals: DataFrame,
    ds: Day = None,
    ds_to: Day = None,
    strict: bool = True,
    stages_since: Day = None,
) -> DataFrame:
    """Intervals of all event kinds."""
    asleep = sleep_intervals(sleeps, detail, ds, ds_to, stages_since)
    return asleep.unionByName(meal_intervals(meals, RunDates.of(ds, ds_to), strict))


# --- labelled readings -------------------------------------------------------


def _stream(hr: DataFrame, runs: RunDates, days: int, min_bpm: int) -> DataFrame:
    return runs.scan(valid_bpm(hr, min_bpm=min_bpm), TS, back=days - 1).select(
        PIM, F.col(TS).alias("datetime_local"), "bpm"
    )


def _stream_span(days: int, ds: str = "ds") -> tuple[Column, Column]:
    """First and last moment of the readings a run date looks at."""
    first = F.date_sub(ds, days - 1).cast("timestamp_ntz")
    last = F.date_add(ds, 1).cast("timestamp_ntz") - F.expr("interval '0.000001' second")
    return first, last


def label_readings(
    hr: DataFrame, intervals: DataFrame, runs: RunDates, days: int = 2, min_bpm: int = 40
) -> DataFrame:
    """Distinct readings inside intervals of their participant.

    Repeated readings fold before the join, and so do intervals of one event that overlap:
    what is left of them is disjoint, so no row comes twice and none is held to find out.
    """
    readings = _stream(hr, runs, days, min_bpm).distinct()
    span = _stream_span(days)
    pairs = points_in_intervals(
        readings,
        merged_intervals(intervals, EVENT_KEYS, "match_lo", "match_hi"),
        PIM,
        at="datetime_local",
        lo="match_lo",
        hi="match_hi",
        clip=span,
        condition=F.col("datetime_local").between(*span),
    )
    columns = ["ds", PIM, "datetime_local", "bpm", "start_time", "end_time", "event"]
    return pairs.select(*columns).withColumn("duration", minute_boundaries(F.col("end_time"), F.col("start_time")))


def event_moments(hr: DataFrame, intervals: DataFrame, runs: RunDates, by: Sequence[str], days: int = 2, min_bpm: int = 40) -> DataFrame:
    """Moments of the readings that ``label_readings`` would return, per group, without listing them.

    ``by`` are columns of the intervals and include the participant. Rates are whole numbers.
    """
    readings = _stream(hr, runs, days, min_bpm).distinct()
    first, last = _stream_span(days)
    events = merged_intervals(intervals, EVENT_KEYS, "match_lo", "match_hi")
    clipped = events.withColumns({"match_lo": F.greatest("match_lo", first), "match_hi": F.least("match_hi", last)})
    return interval_moments(readings, clipped, PIM, "datetime_local", "bpm", "match_lo", "match_hi", by)


def _labelled(rows: DataFrame, participant: str, label: str, duration: bool = True) -> DataFrame:
    keep = ["ds", F.col(PIM).alias(participant), "datetime_local", "bpm", "start_time", "end_time"]
    if duration:
        keep.append("duration")
    return rows.select(*keep, F.col("event").alias(label))


def event_readings(
    hr: DataFrame,
    sleeps: DataFrame,
    detail: DataFrame,
    meals: DataFrame,
    ds: Day = None,
    ds_to: Day = None,
    strict: bool = True,
    min_bpm: int = 40,
    stages_since: Day = None,
) -> DataFrame:
    """Readings of the two days up to the run date, labelled with their events.

    Sleep comes from the day before the run date, meals from the run date. A
    reading in several events appears once for each.
    """
    intervals = event_intervals(sleeps, detail, meals, ds, ds_to, strict, stages_since)
    return _labelled(label_readings(hr, intervals, RunDates.of(ds, ds_to), min_bpm=min_bpm), "participant_id", "event")


def sleep_stage_readings(
    hr: DataFrame, sleeps: DataFrame, detail: DataFrame, ds: Day = None, ds_to: Day = None, min_bpm: int = 40
) -> DataFrame:
    """Readings during sleep stages."""
    intervals = stage_event_intervals(sleeps, detail, ds, ds_to)
    rows = label_readings(hr, intervals, RunDates.of(ds, ds_to), min_bpm=min_bpm)
    return rows.select(
        "ds",
        PIM,
        "datetime_local",
        "bpm",
        F.col("start_time").alias("sleep_stage_start_loc"),
        F.col("end_time").alias("sleep_stage_end_loc"),
        F.col("event").alias("sleep_stage"),
    )


def bedtime_readings(
    hr: DataFrame, sleeps: DataFrame, ds: Day = None, ds_to: Day = None, min_bpm: int = 40
) -> DataFrame:
    """Readings in the ten minutes after a session's start and end."""
    runs = RunDates.of(ds, ds_to)
    rows = label_readings(hr, bedtime_intervals(sleeps, runs), runs, min_bpm=min_bpm)
    return _labelled(rows, PIM, "sleep_event", duration=False)


def sleep_readings(
    hr: DataFrame,
    sleeps: DataFrame,
    detail: DataFrame,
    ds: Day = None,
    ds_to: Day = None,
    days: int = 2,
    min_bpm: int = 40,
) -> DataFrame:
    """Readings during sleep stages and after session start and end.

    ``days`` is the length of the reading window: 2, or 4 for the form that
    looks back three days. That form names the participant ``pim_id``.
    """
    rows = label_readings(hr, sleep_intervals(sleeps, detail, ds, ds_to), RunDates.of(ds, ds_to), days, min_bpm)
    return _labelled(rows, "participant_id" if days == 2 else PIM, "sleep_event")


def meal_readings(
    hr: DataFrame, meals: DataFrame, ds: Day = None, ds_to: Day = None, strict: bool = True, min_bpm: int = 40
) -> DataFrame:
    """Readings of the run date after meal starts and glucose peaks."""
    runs = RunDates.of(ds, ds_to)
    rows = label_readings(hr, meal_intervals(meals, runs, strict, baseline=False), runs, 1, min_bpm)
    return _labelled(rows, "participant_id", "meal_event")


def sleep_bpm_flags(
    hr: DataFrame, sleeps: DataFrame, detail: DataFrame, ds: Day = None, ds_to: Day = None, min_bpm: int = 40
) -> DataFrame:
    """Readings with their sleep stage and a flag for the session's first minutes.

    Stages and session starts are one interval table and one join. What a reading has
    met on a run date is put together where the join left it: a row for each pair of
    a stage and a start, or for what there is of the two. Every stored copy of a
    reading, a stage or a session yields its rows; all of them are counts until the
    last step lists the rows, so no list grows with the stages a reading has met. Intervals
    are clipped to the two days a run date looks at.
    """
    runs = RunDates.of(ds, ds_to)
    readings = _stream(hr, runs, 2, min_bpm).groupBy(PIM, "datetime_local", "bpm").agg(F.count(F.lit(1)).alias("_copies"))
    # Keeps the count in use for all readers of the folded readings, which then share a shuffle.
    readings = readings.filter(F.col("_copies") > 0)
    sessions = sleep_sessions(sleeps, runs).groupBy("ds", PIM, "sleep_start_time", "sleep_end_time").agg(F.count(F.lit(1)).alias("_sessions"))
    details = sleep_stages(detail, None, False, sleeps, runs)
    details = details.groupBy(*details.columns).agg(F.count(F.lit(1)).alias("_stages")).filter(F.col("_stages") > 0)
    held = points_in_intervals(
        details,
        sessions,
        PIM,
        at="sleep_stage_start_loc",
        lo="sleep_start_time",
        hi="sleep_end_time",
        bucket_seconds=SESSION_BUCKET_SECONDS,
    )
    stages = held.groupBy(
        "ds", PIM, F.col("sleep_stage_start_loc").alias("lo"), F.col("sleep_stage_end_loc").alias("hi"), F.lower("sleep_stage").alias("sleep_stage")
    ).agg(F.sum(F.col("_stages") * F.col("_sessions")).alias("_times"))
    starts = sessions.groupBy(
        "ds",
        PIM,
        F.col("sleep_start_time").alias("lo"),
        plus_seconds(F.col("sleep_start_time"), WINDOW_SECONDS).alias("hi"),
        F.lit(None).cast("string").alias("sleep_stage"),
    ).agg(F.sum("_sessions").alias("_times"))
    span = _stream_span(2)
    pairs = points_in_intervals(
        readings,
        stages.unionByName(starts),
        PIM,
        at="datetime_local",
        lo="lo",
        hi="hi",
        clip=span,
        condition=F.col("datetime_local").between(*span),
    )
    reading = [PIM, BUCKET, SALT, "datetime_local", "bpm", "_copies", "ds"]
    counted = pairs.groupBy(*reading, "sleep_stage").agg(F.sum("_times").alias("_times"))
    # As many entries as there are names of stages.
    met = counted.groupBy(*reading).agg(
        F.collect_list(F.when(F.col("sleep_stage").isNotNull(), F.struct("sleep_stage", "_times"))).alias("stages"),
        F.coalesce(F.sum(F.when(F.col("sleep_stage").isNull(), F.col("_times"))), F.lit(0)).alias("starts"),
    )
    # One row even without a stage or without a start.
    none = F.struct(F.lit(None).cast("string").alias("sleep_stage"), F.lit(1).cast("long").alias("_times"))
    named = met.withColumn("_stage", F.explode(F.when(F.size("stages") > 0, F.col("stages")).otherwise(F.array(none))))
    flag = F.when(F.col("starts") > 0, F.lit(1))
    times = lambda n: F.explode(F.array_repeat(F.lit(True), n.cast("int")))
    rows = named.select(
        "ds", F.col(PIM).alias("participant_id"), "datetime_local", "bpm", "_stage.*", flag.alias("sleep_start_10mins"), "_copies", "starts"
    )
    for count in (F.greatest("starts", F.lit(1)), F.col("_copies"), F.col("_times")):
        rows = rows.withColumn("_one", times(count)).drop("_one")
    return rows.select("ds", "participant_id", "datetime_local", "bpm", "sleep_stage", "sleep_start_10mins")


# --- features ----------------------------------------------------------------


def _participant(readings: DataFrame) -> str:
    return "participant_id" if "participant_id" in readings.columns else PIM


def events_detail(
    readings: DataFrame,
    labels: Sequence[str] = EVENT_LABELS,
    label_col: str = "event",
    with_duration: bool = False,
    dedupe: bool = True,
) -> DataFrame:
    """One row per event: statistics of its readings (long form).

    ``dedupe`` drops repeated rows first, which costs a shuffle; the frames of this
    module's ``*_readings`` functions have none, so pass False for them. Readings with other labels, or without a start or end, are left out.
    """
    rows = readings.dropDuplicates() if dedupe else readings
    keys = ["start_time", "end_time"] + (["duration"] if with_duration else [])
    return (
        rows.filter(F.col(label_col).isin(*labels))
        .dropna(subset=[_participant(readings), *keys])
        .groupBy("ds", F.col(_participant(readings)).alias(PIM), *keys, F.col(label_col).alias("event"))
        .agg(*[METRICS[m](F.col("bpm")).alias(m) for m in BPM_METRICS])
    )


def events_daily(
    readings: DataFrame,
    labels: Sequence[str] = EVENT_LABELS,
    label_col: str = "event",
    dedupe: bool = True,
) -> DataFrame:
    """One row per participant and day: statistics per label (wide form).

    For ``dedupe`` see ``events_detail``. Participants with only other labels keep an all-null row.
    """
    rows = readings.dropDuplicates() if dedupe else readings
    aggs = []
    for label in labels:
        bpm = F.when(F.col(label_col) == label, F.col("bpm"))
        for m in BPM_METRICS:
            name = f"{m.rstrip('_')}_{label}"
            value = METRICS[m](bpm)
            aggs.append((F.nullif(value, F.lit(0)) if m == "count_" else value).alias(name))
    return rows.groupBy("ds", F.col(_participant(readings)).alias(PIM)).agg(*aggs)


def sleep_events_detail(readings: DataFrame) -> DataFrame:
    """Long form over sleep labels only."""
    return events_detail(readings, SLEEP_LABELS, "sleep_event")


def sleep_events_daily(readings: DataFrame) -> DataFrame:
    """Wide form over sleep labels only."""
    return events_daily(readings, SLEEP_LABELS, "sleep_event")


def _moment_metrics(hr: DataFrame) -> dict[str, Column]:
    """``BPM_METRICS`` from moments, exact up to the last division."""
    n, kind = F.col("n"), hr.schema["bpm"].dataType
    return {
        "mean_bpm": F.col("total").cast("double") / n.cast("double"),
        "sd_bpm": F.sqrt(exact_variance_pop(n, F.col("total"), F.col("squares"))),
        "min_bpm": F.col("least").cast(kind),
        "max_bpm": F.col("greatest").cast(kind),
        "count_": F.coalesce(n, F.lit(0)),
    }


def _whole(hr: DataFrame) -> bool:
    return isinstance(hr.schema["bpm"].dataType, T.IntegralType)


def detail_of(
    hr: DataFrame,
    intervals: DataFrame,
    ds: Day = None,
    ds_to: Day = None,
    labels: Sequence[str] = EVENT_LABELS,
    with_duration: bool = False,
    min_bpm: int = 40,
) -> DataFrame:
    """``events_detail`` of the readings in intervals, straight from readings and intervals.

    Readings that lie in many events are not listed for each of them. Rates with fractions
    have no exact sums, so for them the readings are listed.
    """
    runs, keys = RunDates.of(ds, ds_to), ["start_time", "end_time"] + (["duration"] if with_duration else [])
    if not _whole(hr):
        return events_detail(label_readings(hr, intervals, runs, min_bpm=min_bpm), labels, "event", with_duration, dedupe=False)
    wanted = intervals.filter(F.col("event").isin(*labels)).dropna(subset=[PIM, "start_time", "end_time"])
    found = event_moments(hr, wanted, runs, EVENT_KEYS, min_bpm=min_bpm)
    timed = found.withColumn("duration", minute_boundaries(F.col("end_time"), F.col("start_time")))
    metrics = _moment_metrics(hr)
    return timed.select("ds", PIM, *keys, "event", *[metrics[m].alias(m) for m in BPM_METRICS])


def daily_of(
    hr: DataFrame,
    intervals: DataFrame,
    ds: Day = None,
    ds_to: Day = None,
    labels: Sequence[str] = EVENT_LABELS,
    min_bpm: int = 40,
) -> DataFrame:
    """``events_daily`` of the readings in intervals, straight from readings and intervals."""
    runs = RunDates.of(ds, ds_to)
    if not _whole(hr):
        return events_daily(label_readings(hr, intervals, runs, min_bpm=min_bpm), labels, "event", dedupe=False)
    found = event_moments(hr, intervals, runs, ["ds", PIM, "event"], min_bpm=min_bpm)
    metrics = _moment_metrics(hr)
    rows = found.select("ds", PIM, "event", *[metrics[m].alias(m) for m in BPM_METRICS])
    aggs = [
        F.max(F.when(F.col("event") == label, F.col(m))).alias(f"{m.rstrip('_')}_{label}") for label in labels for m in BPM_METRICS
    ]
    return rows.groupBy("ds", PIM).agg(*aggs)
