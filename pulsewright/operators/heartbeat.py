"""Consecutive readings: each reading with the one before it on the same day.

A window over (participant, day) would put a participant's whole day into one
task. Instead the day is cut into five-minute slices. Lag runs inside a slice,
and only the first reading of a slice takes its predecessor from a small table
with one row per slice (at most 288 per participant and day). Exact copies of
a reading are folded into a count before the first shuffle, so that a reading
stored many times does not fill a task.

A slice that holds a large share of all readings (sub-second data) would still fill
one. ``dense_cuts`` measures where to cut such slices; with its result, lag runs inside
pieces of slices, and pieces are linked as slices are.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsewright.functions.stats import beat_interval
from pulsewright.functions.timeops import bucket_seconds, epoch_seconds, from_epoch
from pulsewright.operators.relational import valid_bpm

SLICE_SECONDS = 300

PIM, TS = "pim_id", "heart_rate_datetime_loc"
PIECE = "piece"
CELL_MICROS = 1000
# Cuts measured at most, and readings below which a slice is never cut.
MOST_CUTS = 2000
LARGEST_PIECE = 100_000


def _folded(hr: DataFrame, min_bpm: int) -> DataFrame:
    """Valid readings with the number of copies and their slice."""
    return (
        valid_bpm(hr, min_bpm=min_bpm)
        .filter(F.col(PIM).isNotNull() & F.col(TS).isNotNull())
        .groupBy(PIM, TS, "bpm")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("slice", bucket_seconds(epoch_seconds(F.col(TS)), SLICE_SECONDS))
        # Stated here so that the join below adds no filter of its own to one
        # side only: both sides then read the same shuffle.
        .filter(F.col("slice").isNotNull())
    )


def _micros_into_slice() -> Column:
    return F.unix_micros(F.col(TS).cast("timestamp")) - F.col("slice") * 1000000


def _cell() -> Column:
    return F.floor(_micros_into_slice() / CELL_MICROS)


def dense_cuts(hr: DataFrame, min_bpm: int = 40, largest: int = LARGEST_PIECE, most: int = MOST_CUTS) -> DataFrame:
    """(pim_id, slice, cuts): first milliseconds of the pieces of slices with too many readings.

    A piece may hold ``largest`` distinct readings, or one of ``most`` equal shares of all
    readings where that is more. So there are at most ``most`` dense slices and twice as
    many cuts, however many readings: safe to broadcast. Readings of one millisecond stay
    together.
    """
    folded = _folded(hr, min_bpm)
    slices = folded.groupBy(PIM, "slice").agg(F.count(F.lit(1)).alias("_n"))
    total = slices.agg(F.sum("_n")).scalar()
    size = F.greatest(F.lit(largest).cast("long"), F.ceil(F.coalesce(total, F.lit(0)) / F.lit(most)))
    dense = slices.filter(F.col("_n") > size).select(F.col(PIM).alias("_pim"), F.col("slice").alias("_slice"))
    inside = folded.join(F.broadcast(dense), (F.col(PIM) == F.col("_pim")) & (F.col("slice") == F.col("_slice")))
    cells = inside.groupBy(PIM, "slice", _cell().alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    # 300,000 cells of a slice at most.
    before = F.sum("_n").over(Window.partitionBy(PIM, "slice").orderBy("_cell")) - F.col("_n")
    pieces = cells.withColumn("_piece", F.floor(before / size)).groupBy(PIM, "slice", "_piece").agg(F.min("_cell").alias("_from"))
    return pieces.groupBy(PIM, "slice").agg(F.array_sort(F.collect_list("_from")).alias("cuts"))


def _unit(copies: DataFrame) -> list[str]:
    """The keys inside which lag runs."""
    return [PIM, "slice"] + ([PIECE] if PIECE in copies.columns else [])


def _folded_copies(hr: DataFrame, min_bpm: int, dense: DataFrame | None = None) -> DataFrame:
    """Folded readings placed by (participant, slice), or by pieces of slices where ``dense`` cuts them."""
    folded = _folded(hr, min_bpm)
    if dense is None:
        return folded.repartition(PIM, "slice")
    cuts = dense.select(F.col(PIM).alias("_pim"), F.col("slice").alias("_slice"), "cuts")
    on = (F.col(PIM) == F.col("_pim")) & (F.col("slice") == F.col("_slice"))
    passed = F.size(F.filter("cuts", lambda c: c <= _cell()))
    pieced = folded.join(F.broadcast(cuts), on, "left").withColumn(PIECE, F.coalesce(passed, F.lit(0)))
    return pieced.drop("_pim", "_slice", "cuts").repartition(PIM, "slice", PIECE)


def _slice_table(copies: DataFrame) -> DataFrame:
    """One row per slice or piece: last bpm before it, own last bpm, day mean interval."""
    unit = _unit(copies)
    if isinstance(copies.schema["bpm"].dataType, T.IntegralType):
        order = _micros_into_slice() * 1000000000 + F.col("bpm")
    else:
        order = F.struct(TS, "bpm")
    slices = copies.groupBy(*unit).agg(
        F.max_by("bpm", order).alias("slice_last_bpm"),
        F.sum("copies").alias("_n"),
        F.sum(F.col("copies") * beat_interval(F.col("bpm"))).alias("_rr"),
    )
    # Keeps both sides of the later join alike whatever columns are used, so that
    # they read one shuffle and the readings are scanned once.
    slices = slices.filter(F.col("_n") > 0)
    day = Window.partitionBy(PIM, "date")
    last = F.col("slice_last_bpm")
    # Pieces of a slice share one value to sum around.
    shared = F.first(last).over(Window.partitionBy(PIM, "date", "slice").orderBy(PIECE)) if PIECE in unit else last
    return slices.withColumn("date", F.to_date(from_epoch(F.col("slice")))).select(
        *unit,
        "date",
        shared.alias("slice_last_bpm"),
        F.lag("slice_last_bpm").over(day.orderBy(*unit[1:])).alias("carried_bpm"),
        (F.sum("_rr").over(day) / F.sum("_n").over(day)).alias("avg_rr"),
    )


def _with_previous(hr: DataFrame, min_bpm: int, dense: DataFrame | None = None) -> DataFrame:
    copies = _folded_copies(hr, min_bpm, dense)
    unit = _unit(copies)
    in_slice = Window.partitionBy(*unit).orderBy(TS, "bpm")
    stepped = copies.withColumn("prev_in_slice", F.lag("bpm").over(in_slice))
    return stepped.join(_slice_table(copies), unit).withColumn("prev_bpm", F.coalesce("prev_in_slice", "carried_bpm"))


def _repeats(copies: Column, bpm: Column, prev: Column) -> Column:
    """Whether a folded reading stands for two distinct rows.

    The first copy follows the earlier reading, all others follow a copy of
    themselves; equal rows merge.
    """
    return (copies > 1) & ~prev.eqNullSafe(bpm)


def unplaced_readings(hr: DataFrame, min_bpm: int = 40) -> DataFrame:
    """How many valid readings lack a participant or a time: they are part of no variability feature."""
    lost = valid_bpm(hr, min_bpm=min_bpm).filter(F.col(PIM).isNull() | F.col(TS).isNull())
    return lost.agg(F.count_if(F.col(PIM).isNull()).alias("no_participant"), F.count_if(F.col(TS).isNull()).alias("no_time"))


SLICE_STATISTICS = ("slice_interval", "slice_rmssd", "slice_sdrr")


def _with_slice_statistics(paired: DataFrame) -> DataFrame:
    """Mean interval, RMSSD and interval SD of each slice's distinct rows.

    The rows are already placed and sorted by slice here, so these windows
    need neither a shuffle nor a sort. A slice has few rows. The SD is summed
    around a value of the slice itself: a constant slice gives exactly zero.
    Slices in pieces are summed by piece first; only the sums meet by slice, and
    the row that leads the first piece gets the result.
    """
    bpm, prev = F.col("bpm"), F.col("prev_bpm")
    again = _repeats(F.col("copies"), bpm, prev).cast("int")
    rows, pairs = again + 1, again + prev.isNotNull().cast("int")
    rr, step = beat_interval(bpm), beat_interval(bpm) - beat_interval(prev)
    off = rr - beat_interval(F.col("slice_last_bpm"))
    sums = {
        "_rows": rows,
        "_interval": rows * rr,
        "_pairs": pairs,
        "_steps": step * step,
        "_off": pairs * off,
        "_squares": pairs * off * off,
    }

    def statistics(total: Mapping[str, Column]) -> dict[str, Column]:
        n, shift = F.nullif(total["_pairs"], F.lit(0)).cast("double"), total["_off"]
        spread = F.greatest(total["_squares"] - shift * shift / n, F.lit(0.0))
        return {
            "slice_interval": total["_interval"] / total["_rows"],
            "slice_rmssd": F.sqrt(total["_steps"] / n),
            "slice_sdrr": F.when(n > 1, F.sqrt(spread / (n - 1))),
        }

    if PIECE not in paired.columns:
        window = Window.partitionBy(PIM, "slice")
        return paired.withColumns(statistics({name: F.sum(c).over(window) for name, c in sums.items()}))
    pieces = paired.groupBy(PIM, "slice", PIECE).agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    slices = pieces.groupBy(PIM, "slice").agg(*[F.sum(c).alias(c) for c in sums], F.min(PIECE).alias(PIECE))
    found = slices.select(PIM, "slice", PIECE, *[c.alias(name) for name, c in statistics({c: F.col(c) for c in sums}).items()])
    return paired.join(found, [PIM, "slice", PIECE], "left")


def consecutive_readings(hr: DataFrame, min_bpm: int = 40, dense: DataFrame | None = None) -> DataFrame:
    """Distinct (reading, previous reading) rows with the day's mean interval.

    Predecessors are taken over all stored rows, then equal rows are merged.
    Columns: pim_id, date, slice (epoch seconds), time, bpm, prev_bpm, avg_rr,
    and SLICE_STATISTICS on one row of each slice. The first reading of a day
    has no ``prev_bpm``. Readings at one instant follow in order of bpm.
    ``dense`` takes the ``dense_cuts`` of the readings; the rows are the same.
    """
    paired = _with_slice_statistics(_with_previous(hr, min_bpm, dense))
    bpm, prev = F.col("bpm"), F.col("prev_bpm")
    previous = F.when(_repeats(F.col("copies"), bpm, prev), F.array(prev, bpm)).otherwise(F.array(prev))
    leads = F.col("prev_in_slice").isNull() & (F.col("version") == 0)
    return paired.select("*", F.posexplode(previous).alias("version", "previous")).select(
        PIM,
        "date",
        "slice",
        TS,
        "bpm",
        F.col("previous").alias("prev_bpm"),
        "avg_rr",
        *[F.when(leads, F.col(c)).alias(c) for c in SLICE_STATISTICS],
    )


def weighted_readings(hr: DataFrame, min_bpm: int = 40, dense: DataFrame | None = None) -> DataFrame:
    """All (reading, previous reading) rows, copies kept as a ``weight``.

    ``slice_last_bpm`` is a value from the row's own slice. For ``dense`` see
    ``consecutive_readings``.
    """
    paired = _with_previous(hr, min_bpm, dense)
    versions = F.array(
        F.struct(F.col("prev_bpm").alias("prev_bpm"), F.lit(1).cast("long").alias("weight")),
        F.struct(F.col("bpm").alias("prev_bpm"), (F.col("copies") - 1).alias("weight")),
    )
    return (
        paired.withColumn("_v", F.explode(F.filter(versions, lambda v: v["weight"] > 0)))
        .select(PIM, "date", "slice", TS, "bpm", "_v.prev_bpm", "_v.weight", "avg_rr", "slice_last_bpm")
    )
