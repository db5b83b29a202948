"""Exact quantiles without gathering a group in one place.

A percentile aggregate keeps all distinct values of a group in one task. Here
equal values fold into one row with a count, and every row has a slot: the
whole part of a fixed, rising function of the value. Slot counts (combined
before the shuffle) show which slots hold the wanted ranks; inside those the
same is done once more over the range their values really span. Only values of
the slots that remain are sorted. Counts are exact, so the result is exact.

A group can have some 700,000 slots. Their counts are summed up in two levels, inside
strides of neighbouring slots and over strides, so no window holds them all.

Slots need no facts of the group, so values meet facts on (group, slot) only,
and one shuffle of folded values serves all steps.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOTS_PER_FACTOR = 1 << 9
SUBSLOTS = 1 << 16
# Neighbouring slots whose counts are summed in one place.
SLOTS_PER_STRIDE = 1 << 10
VALUE, TIMES, PRESENT, SLOT, SUBSLOT, STRIDE = "_value", "_times", "_present", "_slot", "_subslot", "_stride"
ALL = "_all"


def folded_values(df: DataFrame, col: str, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Distinct (group, value) rows with their count and slot; NaN counts as null.

    Without ``by`` all rows form one group.
    """
    keys = list(by) or [ALL]
    source = df if by else df.withColumn(ALL, F.lit(0))
    c = F.col(col).cast("double")
    folded = source.select(*keys, F.when(~F.isnan(c), c).alias(VALUE)).groupBy(*keys, VALUE).agg(
        F.count(F.lit(1)).alias(TIMES), F.count(VALUE).alias(PRESENT)
    )
    return folded.withColumn(SLOT, _slot(F.col(VALUE))), keys


def _slot(value: Column) -> Column:
    """Slots grow with the value: 512 for each factor e, the same below zero."""
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * SLOTS_PER_FACTOR)


def slot_edge(slot: Column) -> Column:
    """A value near those of a slot."""
    return F.signum(slot) * F.expm1(F.abs(slot) / SLOTS_PER_FACTOR)


def _ranks(prob: float) -> tuple[Column, Column, Column]:
    """Ranks (from 0) around a probability, and the weight of the upper one."""
    position = F.lit(float(prob)) * (F.col("_n") - 1)
    lower = F.floor(position)
    return lower, F.least(lower + 1, F.col("_n") - 1), position - lower


def _holds_any(ranks: Sequence[Column], first: Column, count: Column) -> Column:
    found = F.lit(False)
    for rank in ranks:
        found = found | ((first <= rank) & (rank < first + count))
    return found


def _with_stride(rows: DataFrame, slot: str) -> DataFrame:
    return rows.withColumn(STRIDE, F.floor(F.col(slot) / F.lit(SLOTS_PER_STRIDE)))


def running_sum(counts: DataFrame, group: list[str], slot: str, count: str, into: str) -> DataFrame:
    """Add the sum of ``count`` over the lower slots of the group, and its total as ``_whole``.

    Two levels: sums inside a stride of neighbouring slots, then sums of whole strides. A
    group's slots are thus never in one place, only its strides (a thousandth of them),
    and a stride's base comes back by a join on (group, stride).
    """
    placed = _with_stride(counts, slot)
    strides = placed.groupBy(*group, STRIDE).agg(F.sum(count).alias("_sum"))
    whole = Window.partitionBy(*group)
    strides = strides.select(
        *group,
        STRIDE,
        (F.sum("_sum").over(whole.orderBy(STRIDE)) - F.col("_sum")).alias("_base"),
        F.sum("_sum").over(whole).alias("_whole"),
    )
    inside = F.sum(count).over(Window.partitionBy(*group, STRIDE).orderBy(slot)) - F.col(count)
    met = meet(placed.withColumn("_inside", inside), strides, [*group, STRIDE])
    return met.withColumn(into, F.col("_base") + F.col("_inside")).drop("_base", "_inside", STRIDE)


def over_group(slots: DataFrame, group: list[str], facts: Mapping[str, tuple[Callable[[Column], Column], str]]) -> DataFrame:
    """Add sums, minima or maxima of a column over the whole group to rows with a slot.

    Strides are reduced first, so that a group's slots are not gathered.
    """
    placed = _with_stride(slots, SLOT)
    strides = placed.groupBy(*group, STRIDE).agg(*[fn(F.col(c)).alias(name) for name, (fn, c) in facts.items()])
    whole = Window.partitionBy(*group)
    strides = strides.select(*group, STRIDE, *[fn(F.col(name)).over(whole).alias(name) for name, (fn, _) in facts.items()])
    return meet(placed, strides, [*group, STRIDE]).drop(STRIDE)


def to_slots(slots: DataFrame, facts: DataFrame, group: list[str]) -> DataFrame:
    """Join one-row-per-group facts to rows with a slot; on the group itself only strides meet them."""
    placed = _with_stride(slots, SLOT)
    strides = meet(placed.select(*group, STRIDE).distinct(), facts, group)
    return meet(placed, strides, [*group, STRIDE]).drop(STRIDE)


def _facts(rows: DataFrame, group: list[str], slot: str, ranks: Sequence[Column]) -> DataFrame:
    """Slots that hold a wanted rank, with the count of all values below them."""
    counts = rows.groupBy(*group, slot).agg(
        F.sum(TIMES).alias("_c"), F.min(VALUE).alias("_lo"), F.max(VALUE).alias("_hi"), *_carried(rows)
    )
    counts = running_sum(counts, group, slot, "_c", "_below")
    if "_n" not in counts.columns:
        counts = counts.withColumns({"_n": F.col("_whole"), "_before": F.lit(0).cast("long")})
    counts = counts.withColumn("_before", F.col("_before") + F.col("_below")).drop("_whole", "_below")
    return counts.filter(_holds_any(ranks, F.col("_before"), F.col("_c"))).drop("_c")


def _carried(rows: DataFrame) -> list[Column]:
    return [F.max(c).alias(c) for c in ("_n", "_before") if c in rows.columns]


def meet(rows: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which null group keys are equal to each other."""
    right = facts.withColumnsRenamed({k: f"_r{k}" for k in keys})
    on = F.col(keys[0]).eqNullSafe(F.col(f"_r{keys[0]}"))
    for k in keys[1:]:
        on = on & F.col(k).eqNullSafe(F.col(f"_r{k}"))
    return rows.join(right, on).drop(*[f"_r{k}" for k in keys])


def present(folded: DataFrame) -> DataFrame:
    """Rows with a value.

    The test is on counts: it stays above the shuffle and keeps both counts in use, so
    that all readers of the folded values share one shuffle.
    """
    return folded.filter((F.col(PRESENT) > 0) & (F.col(TIMES) > 0))


def quantiles_of(
    folded: DataFrame, keys: list[str], probs: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """Linearly interpolated quantiles of folded values, one column per probability."""
    values = present(folded)
    ranks = [rank for p in probs for rank in _ranks(p)[:2]]
    first = [*keys, SLOT]
    left = meet(values, _facts(values, keys, SLOT, ranks), first)
    width = F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0))
    place = F.floor((F.col(VALUE) - F.col("_lo")) / width * SUBSLOTS)
    left = left.withColumn(SUBSLOT, F.coalesce(F.least(place, F.lit(SUBSLOTS - 1)), F.lit(0))).drop("_lo", "_hi")
    second = [*first, SUBSLOT]
    left = meet(left.drop("_n", "_before"), _facts(left, first, SUBSLOT, ranks), second)

    ranked = left.withColumn(
        "_end", F.col("_before") + F.sum(TIMES).over(Window.partitionBy(*second).orderBy(VALUE))
    )
    at = lambda rank: F.max(F.when((F.col("_end") - F.col(TIMES) <= rank) & (rank < F.col("_end")), F.col(VALUE)))
    found, outputs = [], []
    for i, (p, name) in enumerate(zip(probs, names)):
        lower, upper, _ = _ranks(p)
        found += [at(lower).alias(f"_l{i}"), at(upper).alias(f"_u{i}")]
        low, high = F.col(f"_l{i}"), F.col(f"_u{i}")
        outputs.append((low + (high - low) * _ranks(p)[2]).alias(name))
    return ranked.groupBy(*keys).agg(*found, F.max("_n").alias("_n")).select(*keys, *outputs)


def exact_quantiles(
    df: DataFrame, col: str, probs: Sequence[float], names: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated quantiles per group, one column per probability."""
    folded, keys = folded_values(df, col, by)
    return quantiles_of(folded, keys, probs, names)
