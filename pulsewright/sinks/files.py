"""File sinks: CSV, NDJSON, daily partitions, integer-range partitions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from pulsewright.functions.rundates import RunDates
from pulsewright.functions.timeops import parse_day
from pulsewright.sources.scans import CSV_TIMES

RANGE_COLUMN = "range_start"
ORDER_BLOCK = 100_000

# Folder name of a null partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

Days = str | date | RunDates | Iterable[str | date]


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file per partition, each with a header."""
    df.write.mode("overwrite").options(header=True, **CSV_TIMES).csv(path)


def with_batch_time(df: DataFrame, now: datetime | None = None) -> DataFrame:
    """Add the UTC processing time; ``now`` fixes it."""
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return df.withColumn("batch_time", stamp)


def write_json(df: DataFrame, path: str, ds: str | date | None = None, now: datetime | None = None) -> None:
    """NDJSON with null keys kept; adds ``ds`` (when given) and ``batch_time``."""
    if ds is not None:
        df = df.withColumn("ds", F.lit(parse_day(ds)))
    stamped = with_batch_time(df, now)
    stamped.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], files: int | None = None) -> None:
    """Parquet files that follow each other in the order of ``keys``, sorted inside.

    Each file, and each row group in it, covers a range of its own, so their minimum and
    maximum statistics let a range filter skip the others. Spark chooses the number of
    files unless ``files`` is given; range borders come from a sample, so files differ
    in size, and rows with equal keys share a file.
    """
    placed = df.repartitionByRange(*([files] if files else []), *keys)
    placed.sortWithinPartitions(*keys).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def file_order(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Per file its rows, first and last key, and whether rows or files are out of order.

    Rows follow their position in the file. ``unordered`` counts rows below the one before
    them; ``overlaps`` says that an earlier file reaches beyond this file's first row.
    """
    rows = spark.read.parquet(path).select(
        F.struct(*keys).alias("key"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    # A block of a file's rows at a time: the first key of each block meets the last of the one before it.
    block = F.floor(F.col("at") / ORDER_BLOCK).alias("block")
    inside = rows.select("*", block)
    before = F.lag("key").over(Window.partitionBy("file", "block").orderBy("at"))
    blocks = inside.withColumn("below", (F.col("key") < before).cast("int")).groupBy("file", "block").agg(
        F.min_by("key", "at").alias("start"),
        F.max_by("key", "at").alias("stop"),
        F.min("key").alias("first"),
        F.max("key").alias("last"),
        F.coalesce(F.sum("below"), F.lit(0)).alias("below"),
        F.count(F.lit(1)).alias("rows"),
    )
    borders = F.lag("stop").over(Window.partitionBy("file").orderBy("block"))
    files = blocks.withColumn("border", (F.col("start") < borders).cast("int")).groupBy("file").agg(
        F.sum("rows").alias("rows"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        (F.sum("below") + F.coalesce(F.sum("border"), F.lit(0))).alias("unordered"),
    )
    # One row per file.
    reached = F.max("last").over(Window.orderBy("first", "file").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("overlaps", F.coalesce(reached > F.col("first"), F.lit(False)))


def named_days(days: Days) -> list[date]:
    """A run date, several, or a closed range of them as a list."""
    if isinstance(days, RunDates):
        if days.first is None or days.last is None:
            raise ValueError("a range of days to replace needs both ends")
        return [days.first + timedelta(days=i) for i in range((days.last - days.first).days + 1)]
    if isinstance(days, (str, date)):
        days = [days]
    return sorted({parse_day(d) for d in days})


def _among(value: Column, named: Sequence) -> Column:
    """Whether a partition value is one of the named ones; None names null."""
    found = F.coalesce(value.isin([v for v in named if v is not None]), F.lit(False))
    return found | value.isNull() if None in named else found


def _replace(df: DataFrame, path: str, partition: str, sort: Sequence[str], named: Sequence | None) -> None:
    """Overwrite partitions: the ones present in ``df``, or exactly the ``named`` ones.

    The mode is stated, so that no session setting decides what is replaced. Which
    named values got rows is observed while they are written. Of the others, those that
    hold rows from an earlier write are overwritten with none.
    """
    seen = Observation()
    if named is not None:
        value = F.col(partition)
        other = F.concat(F.lit(f"not among the partitions to replace: {partition} "), F.coalesce(value.cast("string"), F.lit("null")))
        checked = F.when(_among(value, named), value).otherwise(F.raise_error(other).cast(df.schema[partition].dataType))
        # Bounded by the named values.
        df = df.withColumn(partition, checked).observe(
            seen, F.collect_set(partition).alias("values"), F.count_if(value.isNull()).alias("nulls")
        )
    placed = df.sortWithinPartitions(partition, *sort) if sort else df
    (
        placed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    if named is None:
        return
    written = {*seen.get["values"], *([None] if seen.get["nulls"] else [])}
    empty = [v for v in named if v not in written]
    if not empty:
        return
    held = df.sparkSession.read.schema(df.schema).parquet(path).select(partition)
    stale = held.filter(_among(F.col(partition), empty)).distinct()
    # At most the named values; partitions are listed, no column is read.
    none = df.sparkSession.createDataFrame([], df.drop(partition).schema)
    for (value,) in stale.collect():
        folder = NULL_FOLDER if value is None else value
        none.write.mode("overwrite").parquet(f"{path}/{partition}={folder}")


def write_partition(
    df: DataFrame, path: str, partition: str = "ds", sort: Sequence[str] = (), days: Days | None = None
) -> None:
    """Replace daily partitions; re-running a day leaves one copy of it and touches no other day.

    ``days`` names what the run replaces: one run date, several, or a closed range. A
    named day without rows in ``df`` is emptied, and a row of any other day fails the
    write before anything is replaced. Without ``days`` the days present in ``df`` are
    replaced, so a day that has become empty keeps its earlier rows. ``sort`` orders
    rows inside the files.
    """
    _replace(df, path, partition, sort, None if days is None else named_days(days))


def range_start(value: Column, start: int, interval: int, end: int) -> Column:
    """Lower bound of the value's range; null outside [start, end)."""
    inside = (value >= start) & (value < end)
    return F.when(inside, F.lit(start) + F.floor((value - start) / F.lit(interval)) * interval)


def range_starts(start: int, interval: int, end: int) -> list[int]:
    """Lower bounds of all ranges of [start, end)."""
    return list(range(start, end, interval))


def write_range_partitioned(
    df: DataFrame, path: str, field: str, start: int, interval: int, end: int, ranges: Sequence[int | None] | None = None
) -> None:
    """Partition by integer ranges; values outside share the null partition.

    The table is replaced as a whole. With ``ranges`` (lower bounds, None for the values
    outside) just those are: named ones without rows become empty, and a row of another
    range fails the write. The session's overwrite mode plays no part.
    """
    placed = df.withColumn(RANGE_COLUMN, range_start(F.col(field), start, interval, end))
    if ranges is not None:
        unknown = set(ranges) - {*range_starts(start, interval, end), None}
        if unknown:
            raise ValueError(f"no range starts at {sorted(unknown)}")
        _replace(placed, path, RANGE_COLUMN, (), list(ranges))
        return
    placed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(RANGE_COLUMN).parquet(path)
