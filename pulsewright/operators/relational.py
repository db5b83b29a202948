"""General table operators shared by the pipelines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsewright.functions.stats import METRICS, Metric


def valid_bpm(df: DataFrame, col: str = "bpm", min_bpm: int = 40) -> DataFrame:
    """Drop readings below the validity cut, and missing ones (null or NaN).

    NaN sorts above all numbers, so it would pass the cut on its own.
    """
    valid = F.col(col) >= min_bpm
    if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)):
        valid = valid & ~F.isnan(col)
    return df.filter(valid)


def dedupe(df: DataFrame) -> DataFrame:
    """Drop rows that repeat in every column."""
    return df.dropDuplicates()


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def cohort(df: DataFrame, participants: DataFrame, key: str = "pim_id") -> DataFrame:
    """Keep rows of listed participants.

    The list may be too large to broadcast. Its least and greatest key are known when the
    job runs and reach the scan as a range, ahead of the shuffle; files clustered by
    participant (``sinks.files.write_clustered``) are then skipped outside it.
    """
    listed = participants.select(F.col(key).cast(df.schema[key].dataType).alias(key)).distinct()
    bound = lambda fn: listed.agg(fn(key)).scalar()
    return df.filter((F.col(key) >= bound(F.min)) & (F.col(key) <= bound(F.max))).join(listed, key, "left_semi")


def aggregate_table(
    df: DataFrame,
    agg_col: str,
    group_cols: str | Sequence[str],
    metrics: Sequence[str] | Mapping[str, Metric],
) -> DataFrame:
    """Several metrics of one column per group.

    ``metrics`` names entries of ``METRICS`` or maps output names to Column
    functions of the caller's own. Rows with a null group key are left out.
    """
    keys = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    table = metrics if isinstance(metrics, Mapping) else {m: METRICS[m] for m in metrics}
    exprs = [fn(F.col(agg_col)).alias(name) for name, fn in table.items()]
    return df.dropna(subset=keys).groupBy(*keys).agg(*exprs)


def outer_all(dfs: Sequence[DataFrame], on: str | Sequence[str] = "participant_id") -> DataFrame:
    """Fold of full outer joins with merged key columns."""
    keys = [on] if isinstance(on, str) else list(on)
    return reduce(lambda left, right: left.join(right, keys, "full_outer"), dfs)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Raise when a frame is empty; reads at most one row."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count_")).orderBy(F.desc("count_"), col)


def flatten(df: DataFrame, structs: Sequence[str], keep: Sequence[str], prefix: Mapping[str, str]) -> DataFrame:
    """Struct fields as flat columns named ``<prefix>_<field>``."""
    cols: list[Column] = [F.col(c) for c in keep]
    for name in structs:
        for field in df.schema[name].dataType.fieldNames():
            cols.append(F.col(f"{name}.{field}").alias(f"{prefix[name]}_{field}"))
    return df.select(*cols)
