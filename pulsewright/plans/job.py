"""Extract, transform, load of a user's own step."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pulsewright.functions.rundates import RunDates
from pulsewright.operators.relational import cohort
from pulsewright.sinks.conform import conform
from pulsewright.sinks.files import write_partition
from pulsewright.sources.scans import run_date
from pulsewright.sources.schemas import FieldList


def run_job(
    sources: Mapping[str, DataFrame],
    transform: Callable[..., DataFrame],
    schema: str | FieldList | T.StructType,
    table: str,
    ds: str | date | None = None,
    participants: DataFrame | None = None,
    participant_key: str = "pim_id",
    ds_to: str | date | None = None,
) -> None:
    """Run ``transform(**sources)`` and replace daily partitions of the table.

    With ``ds`` the job replaces that day, up to ``ds_to`` when given: days without
    results become empty, results of other days are an error. Without it the days in
    the result are replaced. ``participants`` restricts every source to a cohort. A
    single ``ds`` is stamped on a result that has no such column.
    """
    if ds is None and ds_to is not None:
        raise ValueError("ds_to needs a first day")
    runs = None if ds is None else RunDates.of(ds, ds_to)
    if participants is not None:
        sources = {name: cohort(df, participants, participant_key) for name, df in sources.items()}
    result = transform(**sources)
    if runs is not None and "ds" not in result.columns:
        if runs.single is None:
            raise ValueError("a range of days needs a result with a ds column")
        result = result.select(run_date(runs.single), "*")
    write_partition(conform(result, schema), table, days=runs)
