"""The set of run dates a pipeline is asked for: all, one day, or a range."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame

from pulsewright.functions.timeops import between_days, parse_day


@dataclass(frozen=True)
class RunDates:
    """An inclusive range of run dates; ``None`` leaves that end open.

    With both ends open a pipeline yields every run date its data supports,
    so a whole history is rebuilt in one job.
    """

    first: date | None = None
    last: date | None = None

    @classmethod
    def of(cls, ds: str | date | None, ds_to: str | date | None = None) -> "RunDates":
        if ds is None:
            return cls(None, parse_day(ds_to) if ds_to is not None else None)
        first = parse_day(ds)
        return cls(first, parse_day(ds_to) if ds_to is not None else first)

    @property
    def single(self) -> date | None:
        return self.first if self.first is not None and self.first == self.last else None

    def clip(self, df: DataFrame, col: str = "ds") -> DataFrame:
        """Keep rows whose run date is asked for."""
        return between_days(df, col, self.first, self.last)

    def scan(self, df: DataFrame, col: str, back: int = 0, lag: int = 0) -> DataFrame:
        """Keep input rows that some run date can use.

        A run date uses days ``ds - lag - back`` to ``ds - lag``.
        """
        shift = lambda d, n: None if d is None else d - timedelta(days=n)
        return between_days(df, col, shift(self.first, lag + back), shift(self.last, lag))
