"""Spans of pattern matches as Column expressions.

Spark returns the matches of a pattern and the pieces between them; running lengths of
both give the places. Places count code points, the end is exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOUND = "array<struct<start:int,end:int,value:string>>"


def no_spans() -> Column:
    return F.array().cast(FOUND)


def _placed(found: Column, text: Column, pattern: str) -> Column:
    """Matches with their places."""
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: F.struct(m.alias("m"), F.length(g).alias("g")))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["g"]
        end = start + F.length(x["m"])
        one = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(state["out"], one).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), no_spans().alias("out"))
    # Most texts have no match: one scan tells, the pieces are made for the others only.
    return F.when(F.size(found) > 0, F.aggregate(steps, begin, step, lambda s: s["out"])).otherwise(no_spans())


def find_all(df: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """Add a column per pattern with its leftmost non-overlapping matches.

    Each is an array of (start, end, value), in order. A pattern must not match the
    empty string. Matches are columns of their own first: each is used several times,
    and Spark does not repeat the search for that.
    """
    matched = df.select("*", *[F.regexp_extract_all(F.col(text), F.lit(p), F.lit(0)).alias(f"{n}_found") for n, p in patterns.items()])
    placed = [_placed(F.col(f"{n}_found"), F.col(text), p).alias(n) for n, p in patterns.items()]
    return matched.select(*df.columns, *placed)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def kinds(spans: dict[str, str]) -> Column:
    """One array of (start, rank, end, kind, value) over columns of spans, in the order of the kinds, sorted."""

    def named(col: str, rank: int, kind: str) -> Column:
        return F.transform(
            F.col(col),
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["value"].alias("value")
            ),
        )

    each = [named(col, rank, kind) for rank, (kind, col) in enumerate(spans.items())]
    return F.array_sort(F.concat(*each))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, parted by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def apart_from(spans: Column, others: Column) -> Column:
    """Spans that overlap none of the others."""
    return F.filter(spans, lambda s: ~F.exists(others, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])))
