"""Envelope and publish the rows of a feature table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from pulsewright.sinks.envelope import cloud_event, to_messages


def publish(
    df: DataFrame,
    source: str | None = None,
    type: str | None = None,
    project: str | None = None,
    attributes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Messages ready to write; enveloped when a ``source`` is given."""
    rows = df if source is None else cloud_event(df, source, type, project)
    return to_messages(rows, attributes)


def send(messages: DataFrame, format: str, **options: str) -> None:
    """Write messages with any Spark sink, e.g. a broker or text files."""
    rows = messages.select("value") if format == "text" else messages
    rows.write.format(format).options(**options).mode("append").save()
