"""Rows as JSON messages, optionally inside a cloud-event envelope."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JSON_OPTIONS = {"ignoreNullFields": "false"}

# Content type and time format of the envelope.
CONTENT_TYPE = "application/json"
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def cloud_event(df: DataFrame, source: str, type: str, project: str) -> DataFrame:
    """Envelope columns around each row; ``data`` keeps the row as a struct."""
    return df.select(
        F.lit(CONTENT_TYPE).alias("datacontenttype"),
        F.uuid().alias("id"),
        F.lit(source).alias("source"),
        F.lit(type).alias("type"),
        F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), TIME_FORMAT).alias("time"),
        F.lit(project).alias("referenceprojectid"),
        F.struct(*df.columns).alias("data"),
    )


def to_messages(df: DataFrame, attributes: Mapping[str, str] | None = None) -> DataFrame:
    """One message per row: JSON ``value`` and constant ``headers``.

    The column shape is the one of Spark's message-broker sink.
    """
    value = F.to_json(F.struct(*df.columns), JSON_OPTIONS).alias("value")
    if attributes:
        pairs = [
            F.struct(F.lit(k).alias("key"), F.lit(v).cast("binary").alias("value")) for k, v in attributes.items()
        ]
        headers = F.array(*pairs)
    else:
        headers = F.lit(None).cast("array<struct<key:string,value:binary>>")
    return df.select(value, headers.alias("headers"))
