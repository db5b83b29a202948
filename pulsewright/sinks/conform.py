"""Schema-checked load: typed columns in schema order, required ones checked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsewright.sources.schemas import FieldList, struct_of


def _typed(value: Column, kind: T.DataType, present: T.DataType | None) -> Column:
    """Cast to ``kind``; struct fields go by name, absent ones become null."""
    if not isinstance(kind, T.StructType) or not isinstance(present, T.StructType):
        return value.cast(kind)
    known = {f.name: f.dataType for f in present}
    fields = [
        (
            _checked(_typed(value[f.name], f.dataType, known[f.name]), f)
            if f.name in known
            else F.lit(None).cast(f.dataType)
        ).alias(f.name)
        for f in kind
    ]
    return F.when(value.isNotNull(), F.struct(*fields))


def _checked(value: Column, target: T.StructField) -> Column:
    if target.nullable:
        return value
    stop = F.raise_error(F.lit(f"required field {target.name} is null")).cast(target.dataType)
    return F.when(value.isNotNull(), value).otherwise(stop)


def conform(df: DataFrame, schema: str | FieldList | T.StructType) -> DataFrame:
    """Select and cast to the schema; unknown columns are an error.

    A nullable field missing from the input becomes null. A null in a required
    field fails the job when the row is read.
    """
    target = schema if isinstance(schema, T.StructType) else struct_of(schema)
    known = {f.name: f.dataType for f in df.schema}
    extra = sorted(set(known) - set(target.fieldNames()))
    if extra:
        raise ValueError(f"columns not in the schema: {', '.join(extra)}")
    cols = []
    for f in target:
        value = _typed(F.col(f.name), f.dataType, known[f.name]) if f.name in known else F.lit(None).cast(f.dataType)
        cols.append(_checked(value, f).alias(f.name))
    return df.select(*cols)
