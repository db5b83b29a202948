"""Helpers shared by the operators: tables, stored intermediates, words, hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewright.session import scratch_path

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Above this many rows a side is joined by shuffle.
SMALL_ROWS = 1_000_000


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a stored side after a check of its size; beyond it Spark joins by shuffle."""
    return F.broadcast(df) if rows <= SMALL_ROWS else df


def over_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """Apply ``fn`` to each Arrow batch; it yields dicts of column arrays."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in fn(batch):
                arrays = [pa.array(columns[f.name], type=f.type, from_pandas=False) for f in target]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, schema)


def some_text(col: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHashes:
    """64-bit hashes of words, remembered up to a fixed number of words."""

    def __init__(self, limit: int = 400_000, digest: Callable[[bytes], int] | None = None):
        from xxhash import xxh3_64_intdigest

        self.digest, self.limit, self.known = digest or xxh3_64_intdigest, limit, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known, digest = self.known, self.digest
        if len(known) > self.limit:
            known.clear()
        for w in set(words).difference(known):
            known[w] = digest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def white_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; ``bytes.split`` knows just these blanks."""
    return text.encode().split() if text else []
