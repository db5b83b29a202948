"""Sharding by proportional stratified interleaving.

Rows of each source are put in a seeded random order; a row's fractional rank is
its place there, (rank + u) / rows of the source, with a seeded u from 0 to 1 for each
source. Sorting all rows by it mixes the sources evenly, so any contiguous cut holds
each source in its overall share; u spreads sources of one or few rows over all places.
The sorted sequence is cut into shards whose row counts differ by one at most.

Both ranks are exact and distributed: rows are dealt to fine buckets of the sort
key, bucket counts (a bounded table) give each bucket's first rank, and only rows
of one bucket are sorted together. A source that holds most rows is spread over
all buckets like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsewright.llm.common import stored, table

LAW = "rows"


def _ranked(df: DataFrame, group: list[str], bucket: Column, order: list[Column], name: str) -> DataFrame:
    """Add the exact rank from 0 in ``group`` by (bucket, order) and the group's size."""
    rows = df.withColumn("_bucket", bucket)
    keys = [*group, "_bucket"]
    whole = Window.partitionBy(*[F.col(g) for g in group]) if group else Window.partitionBy(F.lit(0))
    # Bucket counts: at most `buckets` rows per group, whatever the number of rows.
    first = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(whole.orderBy("_bucket")) - F.col("_n"))
        .withColumn(f"{name}_of", F.sum("_n").over(whole))
    )
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    other = first.select(*[F.col(k).alias(f"_r{k}") for k in keys], "_before", f"{name}_of")
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_r{k}"))
        on = same if on is None else on & same
    placed = rows.withColumn("_inside", inside).join(other, on)
    return placed.withColumn(name, (F.col("_before") + F.col("_inside")).cast("long")).drop(
        "_bucket", "_inside", "_before", *[f"_r{k}" for k in keys]
    )


def interleave(
    docs: DataFrame,
    shards: int = 16,
    seed: int = 17,
    buckets: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot, grown_shard, source.

    A null source is a stratum of its own, a null text has size 1 and the crc of
    no bytes. Rows with a null id are shuffled by their place in the input, so that they
    are spread however many they are; all others by id. Repeated rows are separate rows;
    ties are ordered by id, crc and size, so only fully equal rows could change places. Other columns are ignored; an empty table gives no rows.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    unnamed = F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string"))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.col(source_col).alias("source"),
        F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), unnamed))).alias("_key"),
    )
    # Texts are read once; from here on rows are small.
    rows = stored(rows, "shard-rows")
    ties = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    drawn = lambda key: F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    # The leading digits are the order; a bucket is a range of them.
    shuffled = F.shiftright(drawn("_key") * buckets, 32)
    phase = drawn(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("source").cast("string")))) / F.lit(1 << 32)
    by_source = _ranked(rows, ["source"], shuffled, [F.col("_key"), *ties], "rank")
    part = by_source.withColumn("_share", (F.col("rank") + phase) / F.col("rank_of"))
    fine = F.least(F.floor(F.col("_share") * buckets), F.lit(buckets - 1))
    placed = _ranked(part, [], fine, [F.col("_share"), F.col("_key"), *ties, F.col("source")], "place")
    at = F.col("place")
    # The first place of a shard is the smallest p with p * shards >= shard * n.
    exact = F.expr(f"(place * {shards}) div place_of")
    start = F.expr(f"(shard * place_of + {shards - 1}) div {shards}")
    return placed.withColumn("shard", exact.cast("int")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (at - start).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 17, id_col: str = "doc_id") -> DataFrame:
    """Write documents as ``shard=k`` folders, in slot order; returns the placement.

    Ids must be unique here, as texts are found again by id.
    """
    placed = stored(interleave(docs, shards, seed, id_col=id_col), "shard-placement")
    at = placed.select(F.col("doc_id").alias("_id"), "shard", "slot")
    full = docs.join(at, F.col(id_col) == F.col("_id")).drop("_id")
    full.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return placed


def op10_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleave(table(spark, sf_dir, "documents")).drop("source")
