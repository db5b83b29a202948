"""Hard-negative mining with the threshold algorithm on sorted dimensions.

A score is an integer inner product, a sum that grows with each dimension the anchor
weighs positively and falls with each it weighs negatively. Candidates are dealt into
shards of some thousand rows; a shard keeps one list per dimension, sorted by value. For an
anchor the lists are read from the side that its sign favours, all to the same depth;
a row met for the first time is fetched and scored whole. What no list has shown yet
scores at most the sum over dimensions of the anchor's component times the value at
that depth, the threshold. A shard is done for an anchor once the threshold lies strictly below
the lowest score each of its windows still needs, so ties at that score have been met.
Depths grow fourfold; components of zero order nothing and their lists are not read.

The positives of an anchor are one window without bounds over the shards of its label.
Each positive then gives a window of scores for rows of other labels, over shards of
all rows. The best rows of the shards meet in a ranking in Spark, a few per shard.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsewright.llm.common import small, stored, table

POSITIVES = 5
NEGATIVES = 3
# Rows of a shard and anchors of a block, on average.
SHARD_ROWS = 4096
BLOCK_ANCHORS = 1024
FIRST_DEPTH = 32


def quantised(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, q, no): components as floor(256 * x); rows that take no part are left out.

    ``no`` tells rows apart that share an id; equal rows merge.
    """
    x = F.col(vector_col)
    usable = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    whole = lambda v: F.when(F.abs(256 * v) < 2.0**63, F.floor(256 * v)).otherwise(
        F.raise_error(F.lit("a component does not fit 64 bits")).cast("long")
    )
    q = F.transform(x.cast("array<double>"), whole)
    rows = rows.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull())
    rows = rows.filter(F.forall(x.cast("array<double>"), lambda v: F.coalesce(usable(v), F.lit(False))))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), q.alias("q"))
    return rows.distinct().withColumn("no", F.xxhash64("vec_id", "label", "q"))


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled with zeros."""
    lists = lists.combine_chunks()
    offsets, flat = lists.offsets.to_numpy(), lists.flatten().to_numpy()
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def exact_types(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides in the fastest type whose inner products are exact; beyond 64 bits Python integers."""
    high = lambda m: max(int(m.max(initial=0)), -int(m.min(initial=0)))
    bound = x.shape[1] * high(x) * high(y)
    kind = next((t for limit, t in ((2**24, np.float32), (2**53, np.float64), (2**63, np.int64)) if bound < limit), object)
    return x.astype(kind), y.astype(kind)


class Shard:
    """Candidate rows with their sorted lists."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, self.order, axis=0)

    def met(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
        """Per depth: newly met rows, their scores, and the threshold for the rest (None if no rest)."""
        n = len(self.vectors)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        seen, done, depth = np.zeros(n, bool), 0, FIRST_DEPTH
        while True:
            before, depth = done, min(depth, n)
            hit = np.zeros(n, bool)
            hit[self.order[n - depth : n - before, up].ravel()] = True
            hit[self.order[before:depth, down].ravel()] = True
            if not len(up) and not len(down):
                hit[:] = True
            fresh = np.flatnonzero(hit & ~seen)
            seen[fresh] = True
            done = depth
            rest = None
            if depth < n and not seen.all():
                # No unmet row is better in any list than the last value read there.
                rest = int(self.sorted[n - depth, up] @ anchor[up]) + int(self.sorted[depth - 1, down] @ anchor[down])
            yield fresh, self.vectors[fresh] @ anchor, rest
            if rest is None:
                return
            depth *= 4


def best_in_windows(
    shard: Shard, anchor: np.ndarray, ids: np.ndarray, allowed: np.ndarray, windows: list[tuple[int | None, int | None]], k: int
) -> list[list[tuple[int, int]]]:
    """Per window the (row, score) of its best k allowed rows, by falling score, then rising id."""
    rows, scores = np.empty(0, np.int64), np.empty(0, shard.vectors.dtype)

    def best(lo: int | None, hi: int | None) -> np.ndarray:
        inside = np.flatnonzero((lo is None or scores >= lo) & (hi is None or scores <= hi) & np.ones(len(scores), bool))
        if len(inside) > k:
            # Ties at the kth score stay in until ids decide.
            inside = inside[scores[inside] >= np.partition(scores[inside], -k)[-k]]
        return inside[np.lexsort((ids[rows[inside]], -scores[inside]))][:k]

    for fresh, found, rest in shard.met(anchor):
        keep = allowed[fresh]
        rows, scores = np.concatenate([rows, fresh[keep]]), np.concatenate([scores, found[keep]])
        tops = [best(lo, hi) for lo, hi in windows]
        # Below its lower end a window needs nothing, full or not.
        need = [lo if len(t) < k else int(scores[t[-1]]) for t, (lo, _) in zip(tops, windows)]
        if rest is None or all(n is not None and rest < n for n in need):
            return [[(int(rows[i]), int(scores[i])) for i in t] for t in tops]
    return [[] for _ in windows]


def _cells(
    shards: DataFrame, anchors: DataFrame, keys: list[str], mine: Callable[[Shard, np.ndarray, dict, dict], Iterator[tuple]], schema: str
) -> DataFrame:
    """Run ``mine`` for every anchor on every shard that shares its keys, a block of anchors at a time."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            width = max(int(np.diff(t.column("q").combine_chunks().offsets.to_numpy()).max()) for t in (left, right))
            x, y = exact_types(_matrix(left.column("q"), width), _matrix(right.column("q"), width))
            side = {c: left.column(c).to_numpy() for c in ("vec_id", "label", "no")}
            shard = Shard(x)
            for i, row in enumerate(right.drop_columns(["q"]).to_pylist()):
                out += mine(shard, y[i], side, row)
        return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), target)] if out else [[]] * len(target), schema=target)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))
    return shards.groupBy(*keys).cogroup(anchors.groupBy(*keys)).applyInArrow(run, schema)


def _parts(rows: int | Column, size: int) -> Column:
    rows = F.lit(rows) if isinstance(rows, int) else rows
    return F.greatest(F.ceil(rows / F.lit(size)), F.lit(1).cast("long"))


def _dealt(rows: DataFrame, anchors: DataFrame, sizes: DataFrame | tuple[int, int]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides placed in cells of a shard and a block of anchors, within a label when sizes are per label."""
    keys = ["shard", "block"]
    if isinstance(sizes, DataFrame):
        keys = ["label", *keys]
        count = sizes.count()
        rows, anchors = (df.join(small(sizes, count), "label") for df in (rows, anchors))
        shards, blocks = _parts(F.col("rows"), SHARD_ROWS), _parts(F.col("anchors"), BLOCK_ANCHORS)
    else:
        shards, blocks = _parts(sizes[0], SHARD_ROWS), _parts(sizes[1], BLOCK_ANCHORS)
    every = lambda parts: F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))
    # Both hashes are of the row itself: equal ids do not meet in one place.
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("no", F.lit(1)), shards)).withColumn("block", every(blocks))
    anchors = anchors.withColumn("block", F.pmod(F.xxhash64("no", F.lit(2)), blocks)).withColumn("shard", every(shards))
    # Columns of their own: both sides come from one frame.
    return rows, anchors.select(*[F.col(c).alias(c) for c in anchors.columns]), keys


def positives(rows: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """(anchor_id, anchor_no, positive_id, positive_score): the best k other rows of the anchor's label."""

    def mine(shard: Shard, anchor: np.ndarray, side: dict, row: dict) -> Iterator[tuple]:
        others = side["vec_id"] != row["vec_id"]
        for i, score in best_in_windows(shard, anchor, side["vec_id"], others, [(None, None)], k)[0]:
            yield row["vec_id"], row["no"], int(side["vec_id"][i]), int(side["no"][i]), score

    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
    of_anchors = anchors.groupBy("label").agg(F.count(F.lit(1)).alias("anchors"))
    sizes = stored(sizes.join(of_anchors, "label"), "negatives-labels")
    placed, asked, keys = _dealt(rows, anchors, sizes)
    schema = "anchor_id long, anchor_no long, positive_id long, positive_no long, positive_score long"
    found = _cells(placed, asked, keys, mine, schema)
    order = Window.partitionBy("anchor_id", "anchor_no").orderBy(F.desc("positive_score"), "positive_id", "positive_no")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def hard_negatives(
    rows: DataFrame,
    every: int = 50,
    positives_per_anchor: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = 50,
    high: int = 95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``. For each of an anchor's
    best rows of its own label, the best rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score; ties by id.
    A negative positive score leaves no such rows, a score of zero those that score zero.

    Rows with a null id, label or vector, or with a null or non-finite component, take no
    part. Equal rows merge; other rows that share an id count each, also as anchors, but
    never as positives of their own id. Shorter vectors count as filled up with zeros.
    Components and scores that do not fit 64 bits raise an error. Extra columns are ignored; without rows
    or anchors there is no result.
    """
    known = stored(quantised(rows, id_col, vector_col, label_col), "negatives-rows")
    anchors = known.filter(F.col("vec_id") % every == 0)
    size = known.agg(F.count(F.lit(1)), F.count_if(F.col("vec_id") % every == 0)).first()

    found = stored(positives(known, anchors, positives_per_anchor), "negatives-positives")
    # At most a handful of positives for an anchor.
    windows = found.groupBy("anchor_id", "anchor_no").agg(
        F.collect_list(F.struct("positive_id", "positive_no", "positive_score")).alias("windows")
    )
    on = (F.col("vec_id") == F.col("anchor_id")) & (F.col("no") == F.col("anchor_no"))
    asked = anchors.join(windows, on).drop("anchor_id", "anchor_no")

    def mine(shard: Shard, anchor: np.ndarray, side: dict, row: dict) -> Iterator[tuple]:
        wanted = [w for w in row["windows"] if w["positive_score"] >= 0]
        bounds = [(-(-low * w["positive_score"] // 100), high * w["positive_score"] // 100) for w in wanted]
        others = side["label"] != row["label"]
        for w, best in zip(wanted, best_in_windows(shard, anchor, side["vec_id"], others, bounds, negatives) if wanted else ()):
            for i, score in best:
                own = row["vec_id"], row["no"], w["positive_id"], w["positive_no"], w["positive_score"]
                yield *own, int(side["vec_id"][i]), int(side["no"][i]), score

    placed, asked, keys = _dealt(known, asked, (size[0], size[1]))
    schema = "anchor_id long, anchor_no long, positive_id long, positive_no long, positive_score long"
    met = _cells(placed, asked, keys, mine, f"{schema}, negative_id long, negative_no long, negative_score long")
    order = Window.partitionBy("anchor_id", "anchor_no", "positive_id", "positive_no").orderBy(
        F.desc("negative_score"), "negative_id", "negative_no"
    )
    ranked = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_threshold_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved))


ORACLE = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    list_inner_product(a.q, b.q)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, other_id AS negative_id, positive_score,
  score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 3
"""
