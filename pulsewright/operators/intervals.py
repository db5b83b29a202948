"""Point-in-interval joins that stay equi-joins.

Open-source Spark has no range join: a BETWEEN condition next to an equality on
the participant compares all pairs of that participant. Here both sides also
meet on a time bucket. A point lies in exactly one bucket, an interval is listed in
each bucket it touches, so a pair meets at most once and no pair is lost.

Buckets with a large share of all points are measured while the job runs; only
their points are dealt to salts, and only their intervals are copied to them. All
other buckets are dealt to as many tasks as the session has shuffle partitions.

Where nothing bounds the length of an interval, buckets come in several widths.
An interval uses the width that suits its length and is listed a few dozen times
at most; a point is listed once for each width that some interval uses.

Sums over the points of an interval need no pairs at all, see ``interval_moments``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsewright.functions.timeops import epoch_seconds

BUCKET = "_bucket"
SALT = "_salt"

DEFAULT_BUCKET_SECONDS = 600

# Points above which a bucket is salted, as long as it is among the greatest ones, and
# the salts of one bucket at most.
LARGEST_BUCKET = 50_000
MOST_HOT = 2000
MOST_SALTS = 1000

# Widths grow by this factor. From ten minutes six of them reach past 10,000 years.
WIDTH_FACTOR = 48
WIDTHS = 6


def bucket_points(
    points: DataFrame, at: str, bucket_seconds: int = DEFAULT_BUCKET_SECONDS, widths: Column | None = None
) -> DataFrame:
    """Add the bucket to the point side.

    With ``widths``, an array of width numbers, a point is listed once for each.
    """
    if widths is None:
        return points.withColumn(BUCKET, _key(F.col(at), bucket_seconds, 0))
    keys = [F.when(F.array_contains(widths, F.lit(k)), _key(F.col(at), bucket_seconds, k)) for k in range(WIDTHS)]
    return points.withColumn(BUCKET, F.explode(F.array(*keys))).filter(F.col(BUCKET).isNotNull())


def hot_buckets(points: DataFrame, key: str, largest: int = LARGEST_BUCKET, most: int = MOST_HOT) -> DataFrame:
    """(key, bucket, ``_salts``) of the buckets with more than ``largest`` points, the ``most`` greatest of them.

    A bucket that is left out holds less than one of ``most`` equal shares of all points.
    So the table is small, however many points there are: safe to broadcast.
    """
    counts = points.groupBy(key, BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.filter(F.col("_n") > largest).orderBy(F.desc("_n"), key, BUCKET).limit(most)
    salts = F.least(F.ceil(F.col("_n") / largest), F.lit(MOST_SALTS).cast("long"))
    return hot.select(F.col(key).alias("_hotkey"), F.col(BUCKET).alias("_hotbucket"), salts.alias("_salts"))


def _salted(rows: DataFrame, hot: DataFrame, key: str, salt: Column) -> DataFrame:
    on = (F.col(key) == F.col("_hotkey")) & (F.col(BUCKET) == F.col("_hotbucket"))
    return rows.join(F.broadcast(hot), on, "left").withColumn(SALT, salt).drop("_hotkey", "_hotbucket", "_salts")


def _salts() -> Column:
    return F.coalesce("_salts", F.lit(1).cast("long"))


def _key(ts: Column, bucket_seconds: int, k: int) -> Column:
    """Number of the bucket of the k-th width; the last decimal keeps widths apart."""
    return F.floor(epoch_seconds(ts) / F.lit(bucket_seconds * WIDTH_FACTOR**k)) * 10 + k


def _width(lo: Column, hi: Column, bucket_seconds: int) -> Column:
    """Number of the narrowest width that lists an interval WIDTH_FACTOR + 1 times at most."""
    length = epoch_seconds(hi) - epoch_seconds(lo)
    width = F.lit(WIDTHS - 1)
    for k in reversed(range(WIDTHS - 1)):
        width = F.when(length <= bucket_seconds * WIDTH_FACTOR ** (k + 1), F.lit(k)).otherwise(width)
    return width


def used_widths(intervals: DataFrame, lo: Column, hi: Column, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> Column:
    """The widths that some interval uses, as an array known when the job runs."""
    used = intervals.filter(lo <= hi).agg(F.collect_set(_width(lo, hi, bucket_seconds))).scalar()
    return F.coalesce(used, F.array().cast("array<int>"))


def bucket_intervals(
    intervals: DataFrame, lo: Column, hi: Column, bucket_seconds: int = DEFAULT_BUCKET_SECONDS, widths: bool = False
) -> DataFrame:
    """List each interval once per bucket it touches.

    Intervals that end before they start, or lack an end, match nothing. With
    ``widths`` each uses its own one, otherwise all use the narrowest.
    """
    step = F.lit(10).cast("long")
    listed = lambda k: F.sequence(_key(lo, bucket_seconds, k), _key(hi, bucket_seconds, k), step)
    buckets = listed(0)
    if widths:
        own, buckets = _width(lo, hi, bucket_seconds), listed(WIDTHS - 1)
        for k in range(WIDTHS - 1):
            buckets = F.when(own == k, listed(k)).otherwise(buckets)
    return intervals.filter(lo <= hi).withColumn(BUCKET, F.explode(buckets))


def points_in_intervals(
    points: DataFrame,
    intervals: DataFrame,
    key: str,
    at: str,
    lo: str,
    hi: str,
    how: str = "inner",
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
    clip: tuple[Column, Column] | None = None,
    spread: Column | None = None,
    condition: Column | None = None,
    largest: int = LARGEST_BUCKET,
    most: int = MOST_HOT,
    fold: Sequence[str] | None = None,
) -> DataFrame:
    """Join points to the intervals that hold them, both ends included.

    Shared columns other than ``key`` are not allowed. ``clip`` narrows the
    bucket list of an interval to the span in which points can match at all,
    which bounds it whatever the interval's length; without it, buckets of
    several widths do, and the join must be an inner one. ``spread`` is any expression that separates the points of one
    hot bucket; by default their own time. ``condition`` is a further test on the pair.
    The bucket and salt keys stay on the result so that a following aggregation can
    include them and needs no new shuffle. For ``largest`` and ``most`` see ``hot_buckets``.

    With ``fold``, columns of the intervals, intervals of a key that are equal in them and overlap
    are one, and only these columns of theirs stay. They fold where they meet the points, bucket
    by bucket, which takes no shuffle of its own; a point meets them once for each width in use.
    """
    first, last = F.col(lo), F.col(hi)
    if clip is not None:
        first, last = F.greatest(first, clip[0]), F.least(last, clip[1])
    elif how != "inner":
        raise ValueError("without clip the join is an inner one")
    known = intervals.filter(F.col(lo).isNotNull() & F.col(hi).isNotNull())
    if how == "inner":
        # Stated here, as the join would add it to the points but not to their counts:
        # both then read one shuffle of whatever came before.
        points = points.filter(F.col(key).isNotNull() & F.col(at).isNotNull())
    widths = None if clip is not None else used_widths(known, first, last, bucket_seconds)
    left = bucket_points(points, at, bucket_seconds, widths)
    if how == "inner":
        left = left.filter(F.col(BUCKET).isNotNull())
    right = bucket_intervals(known, first, last, bucket_seconds, widths is not None)
    hot = hot_buckets(left, key, largest, most)
    spread = F.col(at) if spread is None else spread
    left = _salted(left, hot, key, F.pmod(F.xxhash64(spread), _salts()))
    # Copies are made for hot buckets only.
    right = _salted(right, hot, key, F.explode(F.sequence(F.lit(0).cast("long"), _salts() - 1)))
    keys = [key, BUCKET, SALT]
    # Pairs can be many times their input. By the size of the input alone Spark would put
    # buckets together until one task makes all pairs; a stated number keeps them apart.
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = left.repartition(parts, *keys)
    if fold is None:
        right, inside = right.repartition(parts, *keys), F.col(at).between(F.col(lo), F.col(hi))
    else:
        right, inside = _folded(right, keys, lo, hi, fold, bucket_seconds), _micros(at).between(F.col("_lo"), F.col("_hi"))
    right = right.withColumnsRenamed({k: f"_iv{k}" for k in keys})
    on = inside
    for k in keys:
        on = on & (F.col(k) == F.col(f"_iv{k}"))
    if condition is not None:
        on = on & condition
    joined = left.join(right, on, how).drop(*[f"_iv{k}" for k in keys])
    return joined if fold is None else joined.drop("_lo", "_hi")


def _micros(name: str) -> Column:
    return F.unix_micros(F.col(name).cast("timestamp"))


def _folded(listed: DataFrame, keys: Sequence[str], lo: str, hi: str, by: Sequence[str], bucket_seconds: int) -> DataFrame:
    """``keys``, ``by`` and disjoint spans ``_lo`` to ``_hi`` of intervals listed by bucket.

    An interval that goes on beyond its bucket has no end there, so all that fill a bucket are
    equal and fold before the shuffle.
    """
    own = lambda c: F.coalesce(*[F.when(F.pmod(F.col(BUCKET), F.lit(10)) == k, _key(F.col(c), bucket_seconds, k)) for k in range(WIDTHS)])
    first = F.when(own(lo) < F.col(BUCKET), F.lit(-(1 << 63))).otherwise(_micros(lo))
    last = F.when(own(hi) > F.col(BUCKET), F.lit((1 << 63) - 1)).otherwise(_micros(hi))
    span = F.struct(*by, first.alias("_lo"), last.alias("_hi"))
    met = listed.groupBy(*keys).agg(F.collect_set(span).alias("_spans"))
    spans = met.select(*keys, F.explode("_spans").alias("_span")).select(*keys, "_span.*")
    return merged_intervals(spans, [*keys, *by], "_lo", "_hi")


def merged_intervals(intervals: DataFrame, keys: Sequence[str], lo: str, hi: str) -> DataFrame:
    """The keys and disjoint intervals: those of equal keys that overlap are one. Copies fold too.

    Intervals that end before they start, or lack an end, hold no point and are left out.
    """
    order = Window.partitionBy(*keys).orderBy(lo, hi)
    reached = F.max(hi).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col(lo) <= reached, 0).otherwise(1)
    opened = intervals.filter(F.col(lo) <= F.col(hi)).select(*keys, lo, hi, opens.alias("_opens"))
    numbered = opened.withColumn("_island", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_island").agg(F.min(lo).alias(lo), F.max(hi).alias(hi)).drop("_island")


MOMENTS = ("n", "total", "squares", "least", "greatest")


def interval_moments(
    points: DataFrame,
    intervals: DataFrame,
    key: str,
    at: str,
    value: str,
    lo: str,
    hi: str,
    by: Sequence[str],
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
) -> DataFrame:
    """``by`` and the moments of a whole-number value over the points in intervals, both ends included.

    ``n``, ``total``, ``squares``, ``least``, ``greatest``; groups without a point are left out.
    ``by`` are columns of the intervals and include ``key``; a point counts once for each
    interval that holds it. No pairs are made: in its first bucket an interval holds the
    points from its start on, in its last one those up to its end, and all between. These
    are running sums over a bucket, read at the interval's ends, so the work grows with
    points and intervals and not with their product. Only intervals strictly inside a
    bucket meet its points one by one.
    """
    width = bucket_seconds * 1_000_000
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    bucket = lambda us: F.col(us) - F.pmod(F.col(us), F.lit(width))
    held = points.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).select(
        key, micros(at).alias("_t"), F.col(value).cast("long").alias("_v")
    )
    held = held.withColumn(BUCKET, bucket("_t")).filter(F.col(BUCKET).isNotNull())
    spans = intervals.filter((F.col(lo) <= F.col(hi)) & F.col(key).isNotNull()).select(*by, micros(lo).alias("_lo"), micros(hi).alias("_hi"))
    spans = spans.withColumns({"_first": bucket("_lo"), "_last": bucket("_hi")})

    one = F.col("_first") == F.col("_last")
    from_start, to_end = F.col("_lo") == F.col("_first"), F.col("_hi") == F.col("_last") + (width - 1)
    mark = lambda b, t, side: F.struct(b.alias(BUCKET), t.alias("_t"), F.lit(side).alias("_side"))
    between = F.transform(
        F.sequence(F.col("_first") + width, F.col("_last") - width, F.lit(width).cast("long")), lambda b: mark(b, b + (width - 1), 1)
    )
    start, end = mark(F.col("_first"), F.col("_lo"), -1), mark(F.col("_last"), F.col("_hi"), 1)
    marks = (
        F.when(one, F.when(from_start, F.array(end)).when(to_end, F.array(start)))
        .when(F.col("_last") - F.col("_first") > width, F.concat(F.array(start, end), between))
        .otherwise(F.array(start, end))
    )
    marked = spans.select(*by, F.explode(marks).alias("_m")).select(*by, "_m.*")
    rows = marked.unionByName(held.withColumn("_side", F.lit(0)), allowMissingColumns=True)

    # Points stand before the marks that include them, in either direction.
    here = Window.partitionBy(key, BUCKET)
    upward, downward = here.orderBy("_t", "_side"), here.orderBy(F.desc("_t"), F.desc("_side"))
    v = F.col("_v")
    aggregates = (F.count(v), F.sum(v), F.sum(v * v), F.min(v), F.max(v))
    running = lambda order, tag: {
        f"{tag}{name}": x.over(order.rowsBetween(Window.unboundedPreceding, 0)) for name, x in zip(MOMENTS, aggregates, strict=True)
    }
    read = rows.withColumns(running(upward, "_up_")).withColumns(running(downward, "_down_")).filter("_side <> 0")
    side = lambda name: F.when(F.col("_side") > 0, F.col(f"_up_{name}")).otherwise(F.col(f"_down_{name}"))
    parts = read.select(*by, *[side(m).alias(m) for m in MOMENTS])

    inside = spans.filter(one & ~from_start & ~to_end).withColumnsRenamed({"_first": "_ivbucket", key: "_ivkey"})
    on = (F.col(key) == F.col("_ivkey")) & (F.col(BUCKET) == F.col("_ivbucket")) & F.col("_t").between(F.col("_lo"), F.col("_hi"))
    met = held.join(inside, on).select(
        *by, F.lit(1).cast("long").alias("n"), v.alias("total"), (v * v).alias("squares"), v.alias("least"), v.alias("greatest")
    )
    sums = [F.sum(m).alias(m) for m in MOMENTS[:3]] + [F.min("least").alias("least"), F.max("greatest").alias("greatest")]
    return parts.filter("n > 0").unionByName(met).groupBy(*by).agg(*sums)
