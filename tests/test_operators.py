"""Interval joins, quantiles and descriptive statistics against brute force."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsewright.operators.describe import box_stats, describe_col, histogram
from pulsewright.operators import intervals, quantiles
from pulsewright.operators.intervals import BUCKET, SALT, WIDTH_FACTOR, bucket_intervals, hot_buckets, points_in_intervals, used_widths
from pulsewright.operators.quantiles import exact_quantiles
from pulsewright.operators.relational import aggregate_table, cohort, outer_all, valid_bpm, value_counts

T0 = datetime(2024, 1, 1)


def moment(seconds):
    return str(T0 + timedelta(seconds=seconds))


@pytest.fixture(scope="module")
def interval_data(make):
    rnd = random.Random(3)
    # One key and one bucket hold most of the points.
    points = [(1 if rnd.random() < 0.7 else rnd.randrange(2, 6), rnd.randrange(600) if rnd.random() < 0.5 else rnd.randrange(90000), i) for i in range(600)]
    spans = []
    for i in range(150):
        lo = rnd.randrange(90000)
        spans.append((1 if rnd.random() < 0.5 else rnd.randrange(2, 7), lo, lo + rnd.choice([-5, 0, 30, 600, 5000]), i))
    left = make([(k, moment(t), i) for k, t, i in points], "pim_id bigint,at timestamp_ntz,point int")
    right = make([(k, moment(a), moment(b), i) for k, a, b, i in spans], "pim_id bigint,lo timestamp_ntz,hi timestamp_ntz,span int")
    pairs = [(p, s) for k, t, p in points for k2, a, b, s in spans if k == k2 and a <= t <= b]
    return left, right, pairs, {p for _, _, p in points}


@pytest.mark.parametrize("broadcast", [True, False])
def test_inner_and_left_interval_join(spark, interval_data, broadcast):
    left, right, pairs, everyone = interval_data
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m" if broadcast else "-1")
    try:
        got = points_in_intervals(left, right, "pim_id", "at", "lo", "hi").select("point", "span").collect()
        assert sorted((r.point, r.span) for r in got) == sorted(pairs)
        clip = tuple(F.lit(T0 + timedelta(days=d)).cast("timestamp_ntz") for d in (-1, 3))
        kept = points_in_intervals(left, right, "pim_id", "at", "lo", "hi", how="left", clip=clip).select("point", "span")
        unmatched = [(p, -1) for p in everyone - {p for p, _ in pairs}]
        assert sorted((r.point, -1 if r.span is None else r.span) for r in kept.collect()) == sorted(pairs + unmatched)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")


def values(kind, n, rnd):
    if kind == "ties":
        return [float(rnd.choice([1, 1, 1, 2, 5])) for _ in range(n)]
    if kind == "wide":
        return [10.0 ** rnd.uniform(-6, 12) for _ in range(n)]
    if kind == "constant":
        return [4.25] * n
    if kind == "outlier":
        return [rnd.gauss(100, 20) for _ in range(n - 1)] + [1e15]
    return [rnd.gauss(0, 1) for _ in range(n)]


def test_quantiles_match_numpy(spark):
    rnd = random.Random(9)
    data = {k: values(k, n, rnd) for k, n in (("ties", 301), ("wide", 200), ("constant", 5), ("normal", 998), ("outlier", 700))}
    data["single"] = [7.0]
    rows = [(k, v) for k, vs in data.items() for v in vs] + [("normal", None), ("normal", float("nan"))]
    frame = spark.createDataFrame(rows, "kind string, v double")
    probs, names = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0], list("abcdef")
    for few in (True, False):
        got = exact_quantiles(frame, "v", probs, names, ["kind"]).collect()
        assert len(got) == len(data)
        for r in got:
            assert [r[n] for n in names] == pytest.approx(list(np.quantile(data[r.kind], probs)), rel=1e-12)
    whole = exact_quantiles(frame, "v", [0.5], ["m"]).first()
    assert whole.m == pytest.approx(np.median([v for vs in data.values() for v in vs]), rel=1e-12)


@pytest.mark.parametrize("stride", [1, 3, 1024])
def test_running_sums_over_strides(spark, monkeypatch, stride):
    monkeypatch.setattr(quantiles, "SLOTS_PER_STRIDE", stride)
    rnd = random.Random(2)
    rows = [(g, slot, rnd.randrange(9)) for g in ("a", None) for slot in rnd.sample(range(-50, 50), 40)]
    frame = spark.createDataFrame(rows, "g string, s long, c long")
    got = {(r.g, r.s): (r.below, r._whole) for r in quantiles.running_sum(frame, ["g"], "s", "c", "below").collect()}
    total = lambda g: sum(c for q, _, c in rows if q == g)
    assert got == {(g, s): (sum(c for q, t, c in rows if q == g and t < s), total(g)) for g, s, _ in rows}
    facts = {"most": (F.max, "c"), "sum": (F.sum, "c")}
    spread = quantiles.over_group(frame.withColumnRenamed("s", "_slot"), ["g"], facts).select("g", "most", "sum").distinct()
    assert sorted(map(tuple, spread.collect()), key=str) == sorted(
        [(g, max(c for q, _, c in rows if q == g), total(g)) for g in ("a", None)], key=str
    )


@pytest.mark.parametrize("stride", [2, 1024])
def test_box_and_summary_with_many_strides(spark, monkeypatch, stride):
    monkeypatch.setattr(quantiles, "SLOTS_PER_STRIDE", stride)
    rnd = random.Random(8)
    data = {g: values(g, 300, rnd) for g in ("wide", "normal", "outlier", "ties")}
    frame = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs], "g string, v double")
    for r in box_stats(frame, ["g"], "v").collect():
        q1, med, q3 = np.quantile(data[r.g], [0.25, 0.5, 0.75])
        inside = [v for v in data[r.g] if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
        assert [r.q1, r.median, r.q3] == pytest.approx([q1, med, q3], rel=1e-12)
        assert (r.whisker_low, r.whisker_high) == pytest.approx((min(min(inside), q1), max(max(inside), q3)), rel=1e-12)
    for r in describe_col(frame, "v", ["g"]).collect():
        assert r["mean"] == pytest.approx(np.mean(data[r.g]), rel=1e-12) and r.sd == pytest.approx(np.std(data[r.g], ddof=1), rel=1e-9)


def test_describe(spark):
    frame = spark.createDataFrame([(1.0,), (4.0,), (None,), (10.0,)], "v double")
    row = describe_col(frame, "v").first()
    assert (row.row_count, row.null_count, row["min"], row["max"], row.median) == (4, 1, 1.0, 10.0, 4.0)
    assert row.sd == pytest.approx(np.std([1, 4, 10], ddof=1)) and row["mean"] == 5.0


def test_histogram_matches_numpy(spark):
    rnd = random.Random(1)
    sample = [float(rnd.randrange(0, 151)) for _ in range(400)] + [0.0, 150.0, 3.3]
    rows = histogram(spark.createDataFrame([(v,) for v in sample], "v double"), "v", 150).orderBy("bin").collect()
    counts, edges = np.histogram(sample, bins=150, range=(min(sample), max(sample)))
    assert [r.frequency for r in rows] == list(counts)
    assert [r.bin_start for r in rows] == pytest.approx(list(edges[:-1]))
    flat = histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v", 4).orderBy("bin").collect()
    assert [r.frequency for r in flat] == list(np.histogram([2.0, 2.0], bins=4)[0])


def test_box(spark):
    sample = [1.0, 2.0, 3.0, 4.0, 100.0]
    row = box_stats(spark.createDataFrame([("a", v) for v in sample], "g string, v double"), ["g"], "v").first()
    assert (row.q1, row.median, row.q3, row.whisker_low, row.whisker_high) == (2.0, 3.0, 4.0, 1.0, 4.0)


def test_tables(spark):
    frame = spark.createDataFrame([(1, 2.0), (1, 4.0), (None, 9.0)], "participant_id bigint, v double")
    own = aggregate_table(frame, "v", "participant_id", {"span": lambda c: F.max(c) - F.min(c)})
    assert [tuple(r) for r in own.collect()] == [(1, 2.0)]
    other = spark.createDataFrame([(2, 5)], "participant_id bigint, w int")
    both = outer_all([own, other]).orderBy("participant_id").collect()
    assert [tuple(r) for r in both] == [(1, 2.0, None), (2, None, 5)]
    people = spark.createDataFrame([(1,), (1,)], "participant_id bigint")
    assert cohort(frame, people, "participant_id").count() == 2
    assert [tuple(r) for r in value_counts(frame.filter("v < 9"), "participant_id").collect()] == [(1, 2)]


def test_long_intervals_are_listed_a_few_dozen_times(make):
    day = lambda n: f"{n:04d}-01-01 00:00:00"
    spans = make(
        [(1, day(1930), day(2030)), (1, day(2024), "2024-01-01 08:00:00"), (1, day(1), day(9999)), (1, day(2024), day(2024))],
        "k bigint,lo timestamp_ntz,hi timestamp_ntz",
    )
    rows = bucket_intervals(spans, F.col("lo"), F.col("hi"), 600, widths=True)
    most = rows.groupBy("lo", "hi").count().agg(F.max("count")).first()[0]
    assert most <= WIDTH_FACTOR + 1


def test_join_without_bounds_loses_no_pair(make):
    rnd = random.Random(3)
    at = lambda s: (datetime(2024, 1, 1) + timedelta(seconds=s)).isoformat(" ", "microseconds")
    points = [(rnd.randint(0, 2), rnd.randint(-10**9, 10**9)) for _ in range(200)] + [(0, 0), (0, 600), (1, 600 * 48)]
    spans = []
    for _ in range(80):
        lo = rnd.choice([p[1] for p in points]) - rnd.choice([0, 1, 599, 10**4, 10**7])
        spans.append((rnd.randint(0, 2), lo, lo + rnd.choice([0, 600, 28_800, 28_801, 10**6, 10**8, 2 * 10**9])))
    got = points_in_intervals(
        make([(k, at(t)) for k, t in points], "k bigint,t timestamp_ntz"),
        make([(k, at(a), at(b)) for k, a, b in spans], "k bigint,lo timestamp_ntz,hi timestamp_ntz"),
        "k",
        "t",
        "lo",
        "hi",
    ).count()
    assert got == sum(k == q and a <= t <= b for k, t in points for q, a, b in spans)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_buckets_are_salted_and_no_pair_is_lost(interval_data, how):
    left, right, pairs, everyone = interval_data
    clip = tuple(F.lit(T0 + timedelta(days=d)).cast("timestamp_ntz") for d in (-1, 3))
    met = points_in_intervals(left, right, "pim_id", "at", "lo", "hi", how, clip=clip, largest=20, most=10)
    got = met.select("point", "span").collect()
    unmatched = [] if how == "inner" else [(p, -1) for p in everyone - {p for p, _ in pairs}]
    assert sorted((r.point, -1 if r.span is None else r.span) for r in got) == sorted(pairs + unmatched)
    if how == "left":
        by_bucket = met.groupBy("pim_id", BUCKET).agg(F.countDistinct(SALT).alias("salts"), F.countDistinct("point").alias("n"))
        rows = by_bucket.collect()
        assert max(r.salts for r in rows) > 1 and all(r.salts == 1 for r in rows if r.n <= 20)


def test_intervals_are_copied_for_hot_buckets_only(make):
    points = make([(1, moment(i % 600), i) for i in range(900)] + [(1, moment(6000), 900), (2, moment(10), 901)], "k bigint,at timestamp_ntz,point int")
    spans = make([(1, moment(0), moment(900)), (1, moment(6000), moment(6100)), (2, moment(0), moment(50))], "k bigint,lo timestamp_ntz,hi timestamp_ntz")
    bucketed = intervals.bucket_points(points, "at")
    hot = hot_buckets(bucketed, "k", largest=300, most=10)
    assert [(r._hotkey, r._salts) for r in hot.collect()] == [(1, 3)]
    listed = intervals._salted(
        bucket_intervals(spans, F.col("lo"), F.col("hi")), hot, "k", F.explode(F.sequence(F.lit(0).cast("long"), intervals._salts() - 1))
    )
    copies = sorted(r["count"] for r in listed.groupBy("k", "lo", BUCKET).count().collect())
    # The hot bucket's interval thrice; its other bucket and all other intervals once.
    assert copies == [1, 1, 1, 3]
    # However many points: at most ``most`` buckets are hot.
    assert [r._salts for r in hot_buckets(bucketed, "k", largest=1, most=1).collect()] == [900]
    assert hot_buckets(bucketed.limit(0), "k").isEmpty()


def test_points_are_listed_for_used_widths_only(make):
    spans = make([(1, moment(0), moment(300)), (1, moment(0), moment(7 * 3600))], "k bigint,lo timestamp_ntz,hi timestamp_ntz")
    points = make([(1, moment(t), t) for t in (0, 100, 400)], "k bigint,at timestamp_ntz,point int")
    widths = used_widths(spans, F.col("lo"), F.col("hi"))
    assert intervals.bucket_points(points, "at", widths=widths).count() == 3
    long = spans.unionByName(make([(1, moment(0), moment(10**7))], "k bigint,lo timestamp_ntz,hi timestamp_ntz"))
    assert intervals.bucket_points(points, "at", widths=used_widths(long, F.col("lo"), F.col("hi"))).count() == 6
    assert points_in_intervals(points, spans.limit(0), "k", "at", "lo", "hi").isEmpty()
    with pytest.raises(ValueError, match="inner"):
        points_in_intervals(points, spans, "k", "at", "lo", "hi", how="left")


def test_readings_that_are_no_numbers_fall_below_the_cut(spark):
    rows = spark.createDataFrame([(float("nan"),), (39.9,), (40.0,), (None,), (60.5,)], "bpm double")
    assert sorted(r.bpm for r in valid_bpm(rows).collect()) == [40.0, 60.5]


def test_merged_intervals(make):
    at = lambda m: f"2021-05-03 06:{m:02d}:00"
    rows = [(1, at(0), at(9)), (1, at(1), at(2)), (1, at(5), at(12)), (1, at(12), at(13)), (1, at(14), at(15)), (1, at(14), at(15)), (2, at(9), at(8)), (2, at(9), None)]
    frame = make(rows, "pim_id bigint,lo timestamp_ntz,hi timestamp_ntz")
    got = sorted((r.pim_id, r.lo.minute, r.hi.minute) for r in intervals.merged_intervals(frame, ["pim_id"], "lo", "hi").collect())
    assert got == [(1, 0, 13), (1, 14, 15)]


def test_interval_moments_equal_pairs(spark):
    rnd = random.Random(5)
    # Many on whole seconds, bucket edges and before 1970; ends differ by a microsecond from points.
    moment = lambda: rnd.randrange(-90, 90) * 10_000_000 + rnd.choice((0, 0, 1, -1))
    points = [(rnd.randrange(2), moment(), rnd.randrange(40, 180)) for _ in range(300)] + [(None, 0, 1)]
    spans = []
    for i in range(200):
        lo = moment()
        spans.append((i, rnd.randrange(2), lo, lo + rnd.choice((0, 59_999_999, 60_000_000, 300_000_000, rnd.randrange(-9, 900_000_000)))))
    ntz = lambda c: F.timestamp_micros(c).cast("timestamp_ntz").alias(c)
    p = spark.createDataFrame(points, "k long, t long, v long").select("k", ntz("t"), "v")
    s = spark.createDataFrame(spans, "i long, k long, lo long, hi long").select("i", "k", ntz("lo"), ntz("hi"))
    want = {}
    for i, k, lo, hi in spans:
        held = [v for pk, t, v in points if pk == k and lo <= t <= hi]
        if held:
            want[i] = (len(held), sum(held), sum(v * v for v in held), min(held), max(held))
    for seconds in (60, 600):
        got = intervals.interval_moments(p, s, "k", "t", "v", "lo", "hi", ["i", "k"], seconds)
        assert {r.i: (r.n, r.total, r.squares, r.least, r.greatest) for r in got.collect()} == want
    by_key = intervals.interval_moments(p, s, "k", "t", "v", "lo", "hi", ["k"], 60).collect()
    assert sum(r.n for r in by_key) == sum(w[0] for w in want.values()) and len(by_key) == 2


def test_pairs_of_few_points_are_made_in_several_tasks(spark):
    points = spark.range(200).selectExpr("id as point", "id % 2 * 0 as k", "timestamp_ntz'2024-01-01' + id * interval '7' minute as at")
    spans = points.selectExpr("k", "point as span", "at as lo", "at + interval '3' hour as hi")
    set_back = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = points_in_intervals(points, spans, "k", "at", "lo", "hi")
        tasks = met.select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", set_back)
    assert len(tasks) > 1
    assert sum(r["count"] for r in tasks) == sum(min(26, 200 - i) for i in range(200))


def test_folded_intervals_meet_a_point_once_and_take_no_shuffle_of_their_own(make):
    points = make([(1, "2021-05-03 06:00:00"), (1, "2021-05-03 08:30:00"), (1, "2021-05-03 08:30:01"), (2, "2021-05-03 06:00:00")], "k bigint,at timestamp_ntz")
    rows = [(1, d, f"2021-05-03 0{h}:{m:02d}:00", "2021-05-03 08:30:00") for d in ("x", "y") for h in (5, 6) for m in (0, 20, 40)]
    rows += [(1, "x", "2021-05-03 06:00:00", "2021-05-03 06:00:00"), (1, "y", "2021-05-03 09:00:00", "2021-05-03 07:00:00"), (None, "x", "2021-05-03 05:00:00", "2021-05-03 09:00:00")]
    spans = make(rows, "k bigint,d string,lo timestamp_ntz,hi timestamp_ntz")
    joined = points_in_intervals(points, spans, "k", "at", "lo", "hi", bucket_seconds=3600, fold=["d"])
    got = sorted((str(r["at"])[11:], r["d"]) for r in joined.collect())
    assert got == [("06:00:00", "x"), ("06:00:00", "y"), ("08:30:00", "x"), ("08:30:00", "y")]
    assert set(joined.columns) == {"k", "at", "_bucket", "_salt", "d"}
