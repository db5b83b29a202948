import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsewright.llm import negatives as h

COLUMNS = "vec_id long, embedding array<float>, label int, shard int, no long, q string"


@pytest.fixture(scope="module")
def rows_as(spark):
    return lambda rows: spark.createDataFrame([(*r, 1, 2, "q") for r in rows], COLUMNS)


def brute(rows, every, k=5, best=3):
    whole = []
    for vec_id, v, label in rows:
        if None not in (vec_id, v, label) and all(x is not None and math.isfinite(x) for x in v):
            row = (vec_id, label, tuple(math.floor(256 * float(np.float32(x))) for x in v))
            if row not in whole:
                whole.append(row)
    dot = lambda a, b: sum(x * y for x, y in zip(a[2], b[2]))
    out = []
    for a in whole:
        if a[0] % every:
            continue
        same = sorted((-dot(a, b), b[0]) for b in whole if b[1] == a[1] and b[0] != a[0])[:k]
        for ps, pid in same:
            other = sorted((-dot(a, b), b[0]) for b in whole if b[1] != a[1] and -50 * ps <= 100 * dot(a, b) <= -95 * ps)[:best]
            out += [(a[0], pid, i + 1, nid, -ps, -ns) for i, (ns, nid) in enumerate(other)]
    return sorted(out)


def vectors(n, dims, seed, hot=0.3, coarse=False):
    r = random.Random(seed)
    value = (lambda: r.randint(-2, 2) / 256) if coarse else (lambda: r.gauss(0, 0.3))
    return [(i, [value() for _ in range(dims)], 0 if r.random() < hot else r.randrange(6)) for i in range(n)]


def odd_rows():
    yield from [(None, [1.0], 1), (500, None, 1), (510, [1.0, None], 1), (520, [float("nan")], 1), (530, [float("inf")], 2), (540, [1.0], None)]
    yield from [(550, [], 1), (560, [0.0] * 8, 1), (570, [0.5, -0.5], 1), (570, [0.5, -0.5], 1), (571, [0.25] * 12, 2)]


@pytest.mark.parametrize("coarse", [False, True])
@pytest.mark.parametrize("shard", [4096, 30])
def test_against_brute_force(rows_as, rows_of, monkeypatch, coarse, shard):
    monkeypatch.setattr(h, "SHARD_ROWS", shard)
    monkeypatch.setattr(h, "BLOCK_ANCHORS", 4)
    monkeypatch.setattr(h, "FIRST_DEPTH", 2)
    rows = vectors(300, 8, 1, coarse=coarse) + list(odd_rows())
    got = h.hard_negatives(rows_as(rows).repartition(4), every=10)
    assert rows_of(got) == brute(rows, 10)


def test_many_copies_of_one_vector(rows_as, rows_of):
    rows = vectors(40, 4, 2) + [(100 + i, [0.5, 0.5, 0.0, 0.1], i % 3) for i in range(150)]
    assert rows_of(h.hard_negatives(rows_as(rows), every=10)) == brute(rows, 10)


def test_stops_before_all_rows_are_met():
    r = np.random.default_rng(3)
    x = r.integers(-50, 50, (5000, 3))
    x[:10] += 400
    met = []
    shard = h.Shard(x.astype(np.int64))
    inner = shard.met
    shard.met = lambda a: ((met.append(len(f)), (f, s, t))[1] for f, s, t in inner(a))
    best = h.best_in_windows(shard, np.array([1, 2, 0]), np.arange(5000), np.ones(5000, bool), [(None, None)], 5)[0]
    scores = x @ np.array([1, 2, 0])
    assert [s for _, s in best] == sorted(scores.tolist(), reverse=True)[:5]
    assert sum(met) < 500


def test_scores_stay_exact(rows_as, rows_of):
    big = [(i, [2.0**20 + i, -(2.0**20), i / 256], i % 3) for i in range(60)]
    assert rows_of(h.hard_negatives(rows_as(big), every=10)) == brute(big, 10)
    x, y = h.exact_types(np.array([[2**40]]), np.array([[2**40]]))
    assert (x @ y.T)[0, 0] == 2**80


def test_repeated_ids_and_too_large_components(rows_as):
    rows = [(0, [1.0], 1), (0, [0.5], 1), (1, [1.0], 1), (2, [0.75], 2), (3, [0.5], 2)]
    got = h.hard_negatives(rows_as(rows)).filter("anchor_id = 0").collect()
    assert {r["positive_id"] for r in got} == {1} and {r["positive_score"] for r in got} == {65536, 32768}
    with pytest.raises(Exception, match="64 bits"):
        h.hard_negatives(rows_as([(0, [1e30], 1), (1, [1e30], 1)])).collect()


def test_empty(rows_as):
    assert h.hard_negatives(rows_as([])).count() == 0
    assert h.hard_negatives(rows_as([(1, [1.0], 1)])).count() == 0


def test_labels_move_by_the_query(spark, tmp_path):
    rows = spark.createDataFrame([(i, [float(i)], i % 10) for i in range(1, 120)], "vec_id long, embedding array<float>, label int")
    rows.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = h.op13_threshold_hard_negatives(spark, str(tmp_path))
    # 50 has label 0 and meets 7-multiples of label 9, which move to 0, not 70, which moves to 1.
    ids = {r[0] for r in got.filter("anchor_id = 50").select("positive_id").collect()}
    assert ids == {119, 110, 100, 90, 80}
    assert got.filter(F.col("positive_score") < F.col("negative_score")).count() == 0
