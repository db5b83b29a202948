import random
import zlib

import pytest

from pulsewright.llm import sharding as s


def cases():
    r = random.Random(1)
    rows = [(i, "t" * r.randint(0, 9) + "é" * (i % 3), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(700)]
    return rows + [(None, None, None, None), (None, "x", "en", None), (5, "same", "en", "hot"), (5, "same", "en", "hot"), (9999, "", "de", "")]


@pytest.mark.parametrize("shards", [16, 3])
def test_law_slots_and_mixture(spark, docs_of, shards):
    docs = cases()
    rows = s.interleave(docs_of(docs), shards=shards, buckets=16).collect()
    assert len(rows) == len(docs)
    facts = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, _, _ in docs)
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == facts
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert set(slots) == set(range(shards))
    sizes = [len(v) for v in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    hot = sum(1 for d in docs if d[3] == "hot")
    for k in range(shards):
        own = sum(1 for r in rows if r["shard"] == k and r["source"] == "hot")
        assert abs(own - hot / shards) <= 2


def test_same_result_again_and_for_other_buckets(docs_of):
    frame = docs_of(cases())
    key = lambda df: sorted((str(r["doc_id"]), r["text_crc32"], r["shard"], r["slot"]) for r in df.collect())
    assert key(s.interleave(frame, buckets=16)) == key(s.interleave(frame, buckets=16))


def test_empty_and_few_rows(docs_of):
    assert s.interleave(docs_of([])).count() == 0
    rows = s.interleave(docs_of([(1, "a"), (2, "b")])).collect()
    assert sorted(r["slot"] for r in rows) == [0, 0]


def test_written_shards(spark, docs_of, tmp_path):
    docs = [(i, f"text {i}", "en", f"s{i % 3}") for i in range(50)]
    s.write_shards(docs_of(docs), str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and {r["shard"] for r in back.select("shard").collect()} == {0, 1, 2, 3}


def test_many_small_sources_and_null_ids_are_spread(spark, monkeypatch):
    """No bucket of either ranking holds more than a small part of the rows."""
    kept = []
    real = s._ranked
    monkeypatch.setattr(s, "_ranked", lambda df, group, bucket, *rest: kept.append(df.withColumn("b", bucket)) or real(df, group, bucket, *rest))
    lone = spark.range(10_000).selectExpr("id AS doc_id", "'t' AS text", "concat('site', id) AS source")
    null = spark.range(5_000).selectExpr("CAST(NULL AS long) AS doc_id", "'same' AS text", "'hot' AS source")
    rows = s.interleave(lone.unionByName(null), buckets=256).collect()
    assert len(rows) == 15_000
    by_source, placed = kept
    assert by_source.filter("source = 'hot'").groupBy("b").count().agg({"count": "max"}).first()[0] < 100
    assert placed.groupBy("b").count().agg({"count": "max"}).first()[0] < 200
    for k in range(16):
        own = [r for r in rows if r["shard"] == k]
        assert abs(sum(r["source"] == "hot" for r in own) - 5000 / 16) < 60
