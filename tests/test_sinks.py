"""Sinks, schemas, envelopes and the generic job."""

import json
from datetime import date, datetime

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsewright.functions.rundates import RunDates
from pulsewright.plans.job import run_job
from pulsewright.plans.publish import publish, send
from pulsewright.session import scratch_path
from pulsewright.sinks import files
from pulsewright.sinks.conform import conform
from pulsewright.sinks.envelope import cloud_event, to_messages
from pulsewright.sinks.files import write_clustered, write_csv, write_json, write_partition, write_range_partitioned
from pulsewright.sources.scans import clean, read_csv
from pulsewright.sources.schemas import EVENTS_DAILY, field, floats, record, struct_of


@pytest.fixture
def rows(make):
    return make([(1, "2024-01-01", 1.5), (2, "2024-01-01", None), (3, "2024-01-02", 2.5)], "pim_id bigint,ds date,v double")


def test_csv_keeps_microseconds(spark, make, tmp_path):
    frame = make([(1, "2024-01-01 00:00:00.000001"), (2, "2024-01-01 00:00:00")], "pim_id bigint,t timestamp_ntz")
    write_csv(frame, str(tmp_path / "c"))
    assert sorted(read_csv(spark, str(tmp_path / "c"), frame.schema).collect()) == sorted(frame.collect())


def test_csv_with_blank_between_day_and_time(spark, tmp_path):
    (tmp_path / "x.csv").write_text("pim_id,t\n7,2021-05-03 06:38:30\n")
    schema = T.StructType([T.StructField("pim_id", T.LongType()), T.StructField("t", T.TimestampNTZType())])
    assert read_csv(spark, str(tmp_path / "x.csv"), schema).first().t == datetime(2021, 5, 3, 6, 38, 30)


def test_json_keeps_null_keys(spark, rows, tmp_path):
    write_json(rows.drop("ds"), str(tmp_path / "j"), ds="2024-01-05", now=datetime(2024, 1, 6))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "j")).collect()]
    two = next(x for x in lines if x["pim_id"] == 2)
    assert two["v"] is None and two["ds"] == "2024-01-05" and two["batch_time"].startswith("2024-01-06")


def test_rerun_replaces_its_days_only(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    write_partition(rows, path)
    write_partition(rows.filter("ds = '2024-01-01'").withColumn("v", F.lit(9.0)), path, sort=("pim_id",))
    got = sorted((r.pim_id, str(r.ds), r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, "2024-01-01", 9.0), (2, "2024-01-01", 9.0), (3, "2024-01-02", 2.5)]


@pytest.fixture(params=["static", "dynamic"])
def overwrite_mode(spark, request):
    """Either session setting; none may decide what a write replaces."""
    key = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(key)
    spark.conf.set(key, request.param)
    yield request.param
    spark.conf.set(key, old)


def held(spark, path, *columns):
    return sorted(map(tuple, spark.read.parquet(path).select(*columns).collect()), key=str)


def test_named_day_without_rows_is_emptied(spark, rows, overwrite_mode, tmp_path):
    path = str(tmp_path / "p")
    write_partition(rows, path)
    again = rows.filter("ds = '2024-01-02'").withColumn("v", F.lit(7.0))
    write_partition(again, path, days=["2024-01-01", "2024-01-02", "2024-01-09"])
    assert held(spark, path, "pim_id", "v") == [(3, 7.0)]
    # Nothing at all: the named day goes, the other one stays.
    write_partition(rows, path)
    write_partition(rows.limit(0), path, days="2024-01-02")
    assert held(spark, path, "pim_id") == [(1,), (2,)]
    write_partition(rows.limit(0), path, days=RunDates.of("2023-12-30", "2024-01-01"))
    assert held(spark, path, "pim_id") == []
    write_partition(rows, path, days=RunDates.of("2024-01-01", "2024-01-02"))
    assert held(spark, path, "pim_id") == [(1,), (2,), (3,)]


def test_first_write_of_an_empty_day(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    write_partition(rows.limit(0), path, days="2024-01-02")
    assert spark.read.schema(rows.schema).parquet(path).count() == 0


def test_clustered_files_follow_each_other(spark, monkeypatch, tmp_path):
    frame = spark.range(2000).select((F.col("id") * 7919 % 2000).alias("k"), F.lit("x" * 20).alias("v")).repartition(5)
    path = str(tmp_path / "c")
    write_clustered(frame, path, ["k"], files=4)
    monkeypatch.setattr(files, "ORDER_BLOCK", 70)
    found = sorted(files.file_order(spark, path, ["k"]).collect(), key=lambda r: r["first"])
    assert len(found) == 4 and sum(r.rows for r in found) == 2000
    assert all(r.unordered == 0 and not r.overlaps for r in found)
    assert all(a["last"] < b["first"] for a, b in zip(found, found[1:]))
    # Files as they come overlap and are not sorted.
    frame.write.parquet(str(tmp_path / "d"))
    loose = files.file_order(spark, str(tmp_path / "d"), ["k"]).collect()
    assert sum(r.unordered for r in loose) > 100 and any(r.overlaps for r in loose)


def test_rows_of_other_days_fail_before_anything_is_replaced(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    write_partition(rows, path)
    with pytest.raises(SparkRuntimeException, match="ds 2024-01-02"):
        write_partition(rows.withColumn("v", F.lit(0.0)), path, days="2024-01-01")
    nameless = rows.withColumn("ds", F.lit(None).cast("date"))
    with pytest.raises(SparkRuntimeException, match="ds null"):
        write_partition(nameless, path, days="2024-01-01")
    assert sorted(r.v or 0 for r in spark.read.parquet(path).collect()) == [0, 1.5, 2.5]
    with pytest.raises(ValueError, match="both ends"):
        write_partition(rows, path, days=RunDates())


def test_range_write_replaces_the_table_under_either_setting(spark, overwrite_mode, tmp_path):
    path = str(tmp_path / "r")
    whole = spark.createDataFrame([(v, "a") for v in (-1, 0, 4, 5, 9)], "insulin int, v string")
    write_range_partitioned(whole, path, "insulin", 0, 5, 10)
    write_range_partitioned(whole.filter("insulin = 4"), path, "insulin", 0, 5, 10)
    assert held(spark, path, "insulin") == [(4,)]


def test_named_ranges(spark, overwrite_mode, tmp_path):
    path = str(tmp_path / "r")
    whole = spark.createDataFrame([(v, "a") for v in (-1, 0, 4, 5, 9)], "insulin int, v string")
    write_range_partitioned(whole, path, "insulin", 0, 5, 10)
    some = whole.filter("insulin = 4").withColumn("v", F.lit("b"))
    write_range_partitioned(some, path, "insulin", 0, 5, 10, ranges=[0, None])
    assert held(spark, path, "insulin", "v") == [(4, "b"), (5, "a"), (9, "a")]
    with pytest.raises(ValueError, match="no range starts at"):
        write_range_partitioned(some, path, "insulin", 0, 5, 10, ranges=[3])
    with pytest.raises(SparkRuntimeException, match="range_start 5"):
        write_range_partitioned(whole, path, "insulin", 0, 5, 10, ranges=[0, None])
    assert held(spark, path, "insulin", "v") == [(4, "b"), (5, "a"), (9, "a")]


def test_range_partitions_with_overflow(spark, tmp_path):
    frame = spark.createDataFrame([(v,) for v in (-1, 0, 4, 5, 9, 10, None)], "insulin int")
    write_range_partitioned(frame, str(tmp_path / "r"), "insulin", 0, 5, 10)
    got = {(r.insulin, r.range_start) for r in spark.read.parquet(str(tmp_path / "r")).collect()}
    assert got == {(-1, None), (0, 0), (4, 0), (5, 5), (9, 5), (10, None), (None, None)}


def test_conform_orders_casts_and_fills(rows):
    schema = [field("v", "STRING"), field("pim_id", "FLOAT"), field("ds", "DATE"), field("extra", "TIMESTAMP")]
    out = conform(rows, json.dumps(schema))
    assert out.columns == ["v", "pim_id", "ds", "extra"]
    assert out.schema == struct_of(schema) and out.filter("pim_id = 1").first().v == "1.5"


def test_conform_nested_and_required(spark, rows):
    nested = spark.sql("select named_struct('b', 1, 'a', 2) as s union all select null")
    target = [record("s", [field("a", "FLOAT"), field("c", "STRING"), field("b", "INTEGER")])]
    got = sorted([r.s for r in conform(nested, target).collect()], key=str)
    assert got[0] is None and got[1].asDict() == {"a": 2.0, "c": None, "b": 1}
    with pytest.raises(SparkRuntimeException, match="required field v is null"):
        conform(rows, [field("pim_id", "INTEGER"), field("ds", "DATE"), field("v", "FLOAT", "REQUIRED")]).collect()
    with pytest.raises(ValueError, match="not in the schema: v"):
        conform(rows, [field("pim_id", "INTEGER"), field("ds", "DATE")])


def test_daily_event_schema_size():
    assert len(EVENTS_DAILY) == 3 + 60


def test_envelope(rows):
    got = cloud_event(rows, "s", "t", "p").collect()
    assert len({r.id for r in got}) == 3
    assert {(r.datacontenttype, r.source, r.type, r.referenceprojectid) for r in got} == {("application/json", "s", "t", "p")}
    assert datetime.fromisoformat(got[0].time) and sorted(r.data.pim_id for r in got) == [1, 2, 3]


def test_messages(rows):
    got = to_messages(rows, {"k": "x"}).filter("value like '%\"pim_id\":2%'").first()
    assert json.loads(got.value) == {"pim_id": 2, "ds": "2024-01-01", "v": None}
    assert got.headers[0].key == "k" and bytes(got.headers[0].value) == b"x"
    assert to_messages(rows).first().headers is None


def test_publish_to_files(spark, rows, tmp_path):
    send(publish(rows, "s", "t", "p"), "text", path=str(tmp_path / "m"))
    first = json.loads(spark.read.text(str(tmp_path / "m")).first().value)
    assert set(first) == {"datacontenttype", "id", "source", "type", "time", "referenceprojectid", "data"}


def test_job(spark, rows, tmp_path):
    people = spark.createDataFrame([(1,), (3,)], "pim_id bigint")
    schema = [field("ds", "DATE"), field("pim_id", "INTEGER"), *floats(["v"])]
    run_job({"a": rows.drop("ds")}, lambda a: a, schema, str(tmp_path / "t"), "2024-02-01", participants=people)
    got = sorted((r.pim_id, r.ds) for r in spark.read.parquet(str(tmp_path / "t")).collect())
    assert got == [(1, date(2024, 2, 1)), (3, date(2024, 2, 1))]


def test_job_empties_its_days(spark, rows, tmp_path):
    table = str(tmp_path / "t")
    schema = [field("ds", "DATE"), field("pim_id", "INTEGER"), *floats(["v"])]
    run_job({"a": rows}, lambda a: a, schema, table, "2024-01-01", ds_to="2024-01-02")
    assert held(spark, table, "pim_id") == [(1,), (2,), (3,)]
    run_job({"a": rows}, lambda a: a.filter("pim_id > 2"), schema, table, "2024-01-01", ds_to="2024-01-02")
    assert held(spark, table, "pim_id") == [(3,)]
    run_job({"a": rows}, lambda a: a.filter("pim_id > 5").drop("ds"), schema, table, "2024-01-02")
    assert held(spark, table, "pim_id") == []
    with pytest.raises(SparkRuntimeException, match="not among the partitions"):
        run_job({"a": rows}, lambda a: a, schema, table, "2024-01-01")
    with pytest.raises(ValueError, match="ds column"):
        run_job({"a": rows}, lambda a: a.drop("ds"), schema, table, "2024-01-01", ds_to="2024-01-02")


def test_clean(spark):
    frame = spark.createDataFrame([("7", float("nan"))], "pim_id string, v double")
    row = clean(frame).first()
    assert row.pim_id == 7 and row.v is None


def test_scratch_is_below_the_shared_folder():
    class Shared:
        class conf:
            get = staticmethod(lambda key, default: {"spark.checkpoint.dir": "/shared/place/"}.get(key, default))

    assert scratch_path(Shared, "x").startswith("/shared/place/x-")
