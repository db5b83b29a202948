import duckdb
import pytest

from pulsewright.llm.catalog import llm_oracles, llm_queries

SF = "/root/testdata/sf0.001"

COLUMNS = {
    1: "doc_id n_words n_hit n_items items_sha256 contaminated",
    2: "doc_id text n_lines n_removed",
    3: "doc_id held_out lang_pred score",
    4: "doc_id piece start length ids_crc32 sequence_id offset",
    5: "doc_id n_assign n_access n_hex base_sha256 spans",
    6: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    7: "doc_id n_shingles component_id",
    8: "doc_id n_words n_removed kept_sha256",
    9: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    10: "doc_id size text_crc32 law shard slot grown_shard",
    11: "lang source part item value rank",
    12: "doc_id n_shingles component_id kept",
    13: "anchor_id positive_id rank negative_id positive_score negative_score",
}


def test_each_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in llm_queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", list(llm_queries()))
def test_columns_and_rows(spark, name):
    number = int(name[2:].split("_")[0])
    frame = llm_queries()[name](spark, SF)
    assert set(COLUMNS[number].split()) <= set(frame.columns)
    if number in (11, 13):
        assert not frame.isEmpty()
        return
    rows = frame.select("doc_id").collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len({r[0] for r in rows}) == docs and (number == 4 or len(rows) == docs)


@pytest.mark.parametrize("name", list(llm_oracles()))
def test_sql_agrees(spark, name):
    db = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        db.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    result = db.sql(llm_oracles()[name])
    frame = llm_queries()[name](spark, SF).select(*result.columns)
    assert sorted(map(tuple, frame.collect())) == sorted(result.fetchall())
