"""Every registered query of the package: its SQL, or the columns that it promises."""

from __future__ import annotations

import pytest
from check_tables import open_tables, spark_side, sql_side

import corpus_pipeline
from meterline.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.01"

COLUMNS = {
    "op1_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op2_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op3_html_extraction": "page_id bigint, url string, text string, n_chars bigint",
    "op4_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op5_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op6_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op7_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op8_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op9_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op10_quality": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, failed bigint, policy_version int",
    "quality_ablations": "version int, rule string, failed bigint, changed bigint, n_rows bigint",
    "op11_importance": "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint",
    "op12_alignment": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string",
    "op13_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
}


@pytest.fixture(scope="module")
def connection():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_sql(spark, connection, name):
    assert spark_side(spark, QUERIES[name], FOLDER) == sql_side(connection, SQL[name])


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns(spark, name):
    found = dict(QUERIES[name](spark, "/root/testdata/sf0.001").dtypes)
    for column in COLUMNS[name].split(", "):
        column, kind = column.split(" ")
        assert found[column] == kind


def test_one_query_for_each_operator():
    assert list(QUERIES) == list(COLUMNS)
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]
