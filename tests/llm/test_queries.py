"""Registered queries against their SQL, and what holds for all of them."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import __spark_entry__ as entry
import check
from clickloom.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(small_sf):
    made = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        made.sql(f"CREATE VIEW {table} AS SELECT * FROM '{small_sf}/{table}.parquet'")
    return made


def test_one_query_an_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, small_sf, name):
    ok, text = check.compare(spark, con, small_sf, name)
    assert ok, text


SCHEMAS = {
    "op1_pareto_mixture": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op2_kd_tree_shards": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op3_set_relation_jaccard": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op4_block_naming_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op5_two_filter_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op6_byte_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op8_va_file_top_k": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op9_license_scan": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double"},
    "op11_aho_corasick_decontamination": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op12_q_chunk_spellings": {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"},
    "op13_pair_bitmap_alignment": {"doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "n_best": "bigint", "count_sum": "bigint", "groups_sha256": "string"},
    "op10_compression_langid": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
}


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_contract_columns(spark, small_sf, name):
    types = dict(QUERIES[name](spark, small_sf).dtypes)
    assert {c: types.get(c) for c in SCHEMAS[name]} == SCHEMAS[name]
