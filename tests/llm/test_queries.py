import duckdb
import pytest

from conftest import SF_SMALL
from pitchline.catalog.compare import compare, register_tables
from pitchline.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_sql(spark, key):
    con = duckdb.connect()
    register_tables(con, SF_SMALL, ["documents", "embeddings", "conversations"])
    assert compare(QUERIES[key](spark, SF_SMALL), con, ORACLE[key]) == []


@pytest.mark.parametrize("key", ["op1_secret_scan", "op4_bit_packing", "op5_sentencepiece", "op10_mix_sources"])
def test_one_row_a_document(spark, key):
    ids = sorted(r[0] for r in QUERIES[key](spark, SF_SMALL).select("doc_id").collect())
    assert ids == sorted(r[0] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id").collect())
