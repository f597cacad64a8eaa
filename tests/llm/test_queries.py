"""Every registered corpus query over the smallest given tables."""

import os

import pytest

import __spark_entry__ as entry_point
from fieldspark.llm.oracle import ORACLE_SQL
from fieldspark.llm.queries import QUERIES
from workload.compare import connect, differences

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")

#: The table of which a query gives a row for each row.
ROW_FOR_ROW = {
    "op1_warc_revisits": "pages", "op2_source_mixing": "documents", "op3_substring_dedup": "documents",
    "op4_html_extraction": "pages", "op5_fingerprints": "documents", "op6_url_filter": "pages",
    "op7_language_id": "documents", "op8_simhash": "documents", "op9_line_dedup": "documents",
    "op10_decontamination": "documents", "op12_bpe_tokens": "documents",
}


def test_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_point.queries())
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ROW_FOR_ROW))
def test_query_gives_a_row_for_each_row(spark, name):
    df = QUERIES[name](spark, SF)
    key = "page_id" if "page_id" in df.columns else "doc_id"
    given = spark.read.parquet(f"{SF}/{ROW_FOR_ROW[name]}.parquet")
    assert sorted(r[0] for r in df.select(key).collect()) == sorted(r[0] for r in given.select(key).collect())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE_SQL[name]) == []
