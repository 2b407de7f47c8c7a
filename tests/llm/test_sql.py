"""Queries that SQL can express against DuckDB: on the smallest tables, and on
edge texts (nulls, blanks, controls, long and repeated ones)."""

import duckdb
import pytest

from aisle.llm.queries import QUERIES, all_sql
from compare import compare, duck

SQL = all_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_smallest_tables(spark, small_dir, name):
    got = QUERIES[name](spark, small_dir).toPandas()
    assert compare(name, got, duck(small_dir).execute(SQL[name]).df()) == "OK"


@pytest.mark.parametrize("name", ["op2_minhash_dedup", "op3_byte_shards", "op5_curriculum_mix", "op9_adaptive_rules"])
def test_edge_texts(spark, edge_docs, table, name):
    folder = table(documents=edge_docs)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    assert compare(name, QUERIES[name](spark, folder).toPandas(), con.execute(SQL[name]).df()) == "OK"


def test_what_sql_expresses():
    assert sorted(SQL) == ["op11_setm_collocations", "op13_rtree_negatives", "op2_minhash_dedup", "op3_byte_shards", "op4_warc_history", "op5_curriculum_mix", "op9_adaptive_rules"]
