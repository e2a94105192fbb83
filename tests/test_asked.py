"""Searches that the whole benchmark asks."""

import duckdb
import pytest

from chunkloom import plans

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["answer_citations", "bm25_index_topk", "bm25_topk", "lexical_overlap", "minmax_fuse"])
def test_every_item_asks(spark, name):
    said = "list_filter(regexp_split_to_array(lower(text), '[^a-z0-9_]+'), lambda w: w <> '')"
    sql = f"SELECT DISTINCT item_id FROM (SELECT item_id, unnest({said}) AS w FROM '{SF}/benchmark.parquet') SEMI JOIN (SELECT unnest({said}) AS w FROM '{SF}/documents.parquet') USING (w)"
    want = {i for (i,) in duckdb.sql(sql).fetchall()}
    assert {r.query_id for r in plans.load()[name][0](spark, SF).select("query_id").distinct().collect()} == want and any(i % 20 for i in want)
