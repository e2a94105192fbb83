"""The inverted index against BM25 over all texts."""

import random

from pyspark.sql import functions as F

from chunkloom.functions import text
from chunkloom.operators import inverted, retrieval


def rows_of(df):
    return sorted((r.query_id, r["rank"], r.id, r.score) for r in df.collect())


def corpus(spark, n, first=0, seed=1):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows = [(first + k, None if k % 50 == 7 else " ".join(rnd.choices(words, weights=[1 / (j + 1) for j in range(400)], k=rnd.randint(0, 120)) + ["rare"] * (k % 97 == 0) * rnd.randint(1, 5))) for k in range(n)]
    return spark.createDataFrame([(*r, "t", 1) for r in rows], "doc_id long, text string, term string, shard int")


def test_index_gives_what_all_texts_give(spark, tmp_path):
    folder = f"file://{tmp_path}/index"
    queries = spark.createDataFrame([(1, "w0 w5 rare"), (2, "rare"), (3, "nothing known"), (4, "w3 w3 w399 w250"), (5, ""), (6, "w1")], "query_id long, query string")
    one, two = corpus(spark, 1500), corpus(spark, 700, 5000, 2)
    inverted.append(one, folder, "doc_id", text.words)
    want = lambda docs: rows_of(retrieval.top_k(retrieval.bm25(docs, queries, "doc_id", text.words), "query_id", "score", "id", 10))
    told = {}
    assert rows_of(inverted.bm25_topk(spark, folder, queries, 10, text.words, tell=told)) == want(one)
    inverted.append(two, folder, "doc_id", text.words)  # statistics change for both segments
    assert inverted.segments(spark, folder) == 2
    assert rows_of(inverted.bm25_topk(spark, folder, queries, 10, text.words, tell=told)) == want(one.unionByName(two))
    assert told["read"] < 0.8 * told["shards"]


def test_an_unfinished_segment_does_not_count(spark, tmp_path):
    folder = f"file://{tmp_path}/index"
    queries = spark.createDataFrame([(1, "w0 w1")], "query_id long, query string")
    assert inverted.bm25_topk(spark, folder, queries, 5, text.words).collect() == []
    inverted.append(corpus(spark, 100), folder, "doc_id", text.words)
    before = rows_of(inverted.bm25_topk(spark, folder, queries, 5, text.words))
    corpus(spark, 50, 900).select(F.lit("w0").alias("term")).write.parquet(f"{folder}/postings/segment=1/bucket=3")  # written, but its lengths are not there
    assert rows_of(inverted.bm25_topk(spark, folder, queries, 5, text.words)) == before
    inverted.append(corpus(spark, 60, 900, 4), folder, "doc_id", text.words)
    assert inverted.segments(spark, folder) == 2
