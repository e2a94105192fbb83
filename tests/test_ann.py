"""Approximate search and graphs against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkloom import plans
from chunkloom.operators import ann

SF = "/root/testdata/sf0.01"
ENTRIES = plans.load()


def brute(rows, asked, k, others=False):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = set()
    for i, v in asked:
        score = np.round(x @ (np.array(v, np.float64) / np.linalg.norm(v)), 6)
        order = [j for j in np.lexsort((ids, -score)) if not (others and ids[j] == i)]
        out |= {(i, int(ids[j])) for j in order[:k]}
    return out


@pytest.fixture(scope="module")
def vectors(spark):
    return [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]


def clustered(n, seed=3):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(40, 32))
    return [(k, (middles[k % 40] + rng.normal(scale=0.5, size=32)).tolist()) for k in range(n)]


def test_index_query(spark, vectors):
    got = {(r.query_id, r.id) for r in ENTRIES["ivf_pq_topk"][0](spark, SF).collect()}
    want = brute(vectors, [v for v in vectors if v[0] % 20 == 0], 10)
    assert len(got & want) >= 0.9 * len(want)


def test_index_is_pruned_and_exact_where_all_is_asked(spark, tmp_path):
    rows = clustered(1500)
    odd = [(9000, None), (9001, []), (9002, [0.0] * 32), (9003, [float("nan")] + [1.0] * 31)]
    table = spark.createDataFrame([(*r, 1) for r in rows + odd], "vec_id long, embedding array<double>, list int")
    folder = f"file://{tmp_path}/index"
    ann.write_index(table, folder, lists=16, parts=8)
    queries = table.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    few = ann.search_index(spark, folder, queries.where("query_id < 200"), 10, probes=2, shortlist=60)
    plan = few._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(list" in plan or "PartitionFilters: [list" in plan
    assert len({r.list for r in spark.read.parquet(f"{folder}/codes").select("list").distinct().collect()}) == 16
    want = brute(rows, [r for r in rows if r[0] % 100 == 0], 10)
    got = {(r.query_id, r.id) for r in ann.search_index(spark, folder, queries, 10, probes=16, shortlist=1500).collect()}
    assert got == want
    near = {(r.query_id, r.id) for r in ann.search_index(spark, folder, queries, 10, probes=4, shortlist=80).collect()}
    assert len(near & want) >= 0.9 * len(want)


def test_empty_index(spark, tmp_path):
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    ann.write_index(none, f"file://{tmp_path}/none")
    queries = spark.createDataFrame([(1, [1.0, 2.0])], "query_id long, query_vector array<double>")
    assert ann.search_index(spark, f"file://{tmp_path}/none", queries, 3, 2, 5).collect() == []


def test_descent_query(spark, vectors):
    got = {(r.src, r.dst) for r in ENTRIES["nn_edges"][0](spark, SF).collect()}
    exact = brute(vectors, vectors, 5, others=True)
    assert len(got & exact) >= 0.9 * len(exact)


def test_descent_of_clusters_and_hubs(spark):
    rows = clustered(2500) + [(5000, [0.1] * 32), (5000, [0.1] * 32)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.src, r.dst) for r in ann.nn_descent(table, 10).collect()}
    exact = brute(dict(rows).items(), dict(rows).items(), 10, others=True)
    assert len(got & exact) >= 0.9 * len(exact)
    assert ann.nn_descent(table.limit(0), 10).count() == 0
