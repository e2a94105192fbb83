"""What a larger input must not make dearer: rows that carry whole texts, patterns that search, memory of a batch or a task."""

import re
import time
import weakref

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from chunkloom import plans
from chunkloom.functions import folds, text
from chunkloom.operators import ann, graph, inverted, packing, retrieval, windows


def seconds(df):
    took = []
    for _ in range(3):
        began = time.time()
        df.write.format("noop").mode("overwrite").save()
        took.append(time.time() - began)
    return min(took)


def test_nfkc_of_plain_texts_costs_little(spark):
    said = ["plain words of no accent " * 4000, "простые слова без знаков " * 4000]
    docs = spark.createDataFrame([(k, said[k % 2]) for k in range(80)], "id long, t string").repartition(4).localCheckpoint()
    assert seconds(docs.select(text.nfkc(F.col("t")).alias("x"))) < 3 * seconds(docs.select(text.squeezed(F.col("t")).alias("x"))) + 0.2
    odd = ["ﬁ", "aﬁ\n", "é", "é", "ё", "漢字", "①", "a\n", "", None, "x" * 5 + "ﬀ"]
    got = spark.createDataFrame([(k, t) for k, t in enumerate(odd)], "id long, t string").select("id", text.nfkc(F.col("t")).alias("x")).collect()
    import unicodedata

    assert [r.x for r in sorted(got)] == [None if t is None else unicodedata.normalize("NFKC", t) for t in odd]


def test_windows_do_not_carry_their_text(spark):
    rows = [(1, "wörd " * 20_000), (2, "x" * 300_000), (3, ""), (4, "short"), (5, "ab 漢字 " * 1500), (6, "a " * 40_000)]
    docs = spark.createDataFrame(rows, "id long, x string")
    out = windows.char_windows(docs, "x", 200, 20, ["id"])
    carried = re.findall(r"Generate [^\n]*\[([^\[\]]*)\], false, \[", out._jdf.queryExecution().executedPlan().toString())
    assert carried and all(c.startswith("id#") and "," not in c for c in carried), carried
    want = set()
    for i, x in rows:
        each = max(1, len(x) // max(1, len(x.split())))
        width = max(200, each * 200)
        step = max(1, width - each * 20)
        n = 1 + min(999, max(0, -(-(len(x) - width) // step)))
        want |= {(i, k, x[k * step : k * step + width]) for k in range(n)}
    assert {(r.id, r.window_index, r.text) for r in out.collect()} == want
    assert sum(1 for i, _, _ in want if i == 1) > 2 * windows.BLOCK_WINDOWS


def test_windows_reach_the_end(spark, monkeypatch):
    """More windows than a thousand, through all levels of blocks, and a word so long that a width would exceed an int."""
    rows = [(1, "ab " * 300_000), (2, "x" * 11_000_000), (3, "wörd " * 9_000), (4, "ab " * 130), (5, "")]
    docs = spark.createDataFrame(rows, "id long, x string")
    want = set()
    for i, x in rows:
        each = max(1, len(x) // max(1, len(x.split())))
        width = max(200, each * 200)
        step = max(1, width - each * 20)
        want |= {(i, k, hash(x[k * step : k * step + width])) for k in range(1 + max(0, -(-(len(x) - width) // step)))}
    assert sum(i == 1 for i, _, _ in want) > 1500
    for size in (windows.BLOCK_WINDOWS, 3):
        monkeypatch.setattr(windows, "BLOCK_WINDOWS", size)
        assert {(r.id, r.window_index, hash(r.text)) for r in windows.char_windows(docs, "x", 200, 20, ["id"]).collect()} == want


def test_descent_of_noise(spark):
    """Neighbours in noise are hardly alike, so that few of them are neighbours' neighbours."""
    n, k = 6000, 5
    x = np.random.default_rng(4).normal(size=(n, 64)).astype(np.float32)
    got = {(r.src, r.dst) for r in ann.nn_descent(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>"), k).collect()}
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = x[:500] @ x.T
    close[np.arange(500), np.arange(500)] = -1
    want = {(i, int(j)) for i, best in enumerate(np.argsort(-close, axis=1)[:, :k]) for j in best}
    assert len(got) == n * k and len(got & want) >= 0.9 * len(want)


def test_index_names_a_document_once_a_shard(spark, tmp_path):
    folder = f"file://{tmp_path}/index"
    rows = [(k, " ".join(f"w{(k * j) % 37}" for j in range(k % 50))) for k in range(700)] + [(5, "w1 w2 w3 w0 w0"), (5, "w9 w0 w0 w9 w9"), (9, None), (4000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    inverted.append(docs, folder, "doc_id", text.words)
    held = spark.read.parquet(f"{folder}/postings/segment=0").agg(F.sum(F.size("ids"))).first()[0]
    assert held <= len(rows)
    queries = spark.createDataFrame([(1, "w0 w9"), (2, "w36 w7 w7 nothing")], "query_id long, query string")
    got = inverted.bm25_topk(spark, folder, queries, 10, text.words)
    want = retrieval.top_k(retrieval.bm25(docs, queries, "doc_id", text.words), "query_id", "score", "id", 10)
    assert sorted(map(tuple, got.select("query_id", "id", "score", "rank").collect())) == sorted(map(tuple, want.select("query_id", "id", "score", "rank").collect()))
    none = f"file://{tmp_path}/none"
    inverted.append(docs.limit(0), none, "doc_id", text.words)
    inverted.append(docs, none, "doc_id", text.words)
    assert inverted.segments(spark, none) == 2 and inverted.bm25_topk(spark, none, queries, 10, text.words).count() == got.count()


class Rows(list):
    """A list that tells when it goes."""


def test_folds_hold_few_results_at_once(spark, monkeypatch):
    """Of a batch's results no more than a portion are Python's objects at once."""
    made, held, kept = [], [], {}

    def run(c):
        rows = Rows([[int(x)] * 6 for x in c])
        made.append(weakref.ref(rows))
        held.append(sum(r() is not None for r in made))
        return rows

    caught = lambda f, *a, **b: kept.setdefault("each", f) and (lambda c: c)
    for name in ("pandas_udf", "arrow_udf"):
        monkeypatch.setattr(F, name, lambda *a, **b: (lambda f: caught(f)) if isinstance(a[0], str) else caught(a[0]))
    folds.fold(F.col("x"), "array<array<bigint>>", run)
    arrays = pa.array([[k % 7 for k in range(400)]] * 2000 + [None, []])
    got = kept["each"](arrays)
    assert max(held) <= 400 and len(got) == 2002 and got.null_count == 1
    assert got[5].as_py() == [[k % 7] * 6 for k in range(400)] and got[2001].as_py() == []


def test_sentence_chunks_do_not_carry_their_text(spark):
    docs = spark.createDataFrame([(1, "One two three. Four five! " * 400), (2, ""), (3, None), (4, "é" * 50)], "id long, t string")
    out = packing.sentence_chunks(docs, "t", ["id"], 45, 2, 12)
    carried = re.findall(r"Generate [^\n]*\[([^\[\]]*)\], false, \[", out._jdf.queryExecution().executedPlan().toString())
    assert carried and all(c.startswith("id#") and "," not in c for c in carried), carried
    text_ = ("One two three. Four five! " * 400)
    assert all(r.text == text_[r.start_char : r.end_char] for r in out.where("id = 1").collect() if r.token_count <= 45)


def test_edges_are_dealt_by_their_number(spark, monkeypatch):
    sf, seen, cut = "/root/testdata/sf0.001", [], graph.cut
    run = plans.load()["capped_walk"][0]
    want = sorted(map(tuple, run(spark, sf).collect()))
    monkeypatch.setattr(graph, "cut", lambda df: seen.append(df.rdd.getNumPartitions()) or cut(df))
    monkeypatch.setattr(plans.retrievals, "EDGE_ROWS", 500, raising=False)
    assert sorted(map(tuple, run(spark, sf).collect())) == want and want
    assert seen[0] >= spark.read.parquet(f"{sf}/lineitem.parquet").count() // 500
