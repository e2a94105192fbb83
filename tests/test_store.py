"""Sinks, store operators, model hooks and streams."""

import hashlib
import json
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chunkloom.functions import ids, text
from chunkloom.operators import fusion, graph, index, layout, models, packing, retrieval, store, windows
from chunkloom.sources import readers, sinks
from chunkloom.streaming import events as ev


def test_atomic_sinks(spark, tmp_path):
    df = spark.createDataFrame([("d1", 1), ("d1", 2), ("d2", 3)], "document_id string, n int")
    for values in ({"a": 1}, {"a": 2}):
        sinks.write_manifest(spark, str(tmp_path / "m.json"), values)
    assert json.loads((tmp_path / "m.json").read_text()) == {"a": 2}
    sinks.publish(df, str(tmp_path / "out"))
    sinks.publish(df.limit(1), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    assert [p.name for p in tmp_path.iterdir() if ".tmp" in p.name] == []
    sinks.write_chunks(df, str(tmp_path / "chunks"))
    one = sinks.chunks_of(spark, str(tmp_path / "chunks"), "d1")
    assert one.count() == 2 and "PartitionFilters: [isnotnull(document_id" in one._jdf.queryExecution().toString()
    sinks.snapshot(spark, df, str(tmp_path / "index"), "v1")
    sinks.snapshot(spark, df.limit(1), str(tmp_path / "index"), "v2")
    assert sinks.restore(spark, str(tmp_path / "index")).count() == 1
    sinks.ensure_table(spark, "kept_chunks", "id bigint, tags array<string>")
    sinks.ensure_table(spark, "kept_chunks", "id bigint, tags array<string>")
    assert store.table_schema(spark, "kept_chunks") == {"id": ("int", False), "tags": ("text", True)}
    spark.sql("DROP TABLE kept_chunks")
    assert json.loads(sinks.as_json(df).orderBy("json").first().json) == {"document_id": "d1", "n": 1}


def test_upserts_fall_back_to_single_rows(spark, tmp_path):
    def many(items):
        if any(i["id"] == 7 for i in items):
            raise ValueError
        one_by_one(items)

    def one_by_one(items):
        for i in items:
            (tmp_path / f"row{i['id']}").write_text("x")

    def one(item):
        if item["id"] == 7:
            raise ValueError
        one_by_one([item])

    out = sinks.upsert_batches(spark.range(0, 20, 1, 2), many, one, size=4).agg(F.sum("sent"), F.sum("failed")).first()
    assert tuple(out) == (19, 1) and len(list(tmp_path.iterdir())) == 19


def test_mirror(spark, tmp_path):
    (tmp_path / "a/x").mkdir(parents=True)
    (tmp_path / "b").mkdir()
    (tmp_path / "a/x/new").write_text("new")
    (tmp_path / "b/old").write_text("old")
    plan = spark.createDataFrame([("x/new", "upload"), ("same", "skip"), ("old", "delete"), ("missing", "upload")], "path string, action string")
    kept = {r.path: r.done for r in sinks.mirror(plan, f"file://{tmp_path}/a", f"file://{tmp_path}/b").collect()}
    assert kept == {"x/new": True, "same": False, "old": False, "missing": False} and (tmp_path / "b/x/new").read_text() == "new" and (tmp_path / "b/old").exists()
    sinks.mirror(plan, f"file://{tmp_path}/a", f"file://{tmp_path}/b", delete=True).collect()
    assert not (tmp_path / "b/old").exists()


def test_digests(spark):
    row = spark.createDataFrame([(b"abc",)], "x binary").select(ids.blake2b(F.col("x")).alias("b"), *(c.alias(n) for n, c in ids.content_digests(F.col("x")).items())).first()
    assert row.b == hashlib.blake2b(b"abc", digest_size=16).hexdigest() and row.sha1 == hashlib.sha1(b"abc").hexdigest()


@settings(max_examples=30, deadline=None)
@given(st.text(max_size=30))
def test_stable_texts_are_normal(value):
    import re

    stable = re.compile("[" + text.STABLE.encode().decode("unicode_escape") + "]*")
    if stable.fullmatch(value):
        assert unicodedata.normalize("NFKC", value) == value


def test_all_stable_characters_are_normal(spark):
    import re

    stable = re.compile("[" + text.STABLE.encode().decode("unicode_escape") + "]")
    assert all(unicodedata.normalize("NFKC", c) == c for c in map(chr, range(0x10000)) if stable.match(c))
    got = spark.createDataFrame([("ﬁ ① x",), ("é",), (None,)], "t string").select(text.canonicalize(F.col("t")).alias("x")).collect()
    assert [r.x for r in got] == ["fi 1 x", "é", ""]


def test_small_chunks_join_the_one_before(spark):
    pack = lambda c, **k: [tuple(r) for r in spark.range(1).select(packing.pack(F.array(*map(F.lit, c)), **k).alias("x")).first().x]
    assert pack([50, 50, 10], budget=100) == [(1, 2, 100), (3, 3, 10)]
    assert pack([50, 50, 10], budget=100, least=20) == [(1, 3, 110)]
    assert pack([10, 200, 10, 10], budget=100, overlap_items=1) == [(1, 1, 10), (2, 2, 200), (3, 4, 20)]


def test_row_chunks(spark):
    run = lambda c, head: [tuple(r) for r in spark.range(1).select(packing.row_chunks(F.array(*map(F.lit, c)), F.lit(head), 20).alias("x")).first().x]
    assert run([8, 8, 50, 3], 4) == [(1, 2, None, None, True, 20), (3, 3, 0, 20, False, 20), (3, 3, 18, 38, False, 20), (3, 3, 36, 50, True, 18), (4, 4, None, None, True, 7)]
    assert run([8, 8], 20) == [(1, 2, None, None, False, 16)]


def test_model_hooks(spark):
    df = spark.createDataFrame([(k, f"text {k}") for k in range(10)], "id long, text string")
    out = models.apply_model(df, "text", "v", lambda texts: [[float(len(t))] for t in texts], "array<double>", batch=3, concurrency=2)
    assert [r.v for r in out.orderBy("id").collect()] == [[6.0]] * 10
    ids_ = df.select("id", F.array(F.col("id").cast("int"), F.lit(2)).alias("ids"))
    assert models.apply_model(ids_, "ids", "s", lambda xs: [float(sum(x)) for x in xs], "double").agg(F.sum("s")).first()[0] == 65.0
    with pytest.raises(Exception, match="another number"):
        models.apply_model(df, "text", "v", lambda texts: [1.0], "double", batch=4).collect()
    pooled = df.limit(1).select(models.mean_pooled(F.array(*(F.array(F.lit(a), F.lit(b)) for a, b in ((1.0, 2.0), (3.0, 4.0), (9.0, 9.0)))), F.array(F.lit(1), F.lit(1), F.lit(0))).alias("x")).first().x
    assert pooled == [2.0, 3.0]
    hidden = np.arange(12.0).reshape(2, 3, 2)
    assert models.pooled({"last_hidden": hidden}, np.array([[1, 1, 0], [1, 0, 0]])).tolist() == [[1.0, 2.0], [6.0, 7.0]]
    assert models.pooled({"last_hidden": hidden, "sentence_embedding": np.ones((2, 4))}).shape == (2, 4)
    assert models.pooled({"hidden": hidden, "x": np.zeros((2, 5))}).shape == (2, 5)


def test_rerank_and_registry(spark):
    ranked = spark.createDataFrame([(1, k, 1.0 / (1 + k)) for k in range(4)], "query_id int, id int, score double")
    pairs = spark.createDataFrame([(1, k, "q", "x" * k) for k in range(4)], "query_id int, id int, query string, text string")
    best = models.rerank(ranked, pairs, lambda ps: [[0.0, float(len(p["text"]))] for p in ps], 2)
    assert [(r.id, r.rank) for r in best.orderBy("rank").collect()] == [(3, 1), (2, 2)]
    parsers = models.Parsers()

    @parsers.register("txt")
    def parse(objects):
        return objects.select("path", F.lit("chunk").alias("text"))

    objects = spark.createDataFrame([("a.txt", "txt"), ("b.zzz", None), ("c.pdf", "pdf")], "path string, parser string")
    chunks, counts = parsers.run(objects)
    assert chunks.count() == 1 and {(r.parser, r.parsed, r.skipped) for r in counts.collect()} == {("txt", 1, 0), (None, 0, 1), ("pdf", 0, 1)}


def test_hash_embedding_and_words(spark):
    df = spark.createDataFrame([("a b a",)], "t string")
    v = df.select(retrieval.hash_embedding(8)(text.words(F.col("t"))).alias("v")).first().v
    assert sum(v) == 3.0 and max(v) >= 2.0


def test_beam(spark):
    edges = spark.createDataFrame([(0, k) for k in range(1, 6)] + [(k, 10 + k) for k in range(1, 6)], "src long, dst long")
    got = graph.expand(spark.createDataFrame([(0,)], "seed long"), edges, 2, beam=2).collect()
    assert {(r.key, r.hop) for r in got} == {(1, 1), (2, 1), (11, 2), (12, 2)} and {tuple(r.path) for r in got if r.hop == 2} == {("0", "1", "11"), ("0", "2", "12")}


def test_islands_by_end(spark):
    rows = spark.createDataFrame([("p", s, s + 1) for s in (0.0, 2.0, 4.0, 20.0, 22.0)], "g string, s double, e double")
    assert [r.island for r in windows.islands(rows, ["g"], "s", "e", 3.0).orderBy("s").collect()] == [0, 0, 0, 1, 1]


def test_readers_of_tables(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"x\ny"\n2,z\n')
    assert readers.csv_rows(spark, str(tmp_path / "a.csv")).count() == 2
    assert "gif" in readers.known_extensions()
    frame = spark.createDataFrame([(e,) for e in ("tif", "bmp", "gif", "zzz")], "e string")
    parser, mime = index.dispatch(F.col("e"))
    assert [tuple(r) for r in frame.select(parser, mime).collect()] == [("images", "image/tiff"), ("images", "image/bmp"), ("images", "image/gif"), (None, None)]


def test_table_validity(spark):
    cases = [[["a", "b"], ["1", "c"]], [["a", "b"]], [["a"], ["b"]], [["1", "2"], ["3", "x"]]]
    frame = spark.createDataFrame([(c,) for c in cases], "t array<array<string>>")
    assert [r[0] for r in frame.select(text.table_valid(F.col("t"))).collect()] == [True, False, False, False]


def test_folds_at_length(spark):
    """Long arrays, as the folds must be linear."""
    n = 200_000
    one = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda x: x % 7).alias("c"))
    packed = one.select(packing.pack(F.col("c"), 100, overlap_tokens=10).alias("x")).first().x
    assert packed[-1]["last"] == n
    rows = spark.range(n).select(F.lit(1).alias("page"), F.col("id"), (F.floor(F.col("id") / 3) * 20).alias("top"))
    assert layout.row_clusters(rows, "page", "top", "id", 5.0).agg(F.max("row")).first()[0] == -(-n // 3)


def test_streams(spark, tmp_path):
    rows = spark.range(60).select(F.col("id").alias("event_id"), (F.col("id") % 3).alias("user_id"), (F.col("id") % 2).cast("string").alias("event_type"), F.timestamp_seconds(F.col("id") * 600).alias("ts"))
    for k in range(3):
        rows.where(f"event_id div 20 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run(df, name):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / name)).start()
        q.awaitTermination(180)
        return spark.table(name)

    stream = lambda: ev.read_files(spark, str(tmp_path / "in"), rows.schema, per_batch=1)
    assert run(ev.dedupe(stream(), ["user_id", "event_type"], "30 hours"), "once").count() == 6
    late = run(ev.tumbling_counts(stream(), "1 hour", "0 seconds"), "tumbling")
    want = {(r.start, r.event_type): r.n for r in ev.tumbling_counts(rows, "1 hour").collect()}
    got = {(r.start, r.event_type): r.n for r in late.collect()}
    assert got and all(want[k] == n for k, n in got.items()) and len(got) >= len(want) - 2
    handled = []
    for _ in range(2):
        ev.process_new(stream(), lambda df, k: handled.append((k, df.count())), str(tmp_path / "resumed")).awaitTermination(180)
    assert sum(n for _, n in handled) == 60 and len(handled) == 3


def test_provenance(spark):
    both = fusion.assemble({"vec": spark.createDataFrame([(1, 2, 0.5)], "query_id int, id int, score double"), "bm25": spark.createDataFrame([(1, 3, 2.0)], "query_id int, id int, score double")})
    got = {r.id: r.why for r in both.select("id", fusion.provenance(["vec", "bm25"]).alias("why")).collect()}
    assert got[2].vec == 0.5 and got[2].bm25 is None and got[3].bm25 == 2.0


def test_store_helpers(spark):
    pages = spark.range(10).select("id", (F.col("id") % 3).alias("g"))
    assert [r.id for r in store.page(pages, ["id"], 4, 3).collect()] == [4, 5, 6]
    stamp = spark.sql("SELECT timestamp '2024-01-02 03:04:05.6' AS t").select(store.utc_stamp(F.col("t")).alias("s")).first().s
    assert stamp == "2024-01-02T03:04:05.600000Z"
    assert models.vector_in('{"embedding": [1, 2]}') == [1.0, 2.0] and models.vector_in("[]") is None and models.vector_in(None) is None
