from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chunkloom.functions import text
from chunkloom.operators import fusion, graph, packing, windows
from chunkloom.sources import readers, sinks
from chunkloom.streaming import events as ev


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def longs(values):
    return F.array(*(F.lit(v).cast("long") for v in values)) if values else F.array().cast("array<bigint>")


@settings(max_examples=15, deadline=None)
@given(n=st.integers(0, 60), width=st.integers(2, 12), overlap=st.integers(0, 5))
def test_windows_cover_all_tokens(spark, n, width, overlap):
    overlap = min(overlap, width - 1)
    starts = one(spark, windows.window_starts(F.lit(n), width, overlap))
    assert starts[0] == 0 and starts[-1] + width >= n
    assert all(b - a == width - overlap for a, b in zip(starts, starts[1:]))
    assert len(starts) == 1 or starts[-2] + width < n


@settings(max_examples=15, deadline=None)
@given(counts=st.lists(st.integers(0, 30), max_size=25), budget=st.integers(5, 50), overlap=st.integers(0, 4))
def test_pack_covers_items_within_budget(spark, counts, budget, overlap):
    chunks = one(spark, packing.pack(longs(counts), budget, overlap_tokens=overlap))
    if not counts:
        return
    assert chunks[0]["first"] == 1 and chunks[-1]["last"] == len(counts)
    for c in chunks:
        assert c["tokens"] == sum(counts[c["first"] - 1 : c["last"]])
        assert c["tokens"] <= budget or c["first"] == c["last"]
    for a, b in zip(chunks, chunks[1:]):
        assert a["first"] < b["first"] <= a["last"] + 1


def test_row_groups_keep_an_oversize_row_alone(spark):
    assert one(spark, packing.groups_of_rows(longs([50, 200, 10, 10]), 6, 90)) == [1, 2, 3, 3]


def test_text_edges(spark):
    assert one(spark, text.canonicalize(F.lit(None).cast("string"))) == ""
    assert one(spark, text.line_canonicalize(F.lit(" a \t\r\nb  \n\n"))) == "a\nb"
    assert one(spark, text.token_count(F.lit(" \n "))) == 0
    assert one(spark, text.clock(F.lit(-3.0))) == "00:00:00.000"
    assert one(spark, text.nfkc(F.lit("ﬁ"))) == "fi"


def test_constant_signal_becomes_one(spark):
    c = spark.createDataFrame([(1, 1, 0.5, None), (1, 2, 0.5, None)], "query_id int, id int, a double, b double")
    assert {r.final_score for r in fusion.fuse(c, {"a": 0.6, "b": 0.4}).collect()} == {1.0}


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.range(60).select(F.col("id").alias("event_id"), (F.col("id") % 3).alias("user_id"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 9000).alias("ts"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = ev.rate_limit_stream(stream, 3, 86_400).writeStream.format("memory").queryName("limited").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination(120)
    want = sorted(map(tuple, ev.rate_limit(rows, 3, 86_400).collect()))
    assert sorted(map(tuple, spark.table("limited").collect())) == want


def test_sources_and_sinks(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.txt").write_text("héllo")
    (raw / "b.md").write_bytes(b"\xef\xbb\xbf# T")
    (raw / "l.txt").write_bytes(b"caf\xe9")
    (raw / "a.txt.manifest.json").write_text('{"file_hash": "x"}')
    (raw / "c.jsonl").write_text('{"a": 1}\nbroken\n{"a": [2]}\n')
    assert {r.text for r in readers.texts(spark, str(raw)).collect()} == {"héllo", "# T", "café"}
    assert readers.json_lines(spark, str(raw / "c.jsonl")).count() == 2
    assert readers.manifests(spark, str(raw)).first().file_hash == "x"
    (tmp_path / "chunks").mkdir()
    (tmp_path / "chunks/x.json").write_text('[{"t": 1}, {"t": 2}]')
    (tmp_path / "chunks/y.json").write_text('{"t": 3}{"t": 4}\n{"t": 5}')
    assert readers.chunk_files(spark, str(tmp_path / "chunks")).count() == 5
    df = spark.createDataFrame([("d1", [1, 2]), ("d2", [3])], "document_id string, r array<int>")
    sinks.write_chunks(df, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    assert sinks.flat(df).first().r == "[1,2]"
    sinks.snapshot(spark, df, str(tmp_path / "index"), "v1")
    assert sinks.restore(spark, str(tmp_path / "index")).count() == 2


def test_adjacency_over_ranges(spark):
    """A document that many tasks share, repeated places, and null documents."""
    rows = [("hot", k // 2, k) for k in range(400)] + [("a", 1, 1000), ("a", 5, 1001), (None, 1, 2000), (None, 2, 2001), ("b", 1, 3000)]
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that ranges are not joined
    try:
        got = {(r.src, r.dst) for r in graph.adjacency(spark.createDataFrame(rows, "doc string, place int, chunk long"), "doc", "place", "chunk").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert got == {(k, k + 1) for k in range(399)} | {(1000, 1001), (2000, 2001)}
