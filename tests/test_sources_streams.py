"""Byte ranges and timed batches."""

import json
import time

import pytest

from chunkloom.sources import ranged
from chunkloom.streaming import batching


def test_ranges_and_heads(spark, tmp_path):
    ranged.register(spark)
    body = {"a.txt": b"".join(b"line %d of many\n" % k for k in range(5000)), "b.txt": b"no end of line", "c.txt": b"", "d/e.txt": b"\n\nx\n"}
    for name, content in body.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    read = lambda **o: spark.read.format("byte_ranges").options(path=f"file://{tmp_path}", **o).load().collect()
    for size in (7, 1000, 1 << 20):
        for lines in ("false", "true"):
            got = {}
            for r in sorted(read(range=size, lines=lines), key=lambda r: (r.path, r.start)):
                name = r.path.removeprefix(f"{tmp_path}/")
                assert r.start == len(got.get(name, b"")) and r.size == len(r.content)
                assert lines == "false" or r.content.endswith(b"\n") or name == "b.txt"
                got[name] = got.get(name, b"") + r.content
            assert got == {k: v for k, v in body.items() if v}
    heads = read(head=100)
    assert {r.path.removeprefix(f"{tmp_path}/"): r.size for r in heads} == {"a.txt": 100, "b.txt": 14, "d/e.txt": 4}


def test_written_ranges_and_what_an_abort_leaves(spark, tmp_path):
    ranged.register(spark)
    rows = [(f"{k}", 0, 2, b"%02d" % k) for k in range(20)]
    spark.createDataFrame(rows, ranged.SCHEMA).repartition(3).write.format("byte_ranges").mode("append").option("path", f"file://{tmp_path}/out").save()
    named = json.loads((tmp_path / "out/_manifest.json").read_text())
    assert sum(n["rows"] for n in named) == 20 and sum(n["size"] for n in named) == 40
    back = spark.read.format("byte_ranges").option("path", f"file://{tmp_path}/out").load()
    assert sorted(b"".join(r.content for r in back.collect())) == sorted(b"".join(r[3] for r in rows))

    def broken(batches):
        raise RuntimeError("lost")
        yield

    with pytest.raises(Exception, match="lost"):
        spark.createDataFrame(rows, ranged.SCHEMA).mapInArrow(broken, ranged.SCHEMA).write.format("byte_ranges").mode("append").option("path", f"file://{tmp_path}/bad").save()
    assert not (tmp_path / "bad/_manifest.json").exists()


def test_a_stream_of_ranges(spark, tmp_path):
    ranged.register(spark)
    (tmp_path / "in").mkdir()
    stream = spark.readStream.format("byte_ranges").option("path", f"file://{tmp_path}/in").option("range", 4).load()

    def run():
        stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/cp").format("parquet").option("path", f"{tmp_path}/out").start().awaitTermination(120)
        return sorted(bytes(r.content) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    (tmp_path / "in/a").write_bytes(b"aaaabb")
    assert run() == [b"aaaa", b"bb"]
    (tmp_path / "in/b").write_bytes(b"cc")
    assert run() == [b"aaaa", b"bb", b"cc"]


def test_batches_by_size_and_wait_survive_a_restart(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    schema = "user long, event long"
    (tmp_path / "in").mkdir()
    initial = spark.createDataFrame([(1, 900), (7, 901)], schema)

    def put(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/new-{name}")
        (next((tmp_path / f"new-{name}").glob("part*.parquet"))).rename(tmp_path / f"in/{name}.parquet")

    def start():
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        out = batching.batched(stream, "user", 4, 1500, initial)
        return out.writeStream.trigger(processingTime="300 milliseconds").option("checkpointLocation", f"{tmp_path}/cp").format("parquet").option("path", f"{tmp_path}/out").start()

    def seen(n, query):
        until = time.monotonic() + 150
        while time.monotonic() < until:
            assert query.exception() is None, query.exception()
            if (tmp_path / "out/_spark_metadata").exists():
                rows = spark.read.schema("user long, event long, batch long").parquet(f"{tmp_path}/out").collect()
                if len(rows) >= n:
                    return rows
            time.sleep(0.5)
        raise AssertionError("too slow")

    put("one", [(1, k) for k in range(6)] + [(2, 50)])
    query = start()
    try:
        seen(4, query)
        query.stop()  # some rows may still wait
        put("two", [(2, 51), (3, 60)])
        query = start()
        rows = seen(11, query)
    finally:
        query.stop()
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert sorted((r.user, r.event) for r in rows) == sorted([(1, k) for k in range(6)] + [(1, 900), (7, 901), (2, 50), (2, 51), (3, 60)])  # each once
    sizes = {}
    for r in rows:
        sizes[r.user, r.batch] = sizes.get((r.user, r.batch), 0) + 1
    assert max(sizes.values()) <= 4 and sizes[1, 0] == 4
