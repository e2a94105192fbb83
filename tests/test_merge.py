"""Merges by copying: what changes, what stays, and what a crash leaves."""

import random

import pytest

from chunkloom.sources import merge, sinks


def table(spark, rows):
    return spark.createDataFrame(rows, "id string, n long, tags array<string>")


def rows_of(df):
    return {r.id: (r.n, r.tags) for r in df.collect()}


def test_merges_against_a_dictionary(spark, tmp_path):
    root, rnd = f"file://{tmp_path}/t", random.Random(3)
    want = {f"k{k}": (k, ["a"]) for k in range(200)}
    merge.create(table(spark, [(k, *v) for k, v in want.items()] + [("k0", -5, ["z"]), (None, 1, [])]), root, "id", buckets=16)
    assert rows_of(merge.read(spark, root)) == want
    history = [dict(want)]
    for turn in range(3):
        changed = {f"k{rnd.randrange(260)}": (1000 * turn + k, None if k % 3 == 0 else [str(k)]) for k in range(4)}
        gone = {f"k{rnd.randrange(260)}" for _ in range(2)}
        before = merge.manifest(spark, root)["folders"]
        merge.merge(spark, root, table(spark, [(k, *v) for k, v in changed.items()]), spark.createDataFrame([(g,) for g in gone], "id string"))
        want = {k: v for k, v in want.items() if k not in gone} | changed
        after = merge.manifest(spark, root)["folders"]
        assert rows_of(merge.read(spark, root)) == want
        assert sum(before.get(b) == after.get(b) for b in before) >= 16 - len(changed) - len(gone)  # the others keep their files
        history.append(dict(want))
    assert all(rows_of(merge.read(spark, root, v)) == h for v, h in enumerate(history))
    dropped = merge.deleted_since(spark, root, 0)
    assert {r.id for r in dropped.collect()} <= set(history[0]) | {f"k{k}" for k in range(260)} and not {r.id for r in dropped.collect()} & set(want)
    pinned = merge.read(spark, root)
    assert merge.vacuum(spark, root, keep=1) > 0 and rows_of(pinned) == want
    none = table(spark, [])
    assert merge.merge(spark, root, none) == 3
    merge.merge(spark, root, none, spark.createDataFrame([(k,) for k in want], "id string"))
    assert merge.read(spark, root).count() == 0


def test_a_merge_that_dies_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/t"
    merge.create(table(spark, [("a", 1, []), ("b", 2, [])]), root, "id", buckets=4)
    with monkeypatch.context() as m:
        m.setattr(merge, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            merge.merge(spark, root, table(spark, [("a", 9, [])]))
    assert rows_of(merge.read(spark, root)) == {"a": (1, []), "b": (2, [])}
    merge.merge(spark, root, table(spark, [("a", 3, [])]))
    assert rows_of(merge.read(spark, root)) == {"a": (3, []), "b": (2, [])}
    with pytest.raises(merge.Conflict):
        merge.commit(spark, root, 1, {})
    assert merge.vacuum(spark, root, keep=2) > 0  # what the dead merge has left


def test_a_published_folder_is_the_old_or_the_new_one(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/p"
    merge.publish(table(spark, [("a", 1, [])]), root)
    with monkeypatch.context() as m:
        m.setattr(merge, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            merge.publish(table(spark, [("b", 1, [])]), root)
    assert set(rows_of(merge.published(spark, root))) == {"a"}
    merge.publish(table(spark, [("c", 1, [])]), root)
    assert set(rows_of(merge.published(spark, root))) == {"c"} and set(rows_of(merge.published(spark, root, 0))) == {"a"}


def test_a_folder_is_moved_aside_before_it_is_replaced(spark, tmp_path):
    one, two = table(spark, [("a", 1, [])]), table(spark, [("b", 2, [])])
    sinks.publish(one, str(tmp_path / "out"))
    sinks.publish(two, str(tmp_path / "out"))
    assert set(rows_of(spark.read.parquet(str(tmp_path / "out")))) == {"b"}
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
