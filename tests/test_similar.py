"""Near-duplicate clusters against brute force."""

import os
import random

import numpy as np
from pyspark.sql import functions as F

from chunkloom.functions import text
from chunkloom.operators import similar


def brute(rows, least=0.8):
    sets = {}
    for i, t in rows:
        w = [x for x in "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()]
        sets[i] = {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = 0
    for a in sets:
        for b in sets:
            if a < b and sets[a] and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]) - 1e-9:
                links += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_clusters_of_copies_and_near_copies(spark):
    rnd, rows = random.Random(5), []
    words = [f"w{k}" for k in range(2000)]
    for group in range(25):
        base = rnd.choices(words, k=rnd.randint(30, 150))
        for _ in range(rnd.choice([1, 2, 3, 30])):
            copy = list(base)
            for at in rnd.sample(range(len(base)), rnd.randint(0, len(base) // 25)):
                copy[at] = rnd.choice(words)
            rows.append(" ".join(copy))
    rows += [rows[0]] * 40 + [None, "", "one two", "one two", "...", " ".join(rnd.choices(words, k=20_000))]
    rows = list(enumerate(rows))
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, set string, id int")
    got = {r.doc_id: (r.n_shingles, r.cluster) for r in similar.near_duplicates(docs, "doc_id", text.words(F.col("text"))).collect()}
    want = brute(rows)
    assert {i: n for i, (n, _) in got.items()} == {i: n for i, (n, _) in want.items()}
    assert all(want[c][1] == want[i][1] for i, (_, c) in got.items())  # no cluster joins two
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.97 * len(want)
    assert similar.near_duplicates(docs.limit(0), "doc_id", text.words(F.col("text"))).count() == 0
    odd = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "x y z x y z"), (2, "x y z x y z")], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.cluster) for r in similar.near_duplicates(odd, "doc_id", text.words(F.col("text"))).collect()) == [(-1, None), (1, 1), (1, 1), (2, 1)]


def test_components_of_chains(spark):
    links = [(k, k + 1) for k in range(60)] + [(100, 101), (103, 101), (7, 7), (None, 3)]
    got = {r.node: r.component for r in similar.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {100: 100, 101: 100, 103: 100}


def test_no_link_is_missed_that_no_band_holds(spark, monkeypatch):
    """Pairs at a similarity of just 0.8, more than bands are sure to hold, beside a shingle that all texts begin with."""
    monkeypatch.setattr(similar, "BANDS", 1)
    rnd, rows = random.Random(7), []
    words = [f"w{k}" for k in range(5000)]
    for group in range(150):
        n = rnd.choice([9, 14, 24, 49])
        base = rnd.sample(words, n)
        rows += [" ".join(["common", "line", "of", "all", "texts", *base]), " ".join(["common", "line", "of", "all", "texts", *base, *rnd.sample(words, (n + 1) // 4)])]
    rows = list(enumerate(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.cluster) for r in similar.near_duplicates(docs, "doc_id", text.words(F.col("text"))).collect()}
    want = brute(rows)
    assert got == want and len({c for _, c in want.values()}) < 290


def test_whole_sets_are_not_written(spark, monkeypatch):
    """What is written between steps stays below the texts, as whole sets of shingles (8 bytes a word) wouldn't."""
    rnd, written, cut = random.Random(9), [], similar.cut

    def held():
        folder = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
        return sum(os.path.getsize(f"{at}/{name}") for at, _, names in os.walk(folder) for name in names)

    def counted(df):
        out = cut(df)
        written.append(held())
        return out

    rows = [(k, " ".join(rnd.choices([f"{x:x}" for x in range(1000)], k=1500))) for k in range(400)]
    docs = spark.createDataFrame(rows + [(k + 400, t) for k, t in rows], "doc_id long, text string")
    cut(docs.limit(1))
    began = held()
    monkeypatch.setattr(similar, "cut", counted)
    got = {r.doc_id: r.cluster for r in similar.near_duplicates(docs, "doc_id", text.words(F.col("text"))).collect()}
    assert got == {k: k % 400 for k in range(800)}
    assert max(written) - began < sum(len(t) for _, t in rows)


def test_sketches_bound_the_overlap_from_above():
    rnd = np.random.default_rng(2)
    for _ in range(200):
        whole = rnd.integers(0, 1 << 63, rnd.integers(1, 3000)).astype(np.uint64)
        a, b = (np.sort(rnd.choice(whole, rnd.integers(1, len(whole) + 1), replace=False)) for _ in "ab")
        sketch = lambda s: np.packbits(np.isin(np.arange(size := 1 << max(6, int(8 * len(s) - 1).bit_length())), (s % np.uint64(size)).astype(int))).tobytes()
        most, true = similar.most_shared(len(a), sketch(a), len(b), sketch(b)), len(np.intersect1d(a, b))
        alike = min(len(a), len(b)) >= max(100, 0.8 * max(len(a), len(b)))
        assert true <= most <= min(len(a), len(b)) and (not alike or most <= true + 0.3 * min(len(a), len(b)))
