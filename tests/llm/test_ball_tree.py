"""Clusters by ball trees against plain integers."""

import hashlib
import math

import numpy as np
import pytest

from chunkloom.llm import ball_tree

SF = "/root/testdata/sf0.001"


def plain(rows, k=40, rounds=5, width=64):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in order[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min(range(len(centroids)), key=lambda c: (apart(v, centroids[c]), c))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v), []).append(v)
        for c, own in groups.items():
            centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    rows = [(i, c := nearest(v), apart(v, centroids[c])) for i, v in kept]
    inertia = {c: sum(d for _, k, d in rows if k == c) for c in {c for _, c, _ in rows}}
    digest = {c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest() for c in inertia}
    return sorted((-1 if i is None else i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, c, d in rows)


def got(df):
    names = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted(tuple(-1 if n == "vec_id" and r[n] is None else r[n] for n in names) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 2.0) for i, v in rows], "vec_id long, embedding array<double>, label int, cluster string, distance double")


def test_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got(ball_tree.cluster(spark.read.parquet(f"{SF}/embeddings.parquet"))) == plain(rows)


def test_blobs_ties_and_odd_rows(spark):
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(30, 64))
    rows = [(k, (middles[k % 30] + rng.normal(scale=0.02, size=64)).tolist()) for k in range(600)]
    rows += [(700 + k, rows[3][1]) for k in range(200)] + [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1])]
    rows += [(900, None), (901, [0.5] * 63), (902, [None] + [0.5] * 63), (903, [math.nan] + [0.5] * 63), (904, [math.inf] + [0.5] * 63), (905, []), (906, [0.5] * 64), (907, [-0.0] * 64)]
    assert got(ball_tree.cluster(frame(spark, rows))) == plain(rows)


def test_large_components_few_rows_and_none(spark):
    rng = np.random.default_rng(6)
    rows = [(k, (rng.normal(size=64) * (1e5 if k % 3 else 1)).tolist()) for k in range(60)]
    assert got(ball_tree.cluster(frame(spark, rows))) == plain(rows)
    few = [(k, rng.normal(size=64).tolist()) for k in range(7)]
    assert got(ball_tree.cluster(frame(spark, few))) == plain(few)
    assert got(ball_tree.cluster(frame(spark, []))) == []
    huge = got(ball_tree.cluster(frame(spark, [(0, [1e12] * 64), (1, [-1e12] * 64), (2, [1e300] * 64)]), k=1, rounds=0))
    assert [r[:5] for r in huge] == [(0, 0, 0, None, None), (1, 0, None, None, None)] or [r[:5] for r in huge] == [(0, 0, None, None, None), (1, 0, 0, None, None)]


@pytest.mark.parametrize("seed", range(6))
def test_whole_balls_and_leaves(seed):
    rng = np.random.default_rng(seed)
    x = np.floor(rng.normal(size=(40, 8)).repeat(rng.integers(1, 60, 40), 0) * 300 + rng.integers(-3, 4, size=(1, 8)) + rng.normal(size=(1, 8)))
    x += rng.integers(-4 * (seed % 2), 4 * (seed % 2) + 1, size=x.shape)
    order, nodes = ball_tree.build(x)
    assert sorted(order.tolist()) == list(range(len(x)))
    centroids = x[rng.integers(0, len(x), 12)]
    whole, number = 0, np.full(len(x), -1)
    for first, end, c, total in ball_tree.filtered(x[order], nodes, centroids):
        number[first:end] = c
        if total is not None:
            whole += 1
            assert (total == x[order][first:end].sum(0)).all()
    assert whole
    assert (number == ((x[order][:, None] - centroids[None]) ** 2).sum(2).argmin(1)).all()
