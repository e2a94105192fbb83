"""Centroid clustering with ball trees.

Each task packs its vectors into trees of bounded size, once. A node is a ball over a run of the tree's
vectors and stores their integer sum and count, the mean as its centre, and the radius. Centroids go down
a tree as sets of candidates: one that is further from a ball's centre than the nearest candidate by more
than the diameter is nearest to none of the ball's vectors. A ball left with one candidate goes to it whole,
by its sum and count; a leaf left with several compares its vectors with these exactly. What a round
returns is a sum and a count for each centroid and task.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Shipped, cut

WIDTH, CENTROIDS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, "2"
#: Vectors of a tree at most, and of a leaf.
TREE_ROWS, LEAF_ROWS = 4096, 32
#: Squared distances of integers up to this are exact in double precision, for up to 512 of them.
EXACT = 1 << 21
#: Distances are compared in floating point only to discard; this is far more than their error.
SLACK = 1e-6


def build(x: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The order of the tree's vectors and its nodes: parents come before children, each node is a run of the order."""
    order = np.arange(len(x))
    nodes = {k: [] for k in ("first", "end", "left", "right", "radius", "sum")}
    work = [(0, len(x), -1, "")]
    while work:
        first, end, parent, side = work.pop()
        at = len(nodes["first"])
        if parent >= 0:
            nodes[side][parent] = at
        own = x[order[first:end]]
        total = own.sum(0)
        apart = own - total / len(own)
        distance = np.sqrt((apart**2).sum(1))
        for k, v in (("first", first), ("end", end), ("left", -1), ("right", -1), ("radius", distance.max()), ("sum", total)):
            nodes[k].append(v)
        if end - first <= LEAF_ROWS or nodes["radius"][at] == 0:
            continue
        far = own[distance.argmax()]
        other = own[((own - far) ** 2).sum(1).argmax()]
        middle = (end - first) // 2
        order[first:end] = order[first:end][np.argpartition(own @ (other - far), middle)]
        work += [(first, first + middle, at, "left"), (first + middle, end, at, "right")]
    return order, {k: np.array(v, np.float64 if k in ("radius", "sum") else np.int32) for k, v in nodes.items()}


def distances(x: np.ndarray, centroids: np.ndarray, exact: bool):
    """Squared distances of integer vectors: doubles where these are exact, else Python's integers."""
    if not exact:
        x, centroids = (np.array([[int(v) for v in row] for row in a.tolist()], object).reshape(a.shape) for a in (x, centroids))
        return ((x[:, None, :] - centroids[None, :, :]) ** 2).sum(2)
    return (x**2).sum(1)[:, None] - 2 * (x @ centroids.T) + (centroids**2).sum(1)[None, :]


def filtered(x: np.ndarray, nodes: dict[str, np.ndarray], centroids: np.ndarray):
    """Yields (first, end, centroid, sum) of balls that go to one centroid and (first, end, numbers, None) of rows compared one by one.

    ``x`` is in the tree's order and, as ``centroids``, within ``EXACT``.
    """
    norms = (centroids**2).sum(1)
    counts = (nodes["end"] - nodes["first"])[:, None]
    level, alive = np.array([0]), np.ones((1, len(centroids)), bool)
    while len(level):
        centre = nodes["sum"][level] / counts[level]
        apart = np.sqrt(np.maximum((centre**2).sum(1)[:, None] - 2 * centre @ centroids.T + norms, 0))
        apart[~alive] = np.inf
        nearest = apart.min(1)
        reach = nearest + 2 * nodes["radius"][level]
        alive = apart <= (reach + SLACK * (1 + reach + np.sqrt(norms.max())))[:, None]
        single = alive.sum(1) == 1
        for k in np.flatnonzero(single):
            node = level[k]
            yield nodes["first"][node], nodes["end"][node], int(alive[k].argmax()), nodes["sum"][node]
        leaf = nodes["left"][level] < 0
        for k in np.flatnonzero(leaf & ~single):
            first, end = nodes["first"][level[k]], nodes["end"][level[k]]
            candidates = np.flatnonzero(alive[k])
            yield first, end, candidates[distances(x[first:end], centroids[candidates], True).argmin(1)], None
        deeper = ~single & ~leaf
        level, alive = np.concatenate([nodes["left"][level[deeper]], nodes["right"][level[deeper]]]), np.concatenate([alive[deeper], alive[deeper]])


class Tree:
    """A tree as a row: vectors as doubles, which hold all the integers they come from."""

    KEYS = ("first", "end", "left", "right", "radius", "sum")

    def __init__(self, row: dict, width: int):
        self.x = np.frombuffer(row["vectors"], "<i4" if row["small"] else "<f8").reshape(-1, width).astype(np.float64)
        self.small = row["small"]
        if self.small:
            self.nodes = {k: np.frombuffer(row[k], "<f8" if k in ("radius", "sum") else "<i4") for k in self.KEYS}
            self.nodes["sum"] = self.nodes["sum"].reshape(-1, width)

    def exact(self, centroids: list[list[int]]) -> np.ndarray | None:
        """The centroids as doubles, or None if they or the vectors are too large for exact doubles."""
        if self.small and all(abs(c) <= EXACT for row in centroids for c in row):
            return np.array(centroids, np.float64)
        return None

    def assign(self, centroids: list[list[int]]) -> np.ndarray:
        """The nearest centroid of each vector, the one with the smaller number if several are."""
        near = self.exact(centroids)
        if near is None:
            return distances(self.x, np.array(centroids, object), False).argmin(1).astype(np.int64)
        out = np.empty(len(self.x), np.int64)
        for first, end, numbers, _ in filtered(self.x, self.nodes, near):
            out[first:end] = numbers
        return out

    def totals(self, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
        """Count and sum of the vectors of each centroid."""
        near, out = self.exact(centroids), {}
        if near is None:
            cluster = self.assign(centroids)
            for c in np.unique(cluster):
                own = self.x[cluster == c].tolist()
                out[int(c)] = len(own), [sum(map(int, column)) for column in zip(*own, strict=True)]
            return out
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros(near.shape)
        for first, end, numbers, total in filtered(self.x, self.nodes, near):
            if total is not None:
                counts[numbers] += end - first
                sums[numbers] += total
            else:
                np.add.at(counts, numbers, 1)
                np.add.at(sums, numbers, self.x[first:end])
        return {int(c): (int(counts[c]), [int(v) for v in sums[c]]) for c in np.flatnonzero(counts)}


def integers(column: pa.Array, width: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows kept, their integers as doubles): rows of ``width`` finite components whose integers fit in a long."""
    sized = np.flatnonzero(np.array([v is not None and len(v) == width for v in column.to_pylist()], bool)) if column.null_count else np.flatnonzero(np.diff(column.offsets.to_numpy()) == width)
    chosen = column.take(pa.array(sized))
    flat = chosen.flatten()
    x = np.floor(scale * flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width))
    sound = (np.abs(x) < 2.0**63).all(1)  # false for NaN, which nulls are too
    return sized[sound], x[sound] + 0.0


def _packed(ids: list, x: np.ndarray) -> dict:
    small = bool((np.abs(x) <= EXACT).all())
    if not small:
        return {"ids": ids, "small": False, "vectors": x.astype("<f8").tobytes(), **dict.fromkeys(Tree.KEYS, b"")}
    order, nodes = build(x)
    return {"ids": [ids[k] for k in order], "small": True, "vectors": x[order].astype("<i4").tobytes(), **{k: v.tobytes() for k, v in nodes.items()}}


def trees(vectors: DataFrame, id_col: str, vector_col: str, width: int, scale: int) -> DataFrame:
    """One row per tree; a tree's vectors come from one task."""
    kind = vectors.schema[id_col].dataType
    schema = T.StructType([T.StructField("ids", T.ArrayType(kind)), T.StructField("small", T.BooleanType()), T.StructField("vectors", T.BinaryType()), *(T.StructField(k, T.BinaryType()) for k in Tree.KEYS)])
    arrow = to_arrow_schema(schema)

    def run(batches):
        ids, parts, n = [], [], 0
        for batch in batches:
            rows, x = integers(batch.column(1), width, scale)
            names = batch.column(0).take(pa.array(rows)).to_pylist()
            for at in range(0, len(x), TREE_ROWS):
                ids, parts = ids + names[at : at + TREE_ROWS], [*parts, x[at : at + TREE_ROWS]]
                n = len(ids)
                if n >= TREE_ROWS:
                    yield pa.RecordBatch.from_pylist([_packed(ids, np.concatenate(parts))], arrow)
                    ids, parts, n = [], [], 0
        if n:
            yield pa.RecordBatch.from_pylist([_packed(ids, np.concatenate(parts))], arrow)

    return vectors.select(id_col, vector_col).mapInArrow(run, schema)


def _round(packed: DataFrame, centroids: list[list[int]], width: int) -> list[list[int]]:
    sent = Shipped(packed.sparkSession, centroids)
    schema = "cluster int, n long, s array<decimal(38,0)>"
    arrow = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("s", pa.list_(pa.decimal128(38, 0)))])

    def run(batches):
        now, totals = sent.built(lambda c: c), {}
        for batch in batches:
            for row in batch.to_pylist():
                for c, (n, s) in Tree(row, width).totals(now).items():
                    m, t = totals.get(c, (0, [0] * width))
                    totals[c] = m + n, [a + b for a, b in zip(t, s, strict=True)]
        yield pa.RecordBatch.from_pylist([{"cluster": c, "n": n, "s": [Decimal(v) for v in s]} for c, (n, s) in totals.items()], arrow)

    each = packed.drop("ids").mapInArrow(run, schema)
    # as many rows as centroids
    rows = each.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(F.get("s", F.lit(k))).alias(f"s{k}") for k in range(width))).collect()
    new = list(centroids)
    for r in rows:
        new[r.cluster] = [int(r[f"s{k}"]) // r.n for k in range(width)]
    return new


def first_centroids(vectors: DataFrame, id_col: str, vector_col: str, k: int, width: int, scale: int, seed: str) -> list[list[int]]:
    """The vectors of the ``k`` least hashes of ``seed:id``; null ids come last, rows that repeat an id in the order of their vectors."""
    kind = T.StructType([T.StructField("hash", T.StringType()), T.StructField("x", T.ArrayType(T.DoubleType()))])
    arrow = to_arrow_schema(kind)

    def run(batches):
        for batch in batches:
            rows, x = integers(batch.column(1), width, scale)
            yield pa.RecordBatch.from_pydict({"hash": batch.column(0).take(pa.array(rows)), "x": pa.array(x.tolist(), pa.list_(pa.float64()))}, arrow)

    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)
    rows = vectors.select(hashed.alias("hash"), F.col(vector_col).alias("x")).mapInArrow(run, kind).orderBy(F.asc_nulls_last("hash"), "x").limit(k).collect()
    return [[int(v) for v in r.x] for r in rows]


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: str = SEED) -> DataFrame:
    """One row per kept vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors that are null, of another width, or hold null or non-finite components, or ones whose integer exceeds
    a long, are left out. With fewer vectors than ``k`` there are as many centroids. Ties go to the centroid with
    the smaller number. Repeated rows count each; ids may repeat or be null, and null ones are the last to be first
    centroids. A distance or inertia that exceeds a long is null. An empty table gives no rows; further columns
    and their names don't matter. Centroids (``k`` of ``width`` integers) are all that the driver holds.
    """
    kind = vectors.schema[id_col]
    packed = cut(trees(vectors, id_col, vector_col, width, scale))
    centroids = first_centroids(vectors, id_col, vector_col, k, width, scale, seed)
    for _ in range(rounds if centroids else 0):
        centroids = _round(packed, centroids, width)
    sent = Shipped(packed.sparkSession, centroids)
    schema = T.StructType([T.StructField("id", kind.dataType), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        now = sent.built(lambda c: c)
        for batch in batches:
            for row in batch.to_pylist():
                tree = Tree(row, width)
                number, near = tree.assign(now), tree.exact(now)
                if near is not None:
                    apart = ((tree.x - near[number]) ** 2).sum(1).astype(np.int64).tolist()
                else:
                    apart = [sum((int(a) - b) ** 2 for a, b in zip(v, now[c], strict=True)) for v, c in zip(tree.x.tolist(), number.tolist(), strict=True)]
                fitting = [d if d < 1 << 63 else None for d in apart]
                yield pa.RecordBatch.from_arrays([pa.array(row["ids"], arrow.field(0).type), pa.array(number, pa.int32()), pa.array(fitting, pa.int64())], schema=arrow)

    assigned = cut(packed.mapInArrow(run, schema))
    total = lambda of: F.when(F.count("distance") == F.count(F.lit(1)), F.try_sum(of)).alias("_t")
    each = assigned.groupBy("cluster").agg(total("distance").alias("cluster_inertia"), F.count_if(F.col("distance").isNull()).alias("lost"))
    sums = {r.cluster: (r.cluster_inertia, r.lost) for r in each.collect()}  # as many rows as centroids
    whole = None if any(lost or s is None for s, lost in sums.values()) else sum(s for s, _ in sums.values())
    whole = whole if whole is not None and whole < 1 << 63 else None
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    known = packed.sparkSession.createDataFrame([(c, s, whole, digest[c]) for c, (s, _) in sums.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(known), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
