"""Near-duplicate vectors by lattice hashing.

Each table projects a vector to two blocks of eight random directions, scales and shifts it, and decodes
each block to the nearest point of the E8 lattice. A vector is indexed in its cell and probes the cells
that differ in one block by the nearest point of the lattice's other coset. Cells with several vectors
are cut into blocks of bounded size; each pair of blocks compares its vectors by cosine and returns
degrees and local components, not pairs. A pair is found where one of the two is in its own cell; it is
counted in one such cell, that of its first table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, once, spread_join
from .components import components

THRESHOLD, TABLES, BLOCKS, SCALE, BLOCK_ROWS, SEED = 0.98, 5, 2, 2.5, 1024, 20240607


def _decode(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest point of E8 and the nearest one of its other coset, doubled, for each row of eight."""

    def even(v):
        r = np.rint(v)
        odd = np.flatnonzero(r.sum(1).astype(np.int64) & 1)
        gap = v[odd] - r[odd]
        worst = np.abs(gap).argmax(1)
        r[odd, worst] += np.where(gap[np.arange(len(odd)), worst] >= 0, 1, -1)
        return r

    a, b = even(y), even(y - 0.5) + 0.5
    near = (((y - a) ** 2).sum(1) <= ((y - b) ** 2).sum(1))[:, None]
    return (2 * np.where(near, a, b)).astype(np.int64), (2 * np.where(near, b, a)).astype(np.int64)


def _hash(points: list[np.ndarray], table: int) -> np.ndarray:
    h = np.full(len(points[0]), table + 1, np.uint64)
    for p in points:
        for c in p.T:
            h = (h ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _directions(width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    def build():
        rng, out = np.random.default_rng(SEED + width), []
        for _ in range(TABLES):
            raw = rng.normal(size=(width, 8 * BLOCKS))
            q = np.linalg.qr(raw)[0] if width >= 8 * BLOCKS else raw / np.sqrt(np.maximum(width, 1))
            out.append((q * SCALE * np.sqrt(width / 64), rng.uniform(0, 1, 8 * BLOCKS)))
        return out

    return once(("directions", width), build)


def cells(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Own cells (rows, tables) and probed cells (rows, tables, blocks) of unit vectors."""
    own, probed = [], []
    for t, (q, shift) in enumerate(_directions(x.shape[1])):
        y = x @ q + shift
        decoded = [_decode(y[:, 8 * b : 8 * b + 8]) for b in range(BLOCKS)]
        own.append(_hash([d[0] for d in decoded], t))
        probed.append(np.stack([_hash([d[1] if b == k else d[0] for b, d in enumerate(decoded)], t) for k in range(BLOCKS)], 1))
    return np.stack(own, 1), np.stack(probed, 1)


def _unit(vectors: list) -> np.ndarray:
    x = np.array(vectors, np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _decoded(batches):
    """The batches with each vector's own cell in every table and the cells it probes, label and width mixed in."""
    for batch in batches:
        labels, vectors = batch.column(2).to_numpy(), batch.column(3).to_pylist()
        widths = np.array([len(v) for v in vectors])
        found = [None] * len(vectors)
        for width in np.unique(widths):
            rows = np.flatnonzero(widths == width)
            own, probed = cells(_unit([vectors[r] for r in rows]))
            both = np.concatenate([own[:, :, None], probed], 2)
            both = (both.view(np.uint64) ^ (labels[rows].astype(np.uint64)[:, None, None] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(width))).view(np.int64)
            for r, c in zip(rows, both.reshape(len(rows), -1), strict=True):
                found[r] = c
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int64()))], names=[*batch.schema.names, "cells"])


def _compare(threshold: float):
    def run(key, table):
        t, left, right = key[1].as_py(), key[2].as_py(), key[3].as_py()
        empty = pa.table({"id": pa.array([], pa.int64()), "key": pa.array([], pa.int64()), "degree": pa.array([], pa.int64()), "least": pa.array([], pa.int64())})
        table = table.sort_by([("id", "ascending"), ("key", "ascending")])  # so that all groups count a pair in the same cell
        ids, keys, home_here, part, weight = (table.column(c).to_numpy(zero_copy_only=False) for c in ("id", "key", "own", "part", "weight"))
        if not home_here.any():
            return empty
        x = _unit(table.column("vector").to_pylist())
        close = x @ x.T >= threshold
        np.fill_diagonal(close, False)
        close &= home_here[:, None] | home_here[None, :]
        if left != right:
            close &= part[:, None] != part[None, :]
        if not close.any():
            return empty
        held = np.array(table.column("cells").to_pylist(), np.int64).reshape(len(ids), TABLES, 1 + BLOCKS)
        own, probed = held[:, :, 0], held[:, :, 1:]
        i, j = np.nonzero(np.triu(close))
        met = (own[i] == own[j]) | (own[i][:, :, None] == probed[j]).any(2) | (own[j][:, :, None] == probed[i]).any(2)
        counted = met.argmax(1) == t  # at its first table
        first_home = (own[i, t] == own[j, t]) | (own[i, t][:, None] == probed[j, t]).any(1)
        home = np.where(first_home, own[i, t], own[j, t])  # and there in one cell
        counted &= home == own[np.flatnonzero(home_here)[0], t]
        degree = np.zeros(len(ids), np.int64)
        np.add.at(degree, i[counted], weight[j[counted]])
        np.add.at(degree, j[counted], weight[i[counted]])
        least = ids.copy()
        while True:
            now = least.copy()
            np.minimum.at(now, i, least[j])
            np.minimum.at(now, j, least[i])
            if (now == least).all():
                break
            least = now
        return pa.table({"id": pa.array(ids), "key": pa.array(keys), "degree": pa.array(degree), "least": pa.array(least)})

    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: n_links, component_id, kept.

    Only rows with equal labels that aren't null are compared. Vectors that are null, empty, zero or hold
    null or non-finite components link with nothing; vectors of different length don't link. Equal vectors
    are one class with a weight, so their links are counted without pairs. Repeated rows count each; rows
    that repeat an id are one node of the components, whatever their vectors, and have their own n_links.
    Rows with a null id take no part: no links, a null component, kept. An empty table gives no rows; further
    columns and their names don't matter. Ties don't arise, as a component's least id is unique.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector"))
    sound = F.expr("id IS NOT NULL AND label IS NOT NULL AND size(vector) > 0 AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(vector, x -> x <> 0)")
    print_ = F.struct("label", F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2"))
    good = rows.where(sound).withColumn("print", print_)
    # a class is named by its least id and a hash, as an id may have several vectors
    classes = cut(good.groupBy("print").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight")).withColumn("key", F.xxhash64("print")))
    reps = good.join(classes, ["id", "print"]).dropDuplicates(["id", "key"]).select("id", "key", "label", "vector", "weight")
    # a vector near a cell's border must fall into the same cells wherever it is looked at, so they are worked out once
    reps = cut(reps.mapInArrow(_decoded, f"id long, key long, label long, vector {good.schema['vector'].dataType.simpleString()}, weight long, cells array<long>"))
    each = reps.select("id", "key", F.posexplode("cells").alias("at", "bucket"))
    each = each.select("bucket", F.floor(F.col("at") / (1 + BLOCKS)).cast("int").alias("tab"), "id", "key", (F.col("at") % (1 + BLOCKS) == 0).alias("own"))
    postings = cut(each.groupBy("bucket", "tab", "id", "key").agg(F.max("own").alias("own")))
    crowded = postings.groupBy("bucket", "tab").agg(F.count(F.lit(1)).alias("m"), F.max("own").alias("any_own")).where("m > 1 AND any_own").select("bucket", "tab", F.ceil(F.col("m") / BLOCK_ROWS).cast("int").alias("parts"))
    placed = postings.join(crowded, ["bucket", "tab"]).withColumn("part", F.pmod(F.xxhash64("id", "key"), F.col("parts")).cast("int"))
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    blocks = pairs.select("bucket", "tab", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "id", "key", "own", "part").join(reps.select("id", "key", "vector", "weight", "cells"), ["id", "key"])
    found = cut(blocks.groupBy("bucket", "tab", "p", "q").applyInArrow(_compare(threshold), "id long, key long, degree long, least long"))
    degree = found.groupBy("id", "key").agg(F.sum("degree").alias("degree"))
    links = found.where("id <> least").select(F.col("id").alias("a"), F.col("least").alias("b")).unionByName(_ties(good, classes))
    joined = components(links)
    per_class = classes.join(degree, ["id", "key"], "left").join(joined.withColumnRenamed("node", "id"), "id", "left").select("print", (F.coalesce("degree", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    alone = rows.where(~F.coalesce(sound, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    out = spread_join(good.select("id", "print"), per_class, "print").select("id", "n_links", "component").unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


def _ties(good: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) of ids that have several vectors with the least ids of these."""
    several = good.groupBy("id").agg(F.min("print").alias("p1"), F.max("print").alias("p2")).where("p1 <> p2").select("id")
    own = good.select("id", "print").join(several, "id", "left_semi").join(classes.select("print", F.col("id").alias("rep")), "print")
    return own.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b")).distinct()
