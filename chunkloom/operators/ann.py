"""Approximate neighbours: an inverted-file index with product quantisation, and a neighbour graph by NN-descent."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.vectors import dot
from .retrieval import top_k
from .stages import cut

#: Vectors that centroids and codebooks are fitted on at most, and codes of a codebook: one byte each.
SAMPLE_ROWS, CODES = 20_000, 256
#: Vectors of a list that are compared at once, and queries that are compared with them.
BLOCK_ROWS, QUERY_ROWS = 4_096, 256
#: Vectors whose true neighbours tell when the trees of a graph are enough, and trees for each leaf of one, at most.
ASKED, MOST_TREES = 256, 4
FITTED = "lists int, parts int, centers array<array<double>>, books array<array<array<double>>>"


def _unit(rows) -> np.ndarray:
    x = np.array(rows, np.float64)
    return x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-12)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x**2).sum(1)[:, None] - 2 * x @ y.T + (y**2).sum(1)[None]


def lloyd(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centroids of a bounded sample; one that loses its rows moves to the row that is worst off."""
    rng = np.random.default_rng(seed)
    centers = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        apart = _squares(x, centers)
        own = apart.argmin(1)
        counts = np.bincount(own, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, own, x)
        centers[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
        lost = np.flatnonzero(counts == 0)
        centers[lost] = x[np.argsort(-apart.min(1), kind="stable")[: len(lost)]]
    return centers


def sound(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): vectors that aren't null, empty or zero and hold finite components alone, as doubles."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.where("size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)")


def fit(vectors: DataFrame, lists: int, parts: int, seed: int = 7) -> DataFrame:
    """One row with the centroids of ``lists`` and the codebooks of ``parts`` sub-vectors of what remains beside them.

    They are fitted on ``SAMPLE_ROWS`` vectors at most, the least by a hash of the id.
    """
    spark = vectors.sparkSession
    rows = vectors.select("v", F.xxhash64("id", F.lit(seed)).alias("h")).orderBy("h").limit(SAMPLE_ROWS).collect()
    if not rows:
        return spark.createDataFrame([], FITTED)
    x = _unit([r.v for r in rows])
    if x.shape[1] % parts:
        raise ValueError(f"{parts} parts don't divide {x.shape[1]} components")
    centers = lloyd(x, min(lists, len(x)), seed)
    rest = (x - centers[_squares(x, centers).argmin(1)]).reshape(len(x), parts, -1)
    books = [lloyd(rest[:, p], min(CODES, len(x)), seed + p).tolist() for p in range(parts)]
    return spark.createDataFrame([(len(centers), parts, centers.tolist(), books)], FITTED)


def write_index(vectors: DataFrame, folder: str, lists: int = 64, parts: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> None:
    """An index in ``folder``: ``fitted``, and by list ``codes`` (blocks of ids and codes) and ``vectors`` for re-ranking.

    Each list is a partition of files. Its rows are dealt over as many tasks as they fill blocks, so that no list has
    to fit one task. Unsound vectors are left out.
    """
    rows = sound(vectors, id_col, vector_col)
    fitted = fit(rows, lists, parts)
    fitted.coalesce(1).write.parquet(f"{folder}/fitted")
    sent = vectors.sparkSession.sparkContext.broadcast(fitted.first())  # lists and CODES vectors

    def coded(batches):
        centers, books = np.array(sent.value.centers), [np.array(b) for b in sent.value.books]
        for batch in batches:
            x = _unit(batch.column(1).to_pylist())
            own = _squares(x, centers).argmin(1)
            rest = (x - centers[own]).reshape(len(x), len(books), -1)
            codes = np.stack([_squares(rest[:, p], b).argmin(1) for p, b in enumerate(books)], 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary())], names=["id", "v", "list", "code"])

    if sent.value is None:
        return
    kind = rows.schema["id"].dataType.simpleString()
    placed = cut(rows.mapInArrow(coded, f"id {kind}, v array<double>, list int, code binary"))
    blocks = placed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))  # a row for each list
    placed = placed.join(F.broadcast(blocks), "list").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    packed = placed.groupBy("list", "block").agg(F.collect_list(F.struct("id", "code")).alias("rows"))
    packed = packed.select("list", F.col("rows.id").alias("ids"), F.array_join(F.transform("rows.code", F.hex), "").alias("codes"))
    packed.select("list", "ids", F.unhex("codes").alias("codes")).write.partitionBy("list").parquet(f"{folder}/codes")
    placed.repartition("list", "block").select("list", "id", "v").write.partitionBy("list").parquet(f"{folder}/vectors")


def search_index(spark: SparkSession, folder: str, queries: DataFrame, k: int, probes: int, shortlist: int) -> DataFrame:
    """(query_id, id, score, rank): cosine top-k for each query (query_id, query_vector) among ``probes`` lists.

    The lists that no query asks for are not read. Blocks of a list are compared with blocks of the queries that
    ask for it, by tables of each query's products with the codebooks; the ``shortlist`` best of each query are
    then ranked by their vectors.
    """
    first = spark.read.schema(FITTED).parquet(f"{folder}/fitted").first()
    asked = sound(queries, "query_id", "query_vector")
    if first is None:
        return asked.select(F.col("id").alias("query_id"), F.col("id"), F.lit(0.0).alias("score"), F.lit(1).alias("rank")).where("false")
    sent = spark.sparkContext.broadcast(first)
    kind = asked.schema["id"].dataType.simpleString()

    def probing(batches):
        centers = np.array(sent.value.centers)
        for batch in batches:
            q = _unit(batch.column(1).to_pylist())
            near = np.argsort(-(q @ centers.T), axis=1, kind="stable")[:, :probes]
            rows = np.repeat(np.arange(len(q)), near.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)), pa.array(near.ravel().astype(np.int32))], names=["query_id", "q", "list"])

    wanted = cut(asked.mapInArrow(probing, f"query_id {kind}, q array<double>, list int"))
    lists = [r.list for r in wanted.select("list").distinct().collect()]  # no more than there are lists
    codes, vectors = (spark.read.parquet(f"{folder}/{t}").where(F.col("list").isin(lists)) for t in ("codes", "vectors"))
    groups = wanted.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("groups"))
    dealt = wanted.join(F.broadcast(groups), "list").withColumn("group", F.pmod(F.xxhash64("query_id"), F.col("groups")))
    together = dealt.groupBy("list", "group").agg(F.collect_list(F.struct("query_id", "q")).alias("asked"))
    pairs = together.join(codes, "list").select("list", F.col("asked.query_id").alias("names"), F.col("asked.q").alias("qs"), "ids", "codes")
    item = codes.schema["ids"].dataType.elementType.simpleString()

    def compared(batches):
        centers, books = np.array(sent.value.centers), [np.array(b) for b in sent.value.books]
        for batch in batches:
            for at in range(batch.num_rows):
                number, qs = batch.column(0)[at].as_py(), _unit(batch.column(2)[at].as_py())
                names, ids = batch.column(1)[at].values, batch.column(3)[at].values
                code = np.frombuffer(batch.column(4)[at].as_py(), np.uint8).reshape(len(ids), -1)
                scores = np.repeat((qs @ centers[number])[:, None], len(ids), 1)
                for p, sub in enumerate(np.split(qs, len(books), axis=1)):
                    scores += (sub @ books[p].T)[:, code[:, p]]
                best = np.argpartition(-scores, shortlist - 1, 1)[:, :shortlist] if shortlist < len(ids) else np.broadcast_to(np.arange(len(ids)), scores.shape)
                row = np.repeat(np.arange(len(qs)), best.shape[1])
                yield pa.RecordBatch.from_arrays([names.take(pa.array(row)), ids.take(pa.array(best.ravel())), pa.array(np.full(len(row), number, np.int32)), pa.array(scores[row, best.ravel()])], names=["query_id", "id", "list", "near"])

    near = pairs.mapInArrow(compared, f"query_id {kind}, id {item}, list int, near double")
    short = top_k(near, "query_id", "near", "id", shortlist).select("query_id", "id", "list")
    exact = short.join(vectors, ["list", "id"]).join(asked.select(F.col("id").alias("query_id"), F.col("v").alias("q")), "query_id")
    norm = lambda c: F.sqrt(dot(F.col(c), F.col(c)))
    scored = exact.select("query_id", "id", F.round(dot(F.col("q"), F.col("v")) / (norm("q") * norm("v")), 6).alias("score")).distinct()
    return top_k(scored, "query_id", "score", "id", k)


def _numbers(column: pa.Array) -> np.ndarray:
    """The unit vectors of a column of lists of one length."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-12)


def _alike(rows: DataFrame, first: int, trees: int, bits: int, size: int, k: int, seed: int) -> DataFrame:
    """(src, dst, score): the k nearest others of each vector in its leaf of each of ``trees``.

    Vectors on the same sides of ``bits`` random directions share a leaf, which is compared as one matrix. A leaf of more than
    ``2 * size`` vectors is cut into blocks by a hash.
    """
    id_type, v_type = (rows.schema[c].dataType.simpleString() for c in ("id", "v"))

    def placed(batches):
        for batch in batches:
            x = _numbers(batch.column(1)) if batch.num_rows else np.zeros((0, 1))
            for tree in range(first, first + trees):
                directions = np.random.default_rng([seed, tree]).normal(size=(x.shape[1], bits))
                leaf = ((x @ directions > 0) << np.arange(bits)).sum(1).astype(np.int64)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(x), tree, np.int32)), pa.array(leaf)], names=["id", "v", "tree", "leaf"])

    def nearest(table: pa.Table) -> pa.Table:
        ids, x = table.column("id").combine_chunks(), _numbers(table.column("v").combine_chunks())
        n, out = min(k, len(x) - 1), []
        for at in range(0, len(x) if n else 0, QUERY_ROWS):
            close = x[at : at + QUERY_ROWS] @ x.T
            own = np.arange(len(close))
            close[own, at + own] = -np.inf
            best = np.argpartition(-close, n - 1, axis=1)[:, :n]
            out.append((np.repeat(at + own, n), best.ravel(), np.round(np.take_along_axis(close, best, 1).ravel(), 6)))
        src, dst, score = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"src": ids.take(pa.array(src)), "dst": ids.take(pa.array(dst)), "score": score})

    dealt = rows.mapInArrow(placed, f"id {id_type}, v {v_type}, tree int, leaf long")
    crowd = dealt.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / (2 * size)).cast("int").alias("parts"))
    crowd = crowd.where("parts > 1")  # few unless many vectors are alike
    cut_up = dealt.join(crowd, ["tree", "leaf"], "left") if not crowd.isEmpty() else dealt.withColumn("parts", F.lit(1))
    part = F.pmod(F.xxhash64("id", F.lit(seed)), F.coalesce("parts", F.lit(1))).alias("part")
    return cut_up.select("id", "v", "tree", "leaf", part).groupBy("tree", "leaf", "part").applyInArrow(nearest, f"src {id_type}, dst {id_type}, score double")


def _met(lists: DataFrame, kind: str) -> DataFrame:
    """(src, dst, score): the pairs of a row's ``ids`` by cosine, where the score may still be among the best of src (``least``)."""

    def run(batches):
        for batch in batches:
            ids, least = batch.column(0).flatten(), batch.column(2).flatten().to_numpy(zero_copy_only=False)
            x, ends = _numbers(batch.column(1).flatten()), np.cumsum(np.diff(batch.column(0).offsets.to_numpy())).tolist()
            out, a = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], 0
            for b in ends:
                close = np.round(x[a:b] @ x[a:b].T, 6)
                np.fill_diagonal(close, -np.inf)
                row, column = np.nonzero(close >= least[a:b, None])
                out.append((a + row, a + column, close[row, column]))
                a = b
            src, dst, score = (np.concatenate(c) for c in zip(*out))
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(src)), ids.take(pa.array(dst)), pa.array(score)], names=["src", "dst", "score"])

    return lists.select("ids", "vs", "least").mapInArrow(run, f"src {kind}, dst {kind}, score double")


def _kept(edges: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("score"), "dst"))
    return edges.groupBy("src", "dst").agg(F.max("score").alias("score")).withColumn("_r", rank).where(F.col("_r") <= k)


def _true(rows: DataFrame, k: int, n: int, seed: int) -> DataFrame:
    """(src, dst): the k nearest others of ``n`` vectors, the least by a hash, among all."""
    kind = rows.schema["id"].dataType.simpleString()
    drawn = rows.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(n).collect()
    sent = rows.sparkSession.sparkContext.broadcast(([r.id for r in drawn], _unit([r.v for r in drawn]) if drawn else None))

    def run(batches):
        names, asked = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            close = np.round(asked @ _numbers(batch.column(1)).T, 6)
            best = np.argsort(-close, axis=1, kind="stable")[:, : k + 1]
            src = pa.array(names, batch.column(0).type).take(pa.array(np.repeat(np.arange(len(names)), best.shape[1])))
            yield pa.RecordBatch.from_arrays([src, batch.column(0).take(pa.array(best.ravel())), pa.array(np.take_along_axis(close, best, 1).ravel())], names=["src", "dst", "score"])

    return _kept(rows.mapInArrow(run, f"src {kind}, dst {kind}, score double").where("src <> dst"), k).select("src", "dst")


def nn_descent(vectors: DataFrame, k: int, width: int = 24, leaf: int = 2_048, trees: int = 4, rounds: int = 2, recall: float = 0.95, seed: int = 11, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(src, dst, score, rank): about the ``k`` nearest others of each vector by cosine, without comparing all pairs.

    Neighbours start as the nearest within leaves of random hyperplanes, which are compared as matrices, and are drawn anew
    for each tree: ``trees`` first, then as many as it takes until ``recall`` of the true neighbours of ``ASKED`` drawn vectors
    are found. A tree costs n * leaf products; how many it takes depends on how alike neighbours are: in 64 dimensions of noise
    all but as many as comparing all pairs does. In a round every vector's neighbourhood (half of ``width`` of its neighbours,
    and as many of those that have it as a neighbour, both drawn by a hash of the pair and the round) is compared within
    itself, as neighbours of a neighbour are likely neighbours; pairs that can't be among the ``width`` best of a vector
    don't leave their row. Rounds end when fewer than one in a thousand neighbours changes. Each round is written down.
    """
    sounds = sound(vectors, id_col, vector_col).dropDuplicates(["id"])
    if vectors.schema[vector_col].dataType.simpleString() == "array<float>":
        sounds = sounds.withColumn("v", F.col("v").cast("array<float>"))
    rows = cut(sounds)
    kind, total = rows.schema["id"].dataType.simpleString(), rows.count()
    bits = max(0, int(np.ceil(np.log2(max(1, total / leaf)))))
    true = cut(_true(rows, k, ASKED, seed))
    wanted = true.count()
    graph, grown, more = None, 0, trees if bits else 1
    while more:
        found = _alike(rows, grown, more, bits, leaf, k, seed)
        graph = cut(_kept(found if graph is None else graph.drop("_r").unionByName(found), width))
        grown += more
        share = graph.where(F.col("_r") <= k).join(true, ["src", "dst"], "left_semi").count() / max(1, wanted)
        need = np.log(1 - recall) / np.log(1 - min(max(share, 0.01), 0.999)) * grown  # were leaves independent
        more = 0 if share >= recall or grown >= MOST_TREES << bits else max(1, min(16, int(np.ceil(need)) - grown))
    for turn in range(rounds):
        half = width // 2
        drawn = F.row_number().over(Window.partitionBy("at").orderBy("h", "member"))
        hash_ = F.xxhash64("src", "dst", F.lit(seed + turn))
        out = graph.select(F.col("src").alias("at"), F.col("dst").alias("member"), hash_.alias("h"))
        back = graph.select(F.col("dst").alias("at"), F.col("src").alias("member"), hash_.alias("h"))
        members = [side.withColumn("_r", drawn).where(F.col("_r") <= half).select("at", "member") for side in (out, back)]
        near = members[0].unionByName(members[1]).unionByName(rows.select(F.col("id").alias("at"), F.col("id").alias("member"))).distinct()
        last = graph.where(F.col("_r") == width).select(F.col("src").alias("id"), F.col("score").alias("least"))
        known = rows.join(last, "id", "left").select(F.col("id").alias("member"), "v", F.coalesce("least", F.lit(-2.0)).alias("least"))
        lists = near.join(known, "member").groupBy("at").agg(F.collect_list(F.struct("member", "v", "least")).alias("m"))
        found = _met(lists.select(F.col("m.member").alias("ids"), F.col("m.v").alias("vs"), F.col("m.least").alias("least")), kind)
        after = cut(_kept(graph.drop("_r").unionByName(found), width))
        changed = after.join(graph.select("src", "dst"), ["src", "dst"], "left_anti").count()
        graph = after
        if changed * 1000 <= after.count():
            break
    return top_k(graph.drop("_r"), "src", "score", "dst", k)
