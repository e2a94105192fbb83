"""Graph expansion by unrolled joins with a visited set."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .stages import cut


def expand(seeds: DataFrame, edges: DataFrame, hops: int, per_node: int | None = None, beam: int | None = None) -> DataFrame:
    """(seed, key, hop, path) of all vertices within ``hops`` outbound steps, each at its least hop.

    ``seeds`` has a column seed, ``edges`` src and dst. A vertex met twice keeps its first path by order.
    ``per_node`` keeps a vertex's first neighbours by key, ``beam`` the first vertices of a seed and hop.
    """
    if per_node:
        rank = F.row_number().over(Window.partitionBy("src").orderBy("dst"))
        edges = edges.withColumn("_r", rank).where(F.col("_r") <= per_node).drop("_r")
    seen = seeds.select("seed", F.col("seed").alias("key"), F.lit(0).alias("hop"), F.array(F.col("seed").cast("string")).alias("path"))
    frontier = seen
    for hop in range(1, hops + 1):
        step = frontier.select("seed", F.col("key").alias("src"), "path").join(edges.select("src", "dst"), "src")
        new = step.groupBy("seed", F.col("dst").alias("key")).agg(F.min("path").alias("path"))
        new = new.join(seen.select("seed", "key"), ["seed", "key"], "left_anti")
        frontier = new.select("seed", "key", F.lit(hop).alias("hop"), F.concat("path", F.array(F.col("key").cast("string"))).alias("path"))
        if beam:
            rank = F.row_number().over(Window.partitionBy("seed").orderBy("key"))
            frontier = frontier.withColumn("_r", rank).where(F.col("_r") <= beam).drop("_r")
        seen = seen.unionByName(frontier)
    return seen.where("hop > 0")


def hop_score(hop):
    return F.lit(1.0) / (1 + hop)


def adjacency(chunks: DataFrame, by: str, order: str, key: str) -> DataFrame:
    """Edges from each chunk to the next one of its document, by ``order`` and key.

    Rows are dealt by ranges of (``by``, ``order``), so that a document with many chunks is many tasks' work; the last
    chunk of a range leads to the first of the document's next range.
    """
    rows = chunks.select(F.col(by).alias("by"), F.col(order).alias("at"), F.col(key).alias("key"))
    rows = cut(rows.repartitionByRange("by", "at").withColumn("part", F.spark_partition_id()))
    within = F.lead("key").over(Window.partitionBy("by", "part").orderBy("at", "key"))
    first = rows.groupBy("by", "part").agg(F.min(F.struct("at", "key")).alias("f"))  # a row for each document and range
    following = first.select("by", "part", F.lead("f.key").over(Window.partitionBy("by").orderBy("part")).alias("after")).where("after IS NOT NULL")
    led = rows.select("by", "part", F.col("key").alias("src"), within.alias("dst"))
    inner = led.where("dst IS NOT NULL").select("src", "dst")
    following = following.select(F.col("by").alias("_by"), F.col("part").alias("_part"), "after")
    across = led.where("dst IS NULL").join(following, F.col("by").eqNullSafe(F.col("_by")) & (F.col("part") == F.col("_part"))).select("src", F.col("after").alias("dst"))
    return inner.unionByName(across)


def capped_walk(seeds: DataFrame, edges: DataFrame, vertices: DataFrame, hops: int = 2, least_weight: float = 0.7, per_node: int = 20, beam: int | None = None, per_seed: int = 100, total: int = 500, parts: int | None = None) -> DataFrame:
    """(query_id, seed, key, hop, weight, path): vertices within ``hops`` of a query's seeds, under caps that hold in each hop.

    ``seeds`` has query_id and seed, ``edges`` src, dst and weight, ``vertices`` key and chunk_id. Edges below
    ``least_weight`` and vertices without a chunk are neither walked nor returned. A vertex is reached once in a query,
    over all its seeds, at its least hop and there over the heaviest edge, ties by seed and path. Of each vertex the
    ``per_node`` heaviest edges are walked. Of what a hop reaches first, by weight and key, ``beam`` vertices of each seed
    stay, then as many as the seed's ``per_seed`` and then the query's ``total`` leave room for; the next hop starts from
    these. Each hop is written down. Edges are dealt over ``parts`` partitions, so that a task's share need not grow with them.
    """
    dealt = lambda df, by: df.repartition(parts, by) if parts else df
    known = vertices.where("chunk_id IS NOT NULL").select(F.col("key").alias("dst")).distinct()
    heaviest = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("weight"), "dst"))
    reaching = dealt(edges.where(F.col("weight") >= least_weight).select("src", "dst", "weight"), "dst").join(dealt(known, "dst"), "dst", "left_semi")
    strong = dealt(reaching, "src").groupBy("src", "dst").agg(F.max("weight").alias("weight"))
    walked = cut(strong.withColumn("_r", heaviest).where(F.col("_r") <= per_node).drop("_r"))
    text = F.col("seed").cast("string")
    frontier = cut(seeds.select("query_id", "seed").distinct().select("query_id", "seed", F.col("seed").alias("key"), F.lit(0).alias("hop"), F.lit(None).cast("double").alias("weight"), F.array(text).alias("path")))
    seen, out = frontier.select("query_id", "key"), None
    for hop in range(1, hops + 1):
        step = frontier.select("query_id", "seed", F.col("key").alias("src"), "path").join(walked, "src")
        step = step.join(seen.select("query_id", F.col("key").alias("dst")), ["query_id", "dst"], "left_anti")
        way = F.struct((-F.col("weight")).alias("w"), "seed", F.concat("path", F.array(F.col("dst").cast("string"))).alias("path"))
        reached = step.groupBy("query_id", F.col("dst").alias("key")).agg(F.min(way).alias("m")).select("query_id", "m.seed", "key", F.lit(hop).alias("hop"), (-F.col("m.w")).alias("weight"), "m.path")

        def first(rows: DataFrame, by: list[str], room: DataFrame | None, most: int) -> DataFrame:
            rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("weight"), "key"))
            ranked = rows.withColumn("_r", rank).where(F.col("_r") <= most)  # which is pushed below the shuffle
            if room is not None:
                ranked = ranked.join(room.groupBy(*by).agg(F.count(F.lit(1)).alias("_used")), by, "left").where(F.col("_r") <= most - F.coalesce("_used", F.lit(0))).drop("_used")
            return ranked.drop("_r")

        if beam:
            reached = first(reached, ["query_id", "seed"], None, beam)
        reached = first(reached, ["query_id", "seed"], out, per_seed)
        frontier = cut(first(reached, ["query_id"], out, total))
        out = frontier if out is None else out.unionByName(frontier)
        seen = seen.unionByName(frontier.select("query_id", "key"))
    return out
