"""Queries on retrieval, graph expansion and fusion."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.vectors import distance_score, dot, l2_normalize
from ..operators import ann, fusion, graph, inverted, retrieval, store
from ..operators.stages import new_folder
from . import query, table

WORDS = "list_filter(regexp_split_to_array(lower(text), '[^a-z0-9_]+'), lambda w: w <> '')"
DOT = "list_sum(list_transform(list_zip(v.embedding, q.embedding), lambda p: CAST(p[1] AS DOUBLE) * CAST(p[2] AS DOUBLE)))"
COSINE = f"round({DOT} / (sqrt(list_sum(list_transform(v.embedding, lambda x: CAST(x AS DOUBLE) * x))) * sqrt(list_sum(list_transform(q.embedding, lambda x: CAST(x AS DOUBLE) * x)))), 6)"
VEC = f"SELECT q.vec_id AS query_id, v.vec_id AS id, {COSINE} AS score FROM embeddings v JOIN embeddings q ON q.vec_id % 20 = 0"
SIGNALS = f"""d AS (SELECT doc_id, {WORDS} AS w FROM documents), st AS (SELECT count(*) AS n, avg(coalesce(len(w), 0)) AS al FROM d),
t AS (SELECT item_id, len(q) AS asked, unnest(q) AS term FROM (SELECT item_id, list_distinct({WORDS}) AS q FROM benchmark WHERE item_id % 20 = 0)), p AS (SELECT doc_id, len(w) AS l, unnest(w) AS term FROM d),
tf AS (SELECT term, doc_id, l, count(*) AS tf FROM p WHERE term IN (SELECT term FROM t) GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
sig AS (SELECT item_id AS query_id, doc_id AS id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * l / al))), 6) AS bm25, round(count(*) / any_value(asked), 6) AS lex FROM tf JOIN df USING (term) JOIN t USING (term), st GROUP BY ALL),
bm AS (SELECT query_id, id, bm25 AS score FROM sig), l AS (SELECT query_id, id, lex AS score FROM sig)"""

# the same signals, asked by all of the benchmark
EVERY = SIGNALS.replace(" WHERE item_id % 20 = 0", "")


def _walk_sql(hops: int, per_node: int, beam: int, per_seed: int, total: int) -> str:
    """The capped walk hop by hop: customers and suppliers that orders link."""
    sql = f"""WITH l AS (SELECT o_custkey, l_suppkey, l_quantity, l_discount FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
e AS (SELECT src, dst, max(w) AS w FROM (SELECT 2 * o_custkey AS src, 2 * l_suppkey + 1 AS dst, least(1.0, 0.5 + CAST(l_quantity AS DOUBLE) / 100) AS w FROM l UNION ALL SELECT 2 * l_suppkey + 1, 2 * o_custkey, 0.5 + 5 * CAST(l_discount AS DOUBLE) FROM l) WHERE w >= 0.7 GROUP BY ALL),
ok AS (SELECT 2 * c_custkey AS key FROM customer WHERE c_acctbal > 0 UNION SELECT 2 * s_suppkey + 1 FROM supplier WHERE s_acctbal > 0),
n AS (SELECT * FROM e WHERE dst IN (SELECT key FROM ok) QUALIFY row_number() OVER (PARTITION BY src ORDER BY w DESC, dst) <= {per_node}),
f0 AS (SELECT CAST(c_nationkey AS BIGINT) AS q, CAST(2 * c_custkey AS BIGINT) AS seed, CAST(2 * c_custkey AS BIGINT) AS key, [CAST(2 * c_custkey AS VARCHAR)] AS path FROM customer WHERE c_custkey % 20 = 0)"""
    for h in range(1, hops + 1):
        seen = " UNION ALL ".join(f"SELECT q, key FROM f{k}" for k in range(h))
        used = " UNION ALL ".join(f"SELECT q, seed FROM f{k}" for k in range(1, h)) or "SELECT q, seed FROM f0 WHERE false"
        sql += f""",
r{h} AS (SELECT f.q, f.seed, CAST(n.dst AS BIGINT) AS key, n.w, list_append(f.path, CAST(n.dst AS VARCHAR)) AS path FROM f{h - 1} f JOIN n ON n.src = f.key WHERE NOT EXISTS (SELECT 1 FROM ({seen}) s WHERE s.q = f.q AND s.key = n.dst)
QUALIFY row_number() OVER (PARTITION BY f.q, n.dst ORDER BY n.w DESC, f.seed, list_append(f.path, CAST(n.dst AS VARCHAR))) = 1),
b{h} AS (SELECT * FROM r{h} QUALIFY row_number() OVER (PARTITION BY q, seed ORDER BY w DESC, key) <= {beam}),
s{h} AS (SELECT b.* FROM b{h} b LEFT JOIN (SELECT q, seed, count(*) AS n FROM ({used}) GROUP BY ALL) u ON u.q = b.q AND u.seed = b.seed QUALIFY row_number() OVER (PARTITION BY b.q, b.seed ORDER BY w DESC, key) <= {per_seed} - coalesce(u.n, 0)),
f{h} AS (SELECT s.* FROM s{h} s LEFT JOIN (SELECT q, count(*) AS n FROM ({used}) GROUP BY ALL) u ON u.q = s.q QUALIFY row_number() OVER (PARTITION BY s.q ORDER BY w DESC, key) <= {total} - coalesce(u.n, 0))"""
    return sql + " " + " UNION ALL ".join(f"SELECT q AS query_id, seed, key, CAST({h} AS BIGINT) AS hop, round(w, 6) AS weight, array_to_string(path, '>') AS path FROM f{h}" for h in range(1, hops + 1))


def _top(rows: str, k: int) -> str:
    return f"SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM ({rows}) QUALIFY rank <= {k}"


#: Order lines whose edges are one task's share.
EDGE_ROWS = 250_000


def asked_vectors(spark, d):
    """Every twentieth vector asks."""
    return table(spark, d, "embeddings").where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))


def asked_texts(spark, d):
    return table(spark, d, "benchmark").where("item_id % 20 = 0").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def every_text(spark, d):
    return table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def signals(spark, d, asked=asked_texts):
    return retrieval.text_signals(table(spark, d, "documents"), asked(spark, d), "doc_id", text.words)


def best(rows, score: str, k: int):
    return retrieval.top_k(rows.select("query_id", "id", F.col(score).alias("score")), "query_id", "score", "id", k)


@query(_top(VEC, 50))
def vector_topk(spark, d):
    return retrieval.vector_topk(table(spark, d, "embeddings"), asked_vectors(spark, d), 50)


@query(None)
def ivf_topk(spark, d):
    vectors = table(spark, d, "embeddings")
    model, lists = retrieval.ivf_lists(vectors, 16)
    return retrieval.ivf_search(model, lists, asked_vectors(spark, d), 10, probes=12)


@query(None)
def ivf_pq_topk(spark, d):
    """An index with product quantisation, written and searched: 16 codes a vector, 40 candidates ranked exactly."""
    folder = new_folder(spark, "ivf-pq")
    ann.write_index(table(spark, d, "embeddings"), folder, lists=16, parts=16)
    return ann.search_index(spark, folder, asked_vectors(spark, d), 10, probes=12, shortlist=100)


@query(None)
def nn_edges(spark, d):
    """The five nearest others of every vector, by NN-descent."""
    return ann.nn_descent(table(spark, d, "embeddings"), 5)


@query(f"WITH {EVERY} {_top('SELECT * FROM bm', 30)}")
def bm25_topk(spark, d):
    return best(signals(spark, d, every_text), "bm25", 30)


@query(f"WITH {EVERY} {_top('SELECT * FROM bm', 30)}")
def bm25_index_topk(spark, d):
    """The same from an inverted index that is written first, in two segments, and read by block maxima."""
    folder, docs = new_folder(spark, "postings"), table(spark, d, "documents")
    for part in (F.col("doc_id") % 2 == 0, F.col("doc_id") % 2 != 0):
        inverted.append(docs.where(part), folder, "doc_id", text.words)
    return inverted.bm25_topk(spark, folder, every_text(spark, d), 30, text.words)


@query(f"WITH {EVERY} {_top('SELECT * FROM l', 20)}")
def lexical_overlap(spark, d):
    return best(signals(spark, d, every_text), "lex", 20)


@query("SELECT item_id, doc_id FROM documents JOIN benchmark ON contains(lower(documents.text), lower(benchmark.text)) WHERE item_id % 20 = 0")
def substring_search(spark, d):
    asked = asked_texts(spark, d).withColumn("query", F.lower("query"))
    docs = table(spark, d, "documents").select("doc_id", F.lower("text").alias("text"))
    return retrieval.substring_hits(docs, asked, "doc_id").select(F.col("query_id").alias("item_id"), "doc_id")


@query(f"SELECT query_id AS src, id AS dst, score FROM ({_top(f'SELECT * FROM ({VEC.replace("q.vec_id % 20 = 0", "true")}) WHERE query_id <> id', 5)})")
def knn_edges(spark, d):
    """The five nearest others of every vector."""
    own = table(spark, d, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    found = retrieval.vector_topk(table(spark, d, "embeddings"), own, 6).where("query_id <> id")
    return retrieval.top_k(found.drop("rank"), "query_id", "score", "id", 5).select(F.col("query_id").alias("src"), F.col("id").alias("dst"), "score")


@query("SELECT conv_id, src, dst FROM (SELECT conv_id, turn AS src, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS dst FROM (SELECT DISTINCT conv_id, turn FROM conversations)) WHERE dst IS NOT NULL")
def adjacent_edges(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn").distinct().withColumn("key", F.struct("conv_id", "turn"))
    edges = graph.adjacency(turns, "conv_id", "turn", "key")
    return edges.select("src.conv_id", F.col("src.turn").alias("src"), F.col("dst.turn").alias("dst"))


@query("SELECT DISTINCT p_partkey, w AS token, n_nationkey::BIGINT AS entity FROM (SELECT p_partkey, unnest(list_filter(string_split(lower(p_name || ' ' || CASE WHEN p_partkey % 3 = 0 THEN 'NATION_' || p_partkey % 25 ELSE 'x' END), ' '), lambda t: length(t) > 2)) AS w FROM part) JOIN nation ON lower(n_name) = w OR 'nation_' || n_nationkey = w")
def entity_lookup(spark, d):
    said = F.concat_ws(" ", "p_name", F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("NATION_"), (F.col("p_partkey") % 25).cast("string"))).otherwise("x"))
    tokens = table(spark, d, "part").select("p_partkey", F.explode(F.filter(F.split(F.lower(said), " "), lambda t: F.length(t) > 2)).alias("token"))
    nation = table(spark, d, "nation")
    names = nation.select(F.lower("n_name").alias("token"), F.col("n_nationkey").alias("entity")).unionByName(nation.select(F.concat(F.lit("nation_"), F.col("n_nationkey").cast("string")).alias("token"), F.col("n_nationkey").alias("entity")))
    return tokens.join(names, "token").select("p_partkey", "token", "entity").distinct()


EDGES = "SELECT DISTINCT c_nationkey AS src, (c_nationkey + c_custkey % 4 * 3 + 1) % 25 AS dst FROM customer"


def _edges(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("src"), ((F.col("c_nationkey") + F.col("c_custkey") % 4 * 3 + 1) % 25).cast("long").alias("dst")).distinct()


def _hops(edges: str, hops: int, seeds: str) -> str:
    return f"""WITH RECURSIVE e AS ({edges}), r AS (SELECT s AS seed, s AS key, 0 AS hop FROM ({seeds}) UNION SELECT r.seed, e.dst, r.hop + 1 FROM r JOIN e ON e.src = r.key WHERE r.hop < {hops})
SELECT CAST(seed AS BIGINT) AS seed, CAST(key AS BIGINT) AS key, CAST(min(hop) AS BIGINT) AS hop, 1.0 / (1 + min(hop)) AS score FROM r GROUP BY seed, key HAVING min(hop) > 0"""


@query(_hops(EDGES, 1, "SELECT n_nationkey AS s FROM nation"))
def graph_neighbors(spark, d):
    seeds = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("seed"))
    return graph.expand(seeds, _edges(spark, d), 1).select("seed", "key", "hop", graph.hop_score(F.col("hop")).alias("score"))


@query(_hops(EDGES, 2, "SELECT n_nationkey AS s FROM nation"))
def gear_expand(spark, d):
    seeds = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("seed"))
    return graph.expand(seeds, _edges(spark, d), 2).select("seed", "key", "hop", graph.hop_score(F.col("hop")).alias("score"))


@query(_hops(f"SELECT src, dst FROM (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) AS r FROM ({EDGES})) WHERE r <= 2", 2, "SELECT n_nationkey AS s FROM nation"))
def graph_caps(spark, d):
    seeds = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("seed"))
    return graph.expand(seeds, _edges(spark, d), 2, per_node=2).select("seed", "key", "hop", graph.hop_score(F.col("hop")).alias("score"))


@query(_walk_sql(3, 2, 3, 6, 20))
def capped_walk(spark, d):
    """Customers and suppliers within three steps of a nation's customers, along orders, with every cap binding."""
    orders, items = table(spark, d, "orders"), table(spark, d, "lineitem")
    parts = max(spark.sparkContext.defaultParallelism, 1 + items.count() // EDGE_ROWS)
    items, orders = items.repartition(parts, "l_orderkey"), orders.repartition(parts, "o_orderkey")
    sold = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_suppkey", F.col("l_quantity").cast("double").alias("quantity"), F.col("l_discount").cast("double").alias("discount"))
    buyer, seller = (2 * F.col("o_custkey")).cast("long"), (2 * F.col("l_suppkey") + 1).cast("long")
    edges = sold.select(buyer.alias("src"), seller.alias("dst"), F.least(F.lit(1.0), 0.5 + F.col("quantity") / 100).alias("weight")).unionByName(sold.select(seller.alias("src"), buyer.alias("dst"), (0.5 + 5 * F.col("discount")).alias("weight")))
    customers, suppliers = table(spark, d, "customer"), table(spark, d, "supplier")
    chunk = lambda balance, key: F.when(F.col(balance) > 0, key).alias("chunk_id")
    c_key, s_key = (2 * F.col("c_custkey")).cast("long"), (2 * F.col("s_suppkey") + 1).cast("long")
    vertices = customers.select(c_key.alias("key"), chunk("c_acctbal", c_key)).unionByName(suppliers.select(s_key.alias("key"), chunk("s_acctbal", s_key)))
    seeds = customers.where("c_custkey % 20 = 0").select(F.col("c_nationkey").cast("long").alias("query_id"), c_key.alias("seed"))
    walk = graph.capped_walk(seeds, edges, vertices, 3, per_node=2, beam=3, per_seed=6, total=20, parts=parts)
    return walk.withColumn("path", F.array_join("path", ">")).withColumn("weight", F.round("weight", 6))


@query(f"WITH {EVERY} SELECT query_id, id, round(0.6 * CASE WHEN ha <= la + 1e-12 THEN 1.0 ELSE (bm25 - la) / (ha - la) END + 0.4 * CASE WHEN hb <= lb + 1e-12 THEN 1.0 ELSE (lex - lb) / (hb - lb) END, 6) AS final_score FROM (SELECT *, min(bm25) OVER w AS la, max(bm25) OVER w AS ha, min(lex) OVER w AS lb, max(lex) OVER w AS hb FROM sig WINDOW w AS (PARTITION BY query_id))")
def minmax_fuse(spark, d):
    return fusion.fuse(signals(spark, d, every_text), {"bm25": 0.6, "lex": 0.4}).select("query_id", "id", "final_score")


@query(f"WITH {SIGNALS}, v AS (SELECT query_id, id, greatest(0.0, score) AS score FROM ({_top(VEC, 20)})), x AS ({_top('SELECT * FROM l', 20)}) SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM (SELECT coalesce(v.query_id, x.query_id) AS query_id, coalesce(v.id, x.id) AS id, round(0.7 * coalesce(v.score, 0) + 0.3 * coalesce(x.score, 0), 7) AS score FROM v FULL JOIN x ON v.query_id = x.query_id AND v.id = x.id) WHERE score > 0 QUALIFY rank <= 20")
def hybrid_merge(spark, d):
    top = retrieval.vector_topk(table(spark, d, "embeddings"), asked_vectors(spark, d), 20)
    vec = top.withColumn("score", distance_score(1 - F.col("score")))
    lex = best(signals(spark, d), "lex", 20)
    return retrieval.top_k(fusion.hybrid(vec, lex).select("query_id", "id", "score"), "query_id", "score", "id", 20)


# The graph of documents: from each to the next one of its source; entities are documents by their first word.
GRAPH = """e AS (SELECT * FROM (SELECT doc_id AS src, lead(doc_id) OVER (PARTITION BY source ORDER BY doc_id) AS dst FROM documents) WHERE dst IS NOT NULL),
seeds AS (SELECT DISTINCT query_id, doc_id AS seed FROM (SELECT item_id AS query_id, unnest(list_filter(string_split(lower(text), ' '), lambda w: length(w) > 2)) AS w FROM benchmark WHERE item_id % 20 = 0) JOIN documents ON lower(string_split(text, ' ')[1]) = w),
walk AS (SELECT query_id, dst AS key, 1 AS hop, seed || '>' || dst AS path FROM seeds JOIN e ON src = seed UNION ALL SELECT query_id, b.dst, 2, seed || '>' || a.dst || '>' || b.dst FROM seeds JOIN e a ON a.src = seed JOIN e b ON b.src = a.dst),
met AS (SELECT query_id, key AS id, min(hop) AS hop, min_by(path, (hop, path)) AS path FROM walk GROUP BY ALL),
graph AS (SELECT query_id, id, 1.0 / (1 + hop) AS score FROM met WHERE hop = 1 QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY id) <= 50),
gear AS (SELECT query_id, id, 1.0 / (1 + hop) AS score, path FROM met QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY hop, id) <= 20)"""


def walked(spark, d, hops: int):
    """(query_id, id, hop, path): documents within ``hops`` of the entities that a query names."""
    docs = table(spark, d, "documents")
    edges = graph.adjacency(docs.select("source", "doc_id"), "source", "doc_id", "doc_id")
    said = asked_texts(spark, d).select("query_id", F.explode(F.array_distinct(F.filter(F.split(F.lower("query"), " "), lambda w: F.length(w) > 2))).alias("name"))
    entities = docs.select(F.lower(F.get(F.split("text", " "), F.lit(0))).alias("name"), F.col("doc_id").alias("seed"))
    seeds = entities.join(retrieval.small(said), "name").select("query_id", "seed").distinct()
    reached = graph.expand(seeds.select("seed").distinct(), edges, hops)
    path = F.array_join("path", ">")
    return seeds.join(reached, "seed").groupBy("query_id", F.col("key").alias("id")).agg(F.min(F.struct("hop", path.alias("path"))).alias("m")).select("query_id", "id", "m.hop", "m.path")


def first_reached(met, k: int):
    """The first k by hop and id, scored by hop."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("hop", "id"))
    return met.withColumn("_r", rank).where(F.col("_r") <= k).select("query_id", "id", graph.hop_score(F.col("hop")).alias("score"), "path")


@query(f"WITH {GRAPH} SELECT query_id, id, round(score, 6) AS score, path FROM gear")
def gear_beam(spark, d):
    """Entities that a query names, expanded over two hops with a beam of 20, with paths."""
    return first_reached(walked(spark, d, 2), 20).withColumn("score", F.round("score", 6))


RANKED = "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)"


@query(f"WITH {SIGNALS}, {GRAPH}, v AS ({_top(VEC, 20)}), x AS ({_top('SELECT * FROM l', 20)}), one AS (SELECT query_id, id, round(sum(s), 6) AS score FROM (SELECT query_id, id, 1.5 / (35 + rank) AS s FROM v UNION ALL SELECT query_id, id, 1.0 / (35 + rank) FROM x) GROUP BY ALL) SELECT query_id, id, round(sum(s), 6) AS score FROM (SELECT query_id, id, 1.2 / (60 + {RANKED}) AS s FROM one UNION ALL SELECT query_id, id, 0.8 / (60 + {RANKED}) FROM gear) GROUP BY ALL")
def rrf_two_stage(spark, d):
    vec = retrieval.vector_topk(table(spark, d, "embeddings"), asked_vectors(spark, d), 20)
    one = fusion.rrf({"vec": (vec, 1.5), "lex": (best(signals(spark, d), "lex", 20), 1.0)}, 35)
    return fusion.rrf({"one": (one, 1.2), "graph": (first_reached(walked(spark, d, 2), 20), 0.8)}, 60)


@query(f"WITH {SIGNALS}, x AS ({_top('SELECT * FROM l', 20)}) SELECT x.query_id, x.id, round(x.score * 0.5 + 0.5 * coalesce({COSINE}, 0), 7) AS score FROM x LEFT JOIN embeddings q ON q.vec_id = x.query_id LEFT JOIN embeddings v ON v.vec_id = x.id")
def rerank_blend(spark, d):
    """Lexical hits, half their score from the cosine of query and document."""
    lex = best(signals(spark, d), "lex", 20)
    vectors = table(spark, d, "embeddings")
    pairs = lex.join(vectors.select(F.col("vec_id").alias("query_id"), l2_normalize(F.col("embedding")).alias("q")), "query_id", "left").join(vectors.select(F.col("vec_id").alias("id"), l2_normalize(F.col("embedding")).alias("v")), "id", "left")
    return fusion.rerank_blend(pairs, F.coalesce(F.round(dot(F.col("q"), F.col("v")), 6), F.lit(0.0))).select("query_id", "id", "score")


@query(f"WITH {EVERY}, best AS ({_top('SELECT * FROM bm', 5)}) SELECT query_id, string_agg('(' || source || ', doc ' || id || ')', '; ' ORDER BY rank) AS citations, count(*) AS n FROM best JOIN documents ON doc_id = id GROUP BY query_id")
def answer_citations(spark, d):
    cited = best(signals(spark, d, every_text), "bm25", 5).join(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source"), "id")
    said = F.array_sort(F.collect_list(F.struct("rank", F.format_string("(%s, doc %d)", "source", "id").alias("c"))))
    return cited.groupBy("query_id").agg(F.array_join(F.transform(said, lambda e: e["c"]), "; ").alias("citations"), F.count(F.lit(1)).alias("n"))


def _minmax_sql(names: str) -> str:
    bounds = ", ".join(f"min({c}) OVER w AS lo_{c}, max({c}) OVER w AS hi_{c}" for c in names.split())
    filled = ", ".join(f"coalesce(max({c}), 0) AS {c}" for c in names.split())
    total = " + ".join(f"{w} * CASE WHEN hi_{c} <= lo_{c} + 1e-12 THEN 1.0 ELSE ({c} - lo_{c}) / (hi_{c} - lo_{c}) END" for c, w in fusion.WEIGHTS.items())
    parts = " UNION ALL ".join(f"SELECT query_id, id, {', '.join('score' if c == n else 'NULL' for c in names.split())}, {'path' if n == 'gear' else 'NULL'} FROM {n}_hits" for n in names.split())
    return f"u(query_id, id, {', '.join(names.split())}, path) AS ({parts}), c AS (SELECT query_id, id, {filled}, max(path) AS path FROM u GROUP BY ALL), m AS (SELECT *, {bounds} FROM c WINDOW w AS (PARTITION BY query_id)), f AS (SELECT *, round({total}, 6) AS score FROM m)"


@query(
    f"WITH {SIGNALS}, {GRAPH}, vec_hits AS ({_top(f'SELECT * FROM ({VEC}) WHERE query_id IN (SELECT item_id FROM benchmark WHERE item_id % 20 = 0)', 50)}), bm25_hits AS ({_top('SELECT * FROM bm', 30)}), graph_hits AS (SELECT * FROM graph), gear_hits AS (SELECT * FROM gear), {_minmax_sql('vec bm25 graph gear')} "
    "SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, round(vec, 6) AS vec, round(bm25, 6) AS bm25, round(graph, 6) AS graph, round(gear, 6) AS gear, coalesce(path, '') AS gear_path, coalesce(source, '') AS source FROM f LEFT JOIN documents ON doc_id = id QUALIFY rank <= 10"
)
def retrieve(spark, d):
    """Vector, BM25, neighbour and multi-hop hits of each query, min-max normalised and fused, with provenance.

    A query's vector is that of its id. The ten best come with their signals, the path that led to them and
    their document's source.
    """
    queries = asked_texts(spark, d).select("query_id")
    vec = retrieval.vector_topk(table(spark, d, "embeddings"), asked_vectors(spark, d).join(queries, "query_id", "left_semi"), 50)
    met = walked(spark, d, 2)
    near = first_reached(met.where("hop = 1"), 50)
    gear = first_reached(met, 20)
    hits = fusion.assemble({"vec": vec, "bm25": best(signals(spark, d), "bm25", 30), "graph": near, "gear": gear})
    fused = fusion.fuse(hits, fusion.WEIGHTS).select("query_id", "id", F.col("final_score").alias("score"), fusion.provenance(list(fusion.WEIGHTS)).alias("why"))
    top = retrieval.top_k(fused, "query_id", "score", "id", 10).join(gear.select("query_id", "id", F.col("path").alias("gear_path")), ["query_id", "id"], "left")
    sources = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source")
    told = (F.coalesce(F.round(F.col(f"why.{s}"), 6), F.lit(0.0)).alias(s) for s in fusion.WEIGHTS)
    return top.join(sources, "id", "left").select("query_id", "id", "score", "rank", *told, F.coalesce("gear_path", F.lit("")).alias("gear_path"), F.coalesce("source", F.lit("")).alias("source"))


@query(
    f"WITH {SIGNALS}, v AS ({_top(VEC, 100)}), x AS ({_top('SELECT * FROM bm', 40)}), every AS (SELECT query_id, id, -min(rank) AS score FROM (SELECT query_id, id, rank FROM v UNION ALL SELECT query_id, id, rank FROM x) GROUP BY ALL), pool AS (SELECT * FROM every QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) <= 50), "
    "u AS (SELECT query_id, id, score FROM pool JOIN documents ON doc_id = id QUALIFY row_number() OVER (PARTITION BY query_id, text ORDER BY score DESC, id) = 1) "
    "SELECT query_id, id, CAST(score AS DOUBLE) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM u QUALIFY rank <= 5"
)
def candidate_funnel(spark, d):
    """BM25 40 and vectors 100, the 50 best by rank, equal texts once, 15 to a reranker, five to answer from."""
    vec = retrieval.vector_topk(table(spark, d, "embeddings"), asked_vectors(spark, d), 100)
    texts = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return store.funnel({"vec": (vec, 100), "bm25": (signals(spark, d).select("query_id", "id", F.col("bm25").alias("score")), 40)}, texts, 50, 15, 5)
