"""Queries on the incremental index."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ids, text
from ..operators import index, similar
from . import query, table


@query("SELECT doc_id, source, sha256(text) AS content_hash FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels l JOIN documents e USING (doc_id) WHERE e.source = documents.source AND sha256(e.text) = sha256(documents.text))")
def selective_upsert(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", ids.checksum(F.col("text")).alias("content_hash"))
    known = docs.join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi")
    return index.delta(docs, known, ["source", "content_hash"])


@query(
    """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN sha256(text || '!') ELSE sha256(text) END AS content_hash, CASE WHEN doc_id % 5 = 0 THEN 2 ELSE 1 END::BIGINT AS version FROM documents"""
)
def upsert_rows(spark, d):
    docs = table(spark, d, "documents")
    old = docs.select("doc_id", ids.checksum(F.col("text")).alias("content_hash"), F.lit(1).alias("version"))
    new = docs.where("doc_id % 5 = 0").select("doc_id", ids.checksum(F.concat("text", F.lit("!"))).alias("content_hash"), F.lit(2).alias("version"))
    return index.upsert(old, new, "doc_id")


PRINTS = "SELECT source, sha256(array_to_string(list_sort(list_distinct(list(sha256(text)))), '')) AS fingerprint, count(DISTINCT sha256(text)) AS chunks FROM documents GROUP BY source"


@query(PRINTS)
def chunk_fingerprint(spark, d):
    h = ids.checksum(F.col("text"))
    return table(spark, d, "documents").groupBy("source").agg(index.fingerprint(h).alias("fingerprint"), F.countDistinct(h).alias("chunks"))


@query(
    f"""WITH f AS ({PRINTS}), m AS (SELECT 'src' || k AS source, CASE WHEN k % 4 = 3 THEN NULL ELSE coalesce(chunks, 5) + (k % 4 = 1)::BIGINT END AS expected_chunks, f.fingerprint, chunks FROM range(0, 24) t(k) LEFT JOIN f ON f.source = 'src' || k)
SELECT source, CASE WHEN coalesce(chunks, 0) = 0 THEN 'in-progress' WHEN expected_chunks IS NULL OR chunks = expected_chunks THEN 'completed' ELSE 'partial' END AS status FROM m"""
)
def manifest_status(spark, d):
    counts = chunk_fingerprint(spark, d).select("source", F.col("fingerprint").alias("found_fingerprint"), F.col("chunks").alias("found_chunks"))
    raw = spark.range(24).select(F.col("id").alias("k"), F.concat(F.lit("src"), "id").alias("source"))
    expected = F.when(F.col("k") % 4 != 3, F.coalesce("found_chunks", F.lit(5)) + (F.col("k") % 4 == 1).cast("long"))
    manifests = raw.join(counts, "source", "left").select("source", expected.alias("expected_chunks"), F.col("found_fingerprint").alias("expected_fingerprint"))
    return index.manifest_status(manifests, counts, "source").select("source", "status")


@query("SELECT source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY source")
def count_per_source(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query(
    """SELECT page_id, ext, CASE WHEN ext IN ('html', 'htm') THEN 'html' WHEN ext = 'md' THEN 'md' WHEN ext = 'csv' THEN 'csv' END AS parser, CASE WHEN ext IN ('html', 'htm') THEN 'text/html' WHEN ext = 'md' THEN 'text/markdown' WHEN ext = 'csv' THEN 'text/csv' END AS mime
FROM (SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'html' WHEN 1 THEN 'htm' WHEN 2 THEN 'md' WHEN 3 THEN 'csv' ELSE 'xyz' END AS ext FROM pages)"""
)
def format_dispatch(spark, d):
    names = table(spark, d, "pages").select("page_id", F.concat(F.lit("a.b/f."), F.element_at(F.array(*map(F.lit, ("HTML", "htm", "md", "csv", "xyz"))), (F.col("page_id") % 5 + 1).cast("int"))).alias("name"))
    ext = text.extension(F.col("name"))
    parser, mime = index.dispatch(ext)
    return names.select("page_id", ext.alias("ext"), parser.alias("parser"), mime.alias("mime"))


@query(
    """SELECT coalesce(l.path, r.path) AS path, CASE WHEN l.path IS NULL THEN 'delete' WHEN l.digest = r.digest THEN 'skip' ELSE 'upload' END AS action
FROM (SELECT doc_id AS path, md5(text) AS digest FROM documents WHERE doc_id % 3 > 0) l FULL JOIN (SELECT doc_id AS path, md5(CASE WHEN doc_id % 7 = 0 THEN lang ELSE text END) AS digest FROM documents WHERE doc_id % 4 > 0) r ON l.path = r.path"""
)
def sync_plan(spark, d):
    docs = table(spark, d, "documents")
    local = docs.where("doc_id % 3 > 0").select(F.col("doc_id").alias("path"), F.md5("text").alias("digest"))
    remote = docs.where("doc_id % 4 > 0").select(F.col("doc_id").alias("path"), F.md5(F.when(F.col("doc_id") % 7 == 0, F.col("lang")).otherwise(F.col("text"))).alias("digest"))
    return index.sync_plan(local, remote)


@query(
    """SELECT event_id, coalesce(CAST(trunc(TRY_CAST(v AS DOUBLE)) AS BIGINT), 0) AS n, coalesce(TRY_CAST(v AS DOUBLE), 0.0) AS x, lower(trim(v)) IN ('1', 'true', 'yes') AS b, array_to_string(CASE WHEN contains(v, ',') THEN string_split(v, ',') WHEN contains(v, '-') THEN string_split(v, '-') ELSE [v] END, '/') AS a
FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN CAST(value AS VARCHAR) WHEN 1 THEN ' Yes ' WHEN 2 THEN 'a,b' WHEN 3 THEN 'c-d' ELSE '1' END AS v FROM (SELECT event_id, CAST(event_id AS VARCHAR) || '.75' AS value FROM events))"""
)
def coerce_props(spark, d):
    k = F.col("event_id") % 5
    v = F.when(k == 0, F.concat("event_id", F.lit(".75"))).when(k == 1, " Yes ").when(k == 2, "a,b").when(k == 3, "c-d").otherwise("1")
    rows = table(spark, d, "events").select("event_id", v.alias("v"))
    return rows.select("event_id", index.coerce_long(F.col("v")).alias("n"), index.coerce_double(F.col("v")).alias("x"), index.coerce_bool(F.col("v")).alias("b"), F.array_join(index.coerce_array(F.col("v")), "/").alias("a"))


@query("SELECT event_type, string_agg(DISTINCT k, ',' ORDER BY k) AS keys FROM (SELECT event_type, unnest(json_keys(props)) AS k FROM events) GROUP BY event_type")
def jsonl_keys(spark, d):
    keys = table(spark, d, "events").select("event_type", F.explode(F.json_object_keys("props")).alias("k"))
    return keys.groupBy("event_type").agg(F.array_join(F.array_sort(F.collect_set("k")), ",").alias("keys"))


@query("SELECT name AS path, 'group/' || ext || '/' || stem || CASE WHEN n = 1 THEN '' ELSE '_' || (n - 1) END || '.' || ext AS target FROM (SELECT *, row_number() OVER (PARTITION BY stem, ext ORDER BY name) AS n FROM (SELECT doc_id || '/' || source || '.' || lang AS name, source AS stem, lang AS ext FROM documents))")
def group_raw_files(spark, d):
    from pyspark.sql import Window

    files = table(spark, d, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit("/"), "source", F.lit("."), "lang").alias("path"), F.col("source").alias("stem"), F.col("lang").alias("ext"))
    n = F.row_number().over(Window.partitionBy("stem", "ext").orderBy("path"))
    name = F.concat(F.lit("group/"), "ext", F.lit("/"), "stem", F.when(F.col("n") == 1, "").otherwise(F.concat(F.lit("_"), (F.col("n") - 1).cast("string"))), F.lit("."), "ext")
    return files.withColumn("n", n).select("path", name.alias("target"))


@query("SELECT min(doc_id) AS keeper, count(*) AS copies, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) = '' AS blank FROM documents GROUP BY regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')")
def canonical_clusters(spark, d):
    key = F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " ")
    return table(spark, d, "documents").groupBy(F.sha2(key, 256).alias("h"), (F.trim(key) == "").alias("blank")).agg(F.min("doc_id").alias("keeper"), F.count(F.lit(1)).alias("copies")).select("keeper", "copies", "blank")


@query(
    r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^a-z0-9_]+'), lambda t: t <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(0, greatest(len(w) - 5, 0) + 1), lambda k: array_to_string(w[k + 1 : k + 5], ' '))) END AS s FROM w),
x AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
l AS MATERIALIZED (SELECT a, b FROM (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL) WHERE c >= 0.8 * (na + nb - c) - 1e-9),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS cluster FROM s LEFT JOIN (SELECT a, min(b) AS m FROM r GROUP BY a) ON a = doc_id"""
)
def near_duplicates(spark, d):
    """Clusters of documents of which each is linked by a similarity of 0.8 of five-word shingles."""
    return similar.near_duplicates(table(spark, d, "documents"), "doc_id", text.words(F.col("text")))


@query("SELECT lang, count(*) AS n, count(quality) AS labelled, CAST(coalesce(sum(quality), 0) AS BIGINT) AS good, CAST(count(*) FILTER (quality IS NULL) AS BIGINT) AS unlabelled FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang")
def label_join_stats(spark, d):
    joined = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left")
    return joined.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count("quality").alias("labelled"), F.coalesce(F.sum("quality"), F.lit(0)).alias("good"), F.count_if(F.col("quality").isNull()).alias("unlabelled"))
