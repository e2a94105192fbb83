"""Queries on what a document store does: projection, filters, joins by key, counters, pages, model outputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import index, main_content, models, store
from . import query, table


@query("SELECT doc_id, CAST(doc_id AS VARCHAR) AS label, coalesce(TRY_CAST(lang AS DOUBLE), 0.0) AS rate, source = 'src1' AS flag, CASE WHEN lang IS NULL THEN NULL ELSE 'en' = lang END AS english FROM documents")
def project_schema(spark, d):
    """Columns coerced to the store's types in one generated select."""
    docs = table(spark, d, "documents").select("doc_id", F.col("doc_id").alias("label"), F.coalesce("lang", F.lit("x")).alias("rate"), F.when(F.col("source") == "src1", " TRUE ").when(F.col("source").isNotNull(), "no").alias("flag"), F.when(F.col("lang") == "en", 1).when(F.col("lang").isNotNull(), 0).alias("english"), F.lit(1).alias("_seen"), F.array().alias("embedding"))
    schema = {"label": ("text", False), "rate": ("number", False), "flag": ("bool", False), "english": ("bool", False)}
    return store.projected(store.properties(docs), schema)


@query("SELECT event_id, event_id + 1 AS a, CAST(event_id AS VARCHAR) || ',' || user_id AS joined, '{\"u\":' || user_id || '}' AS nested FROM events")
def project_arrays(spark, d):
    rows = table(spark, d, "events").select("event_id", F.array((F.col("event_id") + 1).cast("string")).alias("a"), F.concat_ws(",", "event_id", "user_id").alias("joined"), F.struct(F.col("user_id").alias("u")).alias("nested"))
    out = store.projected(rows, {"a": ("int", True), "joined": ("text", True)})
    return out.select("event_id", F.get("a", F.lit(0)).alias("a"), F.array_join("joined", ",").alias("joined"), "nested")


@query("SELECT doc_id FROM documents WHERE coalesce(n_chars, 0) >= 500")
def sized_objects(spark, d):
    return store.sized(table(spark, d, "documents"), 500, "n_chars").select("doc_id")


@query(
    """SELECT item, engine, conf FROM (SELECT l_orderkey AS item, l_linenumber AS engine, l_quantity * 2 AS conf, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_quantity * 2 >= 95 THEN 0 ELSE 1 END, CASE WHEN l_quantity * 2 >= 95 THEN l_linenumber END, l_quantity DESC, l_linenumber) AS r
FROM (SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL) WHERE l_quantity * 2 >= 20) WHERE r = 1"""
)
def ocr_best(spark, d):
    """Of several engines' readings the first that is sure enough, else the surest."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q"))
    readings = lines.select(F.col("l_orderkey").alias("item"), F.col("l_linenumber").alias("engine"), (F.col("q") * 2).alias("conf"))
    return store.best_reading(readings, "item", "engine", "conf", least=20.0)


@query("SELECT c_custkey, ends_with(lower(mail), '@corp.org') OR ends_with(lower(mail), '@shop.com') AS allowed FROM (SELECT c_custkey, c_name || CASE c_custkey % 4 WHEN 0 THEN '@Corp.org' WHEN 1 THEN '@shop.com' WHEN 2 THEN '@sub.corp.org' ELSE '' END AS mail FROM customer)")
def email_gate(spark, d):
    k = F.col("c_custkey") % 4
    mail = F.concat("c_name", F.when(k == 0, "@Corp.org").when(k == 1, "@shop.com").when(k == 2, "@sub.corp.org").otherwise(""))
    return table(spark, d, "customer").select("c_custkey", store.allowed_email(mail, ["corp.org", "shop.com"]).alias("allowed"))


@query("SELECT vec_id AS id, 1 - dist / 2 AS certainty FROM (SELECT vec_id, (vec_id % 40) / 10.0 AS dist FROM embeddings) WHERE vec_id >= 5 AND 1 - dist / 2 >= 0.25")
def certain_hits(spark, d):
    hits = table(spark, d, "embeddings").select(F.when(F.col("vec_id") >= 5, F.col("vec_id")).otherwise(-1).alias("id"), ((F.col("vec_id") % 40) / 10.0).alias("dist"))
    return store.certain(store.real_hits(hits), "dist").select("id", "certainty")


@query("SELECT doc_id FROM documents WHERE lang IN ('en', 'de') AND source = 'src1' AND n_chars < 5000 AND doc_id % 3 = 0 AND doc_id >= 100")
def metadata_filter(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", F.col("doc_id").alias("timestamp"), F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("kept"), F.lit("x"))).otherwise(F.array(F.lit("x"))).alias("tags"), "n_chars")
    return store.matching(docs, tags=["kept", "x"], since=100, lang=["en", "de"], source="src1").where("n_chars < 5000").select("doc_id")


@query("SELECT o_orderkey AS src, o_custkey AS dst FROM orders WHERE (o_orderkey % 100) / 100.0 >= 0.7 AND o_orderstatus IN ('F', 'O')")
def strong_edges(spark, d):
    edges = table(spark, d, "orders").select(F.col("o_orderkey").alias("src"), F.col("o_custkey").alias("dst"), ((F.col("o_orderkey") % 100) / 100.0).alias("weight"), F.col("o_orderstatus").alias("type"))
    return store.strong_edges(edges, kinds=["F", "O"]).select("src", "dst")


@query("SELECT vec_id, text IS NOT NULL AS has_text, len(embedding) AS width FROM embeddings LEFT JOIN documents ON vec_id = doc_id WHERE vec_id IS NOT NULL")
def embed_join(spark, d):
    """Embeddings and texts meet by key, never by position."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    joined = store.attached(table(spark, d, "embeddings").select("vec_id", "embedding"), docs, "vec_id")
    return joined.select("vec_id", F.col("text").isNotNull().alias("has_text"), F.size("embedding").alias("width"))


@query("SELECT doc_id || '.txt' AS path FROM documents WHERE doc_id % 3 = 0")
def sidecar_semi(spark, d):
    docs = table(spark, d, "documents")
    objects = docs.select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"))
    beside = docs.where("doc_id % 3 = 0").select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt.manifest.json")).alias("path"))
    return store.with_sidecar(objects, beside, ".manifest.json")


@query(
    """SELECT d.doc_id AS path FROM documents d WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'other' ELSE source END AS h FROM documents WHERE doc_id % 2 = 0 AND doc_id % 7 <> 0) m WHERE m.doc_id = d.doc_id AND m.h = d.source)"""
)
def skip_completed(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("path"), F.col("source").alias("file_hash"))
    k = F.col("path")
    manifests = docs.select("path", F.when(k % 5 == 0, "other").otherwise(F.col("file_hash")).alias("file_hash"), F.when(k % 2 == 0, "completed").otherwise("partial").alias("status"), F.lit(3).alias("expected_chunks"))
    counts = docs.select("path", F.when(k % 7 == 0, 2).otherwise(3).alias("found_chunks"))
    return index.to_do(docs, manifests, counts, "path").select("path")


@query("SELECT lang, count(*) FILTER (doc_id % 4 = 0) AS indexed, count(*) FILTER (doc_id % 4 = 1) AS skipped, count(*) FILTER (doc_id % 4 > 1) AS failed FROM documents GROUP BY lang")
def outcome_counts(spark, d):
    k = F.col("doc_id") % 4
    outcomes = table(spark, d, "documents").select("lang", F.when(k == 0, "indexed").when(k == 1, "skipped").otherwise("failed").alias("outcome"))
    return store.tally(outcomes, "outcome", ["indexed", "skipped", "failed"], "lang")


@query("SELECT conv_id, turn, role, CAST(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS BIGINT) AS parsed FROM conversations")
def cumulative_counters(spark, d):
    runs = table(spark, d, "conversations").withColumn("n", F.length("text"))
    return store.running_total(runs, "conv_id", ["turn", "role", "text"], "n", "parsed").select("conv_id", "turn", "role", "parsed")


@query("SELECT doc_id, source FROM documents ORDER BY source, doc_id LIMIT 40 OFFSET 80")
def result_page(spark, d):
    """A page of results; the limit is the feature."""
    return store.page(table(spark, d, "documents").select("doc_id", "source"), ["source", "doc_id"], 80, 40)


@query("SELECT doc_id, substr(coalesce(text, ''), 1, 800) AS long, substr(coalesce(text, ''), 1, 300) AS short FROM documents")
def snippets(spark, d):
    return table(spark, d, "documents").select("doc_id", store.snippet(F.col("text"), 800).alias("long"), store.snippet(F.col("text"), 300).alias("short"))


@query("SELECT DISTINCT user_id FROM (SELECT user_id FROM events ORDER BY ts, event_id LIMIT 50)")
def distinct_after_limit(spark, d):
    return store.first_distinct(table(spark, d, "events"), ["ts", "event_id"], ["user_id"], 50)


@query("SELECT page_id, lower(trim(h)) IN ('', 'root') AS rootish FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN ' Root ' WHEN 1 THEN '' WHEN 2 THEN 'intro' ELSE '' END AS h FROM pages)")
def root_headings(spark, d):
    k = F.col("page_id") % 4
    return table(spark, d, "pages").select("page_id", store.rootish(F.when(k == 0, " Root ").when(k == 1, "").when(k == 2, "intro")).alias("rootish"))


@query("SELECT event_id, greatest(1, least(CASE event_id % 4 WHEN 0 THEN event_id - 50 WHEN 1 THEN 256 ELSE 512 END, 4000)) AS n FROM events")
def clamp_length(spark, d):
    k = F.col("event_id") % 4
    asked = F.when(k == 0, (F.col("event_id") - 50).cast("string")).when(k == 1, "256").when(k == 2, "many")
    return table(spark, d, "events").select("event_id", models.clamped(asked, 512, 4000).alias("n"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS stamp FROM events")
def utc_stamps(spark, d):
    return table(spark, d, "events").select("event_id", store.utc_stamp(F.col("ts").cast("timestamp")).alias("stamp"))


@query("SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda t: t <> '')) AS n, array_to_string(list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda t: t <> ''), ' ') AS text FROM documents")
def token_codec(spark, d):
    tokens = text.tokens(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.when(F.col("text").isNotNull(), F.size(tokens)).alias("n"), text.decoded_tokens(tokens).alias("text"))


@query(r"SELECT p_partkey, 'book_' || trim(regexp_replace(p_name || '/' || p_type, '[^\p{L}\p{N} _-]', '_', 'g')) || '.csv' AS file FROM part")
def sheet_files(spark, d):
    from ..sources.formats import sheet_file

    return table(spark, d, "part").select("p_partkey", sheet_file(F.lit("book"), F.concat_ws("/", "p_name", "p_type")).alias("file"))


@query("SELECT doc_id, contains(lower(x), 'encryptedpackage') OR contains(lower(x), 'encryptioninfo') AS encrypted FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'PK EncryptedPackage ' WHEN 1 THEN 'EncryptionInfo' ELSE 'PK' END || coalesce(lang, '') AS x FROM documents)")
def encrypted_files(spark, d):
    from ..sources.formats import encrypted

    k = F.col("doc_id") % 3
    content = F.concat(F.when(k == 0, "PK EncryptedPackage ").when(k == 1, "EncryptionInfo").otherwise("PK"), F.coalesce("lang", F.lit(""))).cast("binary")
    return table(spark, d, "documents").select("doc_id", encrypted(content).alias("encrypted"))


@query(
    """SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'md' WHEN 1 THEN 'html' WHEN 2 THEN 'txt' WHEN 3 THEN 'csv' WHEN 4 THEN 'md' ELSE '' END AS ext FROM pages"""
)
def detect_extension(spark, d):
    pick = lambda *values: F.element_at(F.array(*map(F.lit, values)), (F.col("page_id") % 6 + 1).cast("int"))
    key = pick("a/b%2Emarkdown?v=1.txt", "a%20c.HTML#x.md", "plain", "named", "typed", "nothing")
    got = text.detected_extension(key, pick("", "", "text/plain", "text/plain", "Text/Markdown", "image/png"), pick("", "", "", "t.csv", "", ""))
    return table(spark, d, "pages").select("page_id", got.alias("ext"))


BLOCKS = r"'</?(?:p|div|br|tr|table|ul|ol|section|article|main|body|html|head)\b[^>]*>'"


def _markdown_sql() -> str:
    x = "html"
    for tag in ("script", "style", "nav", "header", "footer", "aside", "form", "title"):
        x = rf"regexp_replace({x}, '<{tag}\b[^>]*>.*?</{tag}>', ' ', 'gis')"
    x = rf"regexp_replace(regexp_replace({x}, '<!--.*?-->', ' ', 'gs'), '\s+', ' ', 'g')"
    for level in range(1, 7):
        x = rf"regexp_replace({x}, '<h{level}\b[^>]*>(.*?)</h{level}>', chr(10) || '{'#' * level} \1' || chr(10), 'gis')"
    x = rf"regexp_replace(regexp_replace({x}, '<li\b[^>]*>', chr(10) || '- ', 'gis'), {BLOCKS}, chr(10), 'gis')"
    x = rf"regexp_replace(regexp_replace({x}, '<[^>]+>', '', 'gs'), ' *\n *', chr(10), 'g')"
    return rf"SELECT page_id, regexp_replace(regexp_replace({x}, '\n\n+', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS markdown, trim(regexp_replace(regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'is'), '\s+', ' ', 'g')) AS title FROM pages"


@query(_markdown_sql())
def html_markdown(spark, d):
    return table(spark, d, "pages").select("page_id", text.html_markdown(F.col("html")).alias("markdown"), text.html_title(F.col("html")).alias("title"))


SQUEEZED = r"trim(regexp_replace(x, '[\s\x01\x02]+', ' ', 'g'))"


@query(
    rf"""WITH p AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)), '^(?:www|m)\.', '') AS site,
regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<(?:script|style|head)\b[^>]*>.*?</(?:script|style|head)>|<!--.*?-->', ' ', 'gis'), '</?(?:{main_content.BLOCK_TAGS})\b[^>]*>', chr(10), 'gi'), '<a\b[^>]*>', chr(1), 'gi'), '</a\s*>', chr(2), 'gi'), '<[^>]+>', ' ', 'g') AS t FROM pages),
b AS (SELECT page_id, site, generate_subscripts(l, 1) AS i, unnest(l) AS x FROM (SELECT page_id, site, string_split(t, chr(10)) AS l FROM p)),
c AS (SELECT page_id, site, i, {SQUEEZED} AS text, length({SQUEEZED.replace("(x,", r"(regexp_replace(x, '\x01[^\x01\x02]*\x02', ' ', 'g'),")}) AS outside FROM b),
d AS (SELECT *, len(string_split(text, ' ')) >= 5 AND length(text) - outside <= length(text) / 3 AS dense FROM c WHERE text <> ''),
often AS (SELECT site, text FROM (SELECT site, text, count(DISTINCT page_id) AS n FROM d WHERE dense GROUP BY ALL) JOIN (SELECT site, count(*) AS pages FROM p GROUP BY site) USING (site) WHERE n >= 3 AND n >= 0.1 * pages),
k AS (SELECT *, dense AND NOT EXISTS (SELECT 1 FROM often o WHERE o.site = d.site AND o.text = d.text) AS kept FROM d)
SELECT p.page_id, count(k.page_id) AS n_blocks, count(*) FILTER (kept) AS n_kept, sha256(coalesce(string_agg(text, chr(10) ORDER BY i) FILTER (kept), '')) AS digest FROM p LEFT JOIN k ON k.page_id = p.page_id GROUP BY p.page_id"""
)
def main_blocks(spark, d):
    """Pages' blocks of text, without menus and what their site repeats."""
    return main_content.main_content(table(spark, d, "pages")).select("page_id", "n_blocks", "n_kept", F.sha2("main", 256).alias("digest"))


@query(
    """SELECT label, CAST(dim AS BIGINT) AS dim, round(avg(x), 6) AS mean FROM (SELECT label, vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings WHERE vec_id % 3 <> 0) GROUP BY ALL"""
)
def mean_pool(spark, d):
    """Token vectors of a text, here a label's embeddings, averaged over those that the mask keeps."""
    vectors = table(spark, d, "embeddings").select("label", F.col("embedding").cast("array<double>").alias("v"), (F.col("vec_id") % 3 != 0).cast("int").alias("m"))
    # partial sums by position, as a label may have any number of vectors
    kept = vectors.where("m = 1").select("label", F.posexplode("v").alias("dim", "x"))
    return kept.groupBy("label", "dim").agg(F.round(F.avg("x"), 6).alias("mean"))


@query(
    """SELECT vec_id, k AS dim, round(CASE WHEN n = 0 THEN 0.0 ELSE s / n END, 6) AS mean FROM (SELECT vec_id, k, sum(CASE WHEN embedding[16 * t + 1] > 0 THEN CAST(embedding[16 * t + k + 1] AS DOUBLE) ELSE 0 END) AS s, count(*) FILTER (embedding[16 * t + 1] > 0) AS n
FROM embeddings, (SELECT unnest(range(4)) AS t), (SELECT unnest(range(16)) AS k) GROUP BY ALL)"""
)
def token_pool(spark, d):
    """Each vector as four token vectors of sixteen, averaged over those whose first component is positive."""
    tokens = F.array(*(F.slice(F.col("embedding").cast("array<double>"), 16 * t + 1, 16) for t in range(4)))
    rows = table(spark, d, "embeddings").select("vec_id", tokens.alias("tokens")).withColumn("mask", F.transform("tokens", lambda t: (F.get(t, F.lit(0)) > 0).cast("int")))
    means = rows.select("vec_id", F.posexplode(models.mean_pooled(F.col("tokens"), F.col("mask"))).alias("dim", "mean"))
    return means.select("vec_id", "dim", F.round("mean", 6).alias("mean"))


@query(
    """SELECT vec_id, CASE vec_id % 3 WHEN 0 THEN round(CAST(embedding[2] AS DOUBLE), 6) WHEN 1 THEN round(CAST(embedding[1] AS DOUBLE), 6) ELSE round((CAST(embedding[1] AS DOUBLE) + embedding[2] + embedding[3]) / 3, 6) END AS score FROM embeddings"""
)
def rerank_logits(spark, d):
    width = F.element_at(F.array(F.lit(2), F.lit(1), F.lit(3)), (F.col("vec_id") % 3 + 1).cast("int"))
    logits = F.slice(F.col("embedding").cast("array<double>"), F.lit(1), width)
    return table(spark, d, "embeddings").select("vec_id", F.round(models.logit_score(logits), 6).alias("score"))


@query("SELECT event_id, event_id * 1.0 AS a, 0.5 AS b FROM events WHERE event_id % 5 <> 4")
def extract_vector(spark, d):
    """The vector from services' answers of different shapes."""
    k, n = F.col("event_id") % 5, F.col("event_id").cast("string")
    said = F.when(k == 0, F.format_string("[%s, 0.5]", n)).when(k == 1, F.format_string("[[%s, 0.5], [1, 2]]", n)).when(k == 2, F.format_string('{"data": [[%s, 0.5]]}', n)).when(k == 3, F.format_string('{"n": 1, "out": [%s, 0.5]}', n)).otherwise("{broken")
    rows = table(spark, d, "events").select("event_id", models.extracted_vector(said).alias("v"))
    return rows.where("v IS NOT NULL").select("event_id", F.get("v", F.lit(0)).alias("a"), F.get("v", F.lit(1)).alias("b"))
