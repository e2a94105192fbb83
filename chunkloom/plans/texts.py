"""Queries on text expressions and identifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ids, text
from . import query, table

CANON = r"trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))"
LINES = r"regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), '[ \t]+(\n|$)', '\1', 'g'), '^\s+|\s+$', '', 'g')"


@query(f"SELECT doc_id, {CANON} AS text FROM documents")
def canonicalize(spark, d):
    return table(spark, d, "documents").select("doc_id", text.canonicalize(F.col("text")).alias("text"))


@query(f"SELECT doc_id, sha256({LINES}) AS digest, length({LINES}) AS n_chars FROM documents")
def line_canonicalize(spark, d):
    lines = text.line_canonicalize(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.sha2(lines, 256).alias("digest"), F.length(lines).alias("n_chars"))


@query(r"SELECT item_id, trim(regexp_replace(regexp_replace(regexp_replace(text || ' (cid:12)' || chr(9) || 'x', '\(cid:\d+\)', '', 'g'), '[\x00-\x1F\x7F]', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM benchmark")
def reflow(spark, d):
    marked = F.concat("text", F.lit(" (cid:12)\tx"))
    return table(spark, d, "benchmark").select("item_id", text.reflow(marked).alias("text"))


@query(r"SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda t: t <> '')) AS token_count FROM documents")
def token_count(spark, d):
    return table(spark, d, "documents").select("doc_id", text.token_count(F.col("text")).alias("token_count"))


@query("SELECT doc_id, sha256(coalesce(text, '')) AS sha256, md5(text) AS md5, sha1(text) AS sha1 FROM documents")
def text_checksum(spark, d):
    digests = ids.content_digests(F.col("text").cast("binary"))
    return table(spark, d, "documents").select("doc_id", ids.checksum(F.col("text")).alias("sha256"), digests["md5"].alias("md5"), digests["sha1"].alias("sha1"))


@query("SELECT doc_id, CAST(CAST('0x' || substr(sha256(doc_id || ':' || source), 1, 16) AS UBIGINT) AS VARCHAR) AS vector_id FROM documents")
def vector_id(spark, d):
    return table(spark, d, "documents").select("doc_id", ids.vector_id(F.col("doc_id").cast("string"), F.col("source")).cast("string").alias("vector_id"))


@query(
    """SELECT doc_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST((instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1 AS BIGINT), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uuid
FROM (SELECT doc_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || CAST(doc_id || ':' || source AS BLOB)) AS h FROM documents)"""
)
def chunk_uuid(spark, d):
    return table(spark, d, "documents").select("doc_id", ids.uuid5(F.col("doc_id").cast("string"), F.col("source")).alias("uuid"))


@query(
    """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN source WHEN doc_id % 5 = 1 THEN sha256(source || lang) WHEN doc_id % 5 = 2 THEN sha256(source || CAST(n_chars AS VARCHAR)) WHEN doc_id % 5 = 3 THEN source ELSE sha256(source || '/') END AS document_id FROM documents"""
)
def document_ids(spark, d):
    case = F.col("doc_id") % 5
    key = F.when(case == 3, F.concat(F.lit("raw/"), "source")).when(case == 4, F.concat("source", F.lit("/"))).otherwise(F.col("source"))
    got = ids.document_id(F.when(case == 0, F.col("source")), key, F.when(case == 1, F.col("lang")), F.when(case == 2, F.col("n_chars").cast("string")))
    return table(spark, d, "documents").select("doc_id", got.alias("document_id"))


@query(
    r"""SELECT page_id, name AS file_name, lower(regexp_extract(name, '\.([A-Za-z0-9]+)$', 1)) AS ext
FROM (SELECT page_id, list_extract(string_split(regexp_replace(url, '[?#].*$', ''), '/'), -1) AS name FROM pages)"""
)
def url_parts(spark, d):
    name = text.file_name(F.col("url"))
    return table(spark, d, "pages").select("page_id", name.alias("file_name"), text.extension(name).alias("ext"))


@query("SELECT c_custkey, 'c_custkey: ' || c_custkey || ' | c_name: ' || coalesce(c_name, '') || ' | c_nationkey: ' || coalesce(CAST(c_nationkey AS VARCHAR), '') || ' | c_mktsegment: ' || coalesce(c_mktsegment, '') AS text FROM customer")
def row_to_text(spark, d):
    return table(spark, d, "customer").select("c_custkey", text.row_to_text(["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]).alias("text"))


@query(
    r"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<script[^>]*>.*?</script>', ' ', 'gis'), '<style[^>]*>.*?</style>', ' ', 'gis'), '<[^>]+>', ' ', 'gs'), '\s+', ' ', 'g')) AS text FROM pages"""
)
def html_to_text(spark, d):
    return table(spark, d, "pages").select("page_id", text.html_to_text(F.col("html")).alias("text"))


@query(r"SELECT page_id, trim(regexp_replace(regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'is'), '\s+', ' ', 'g')) AS title FROM pages")
def html_title(spark, d):
    return table(spark, d, "pages").select("page_id", text.html_title(F.col("html")).alias("title"))


@query(
    r"""SELECT item_id, ord - 1 AS sentence_no, s AS sentence FROM (
SELECT item_id, unnest(l) AS s, generate_subscripts(l, 1) AS ord FROM (
SELECT item_id, list_filter(string_split(regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '([.!?]) ', '\1' || chr(10), 'g'), chr(10)), lambda x: x <> '') AS l FROM benchmark))"""
)
def sentence_split(spark, d):
    return table(spark, d, "benchmark").select("item_id", F.posexplode(text.sentences(F.col("text"))).alias("sentence_no", "sentence"))


@query(
    """SELECT event_id, format('{:02d}:{:02d}:{:02d}.{:03d}', ms // 3600000, (ms // 60000) % 60, (ms // 1000) % 60, ms % 1000) AS clock
FROM (SELECT event_id, CAST(round(greatest(event_id * 1.25 - 10, 0.0) * 1000) AS BIGINT) AS ms FROM events)"""
)
def format_clock(spark, d):
    return table(spark, d, "events").select("event_id", text.clock(F.col("event_id") * F.lit(1.25) - 10).alias("clock"))


@query(
    r"""SELECT part_id AS p_partkey, length(p) >= 5 AND length(regexp_replace(p, '[^\p{L}\p{N}]', '', 'g')) / greatest(length(p), 1) >= 0.6 AS valid, length(p) > 20 AND regexp_matches(p, '\p{L}') AS is_text
FROM (SELECT p_partkey AS part_id, CASE WHEN p_partkey % 3 = 0 THEN '--#' || p_name WHEN p_partkey % 3 = 1 THEN '-=-=-=-=-' || p_brand ELSE 'ab' END AS p FROM part)"""
)
def ocr_line_filter(spark, d):
    k = F.col("p_partkey") % 3
    line = F.when(k == 0, F.concat(F.lit("--#"), "p_name")).when(k == 1, F.concat(F.lit("-=-=-=-=-"), "p_brand")).otherwise("ab")
    return table(spark, d, "part").select("p_partkey", text.ocr_line_valid(line).alias("valid"), text.text_valid(line).alias("is_text"))


@query(
    """SELECT CAST(r_regionkey AS BIGINT) AS r_regionkey, '| name | key |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || n_name || ' | ' || n_nationkey || ' |', chr(10) ORDER BY n_nationkey) AS markdown,
'name' || chr(9) || 'key' || chr(10) || string_agg(n_name || chr(9) || n_nationkey, chr(10) ORDER BY n_nationkey) AS tsv, TRUE AS valid FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey"""
)
def table_text(spark, d):
    nation = table(spark, d, "nation").groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("l"))
    rows = F.concat(F.array(F.array(F.lit("name"), F.lit("key"))), F.transform("l", lambda e: F.array(e["n_name"], e["n_nationkey"].cast("string"))))
    return nation.select("r_regionkey", text.table_markdown(rows).alias("markdown"), text.table_tsv(rows).alias("tsv"), text.table_valid(rows).alias("valid"))


@query(r"SELECT doc_id, sha256(regexp_replace(replace(text, '. ', '-' || chr(10)), '-\n\s*', '', 'g')) AS digest FROM documents")
def fix_hyphens(spark, d):
    broken = F.replace(F.col("text"), F.lit(". "), F.lit("-\n"))
    return table(spark, d, "documents").select("doc_id", F.sha2(text.fix_hyphens(broken), 256).alias("digest"))
