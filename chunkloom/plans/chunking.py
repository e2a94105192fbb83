"""Queries that cut documents into chunks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import ids, text
from ..operators import packing, sections, windows
from . import query, table

TOKENS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda t: t <> '')"


@query(
    f"""SELECT CAST(doc_id AS VARCHAR) AS document_id, doc_id || '_' || (k + 1) AS chunk_id, k AS window_index, k * 461 AS token_start, least(k * 461 + 512, n) AS token_end,
least(k * 461 + 512, n) - k * 461 AS token_count, array_to_string(t[k * 461 + 1 : k * 461 + 512], ' ') AS text, sha256(array_to_string(t[k * 461 + 1 : k * 461 + 512], ' ')) AS text_checksum
FROM (SELECT doc_id, t, len(t) AS n, unnest(range(0, CAST(greatest(0, ceil((len(t) - 512) / 461)) AS BIGINT) + 1)) AS k FROM (SELECT doc_id, {TOKENS} AS t FROM documents))"""
)
def token_windows(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("document_id"), text.tokens(F.col("text")).alias("t"))
    out = windows.token_windows(docs, "t", 512, 51, ["document_id"])
    chunk = F.concat_ws("_", "document_id", (F.col("window_index") + 1).cast("string"))
    return out.select("document_id", chunk.alias("chunk_id"), "window_index", "token_start", "token_end", "token_count", "text", ids.checksum(F.col("text")).alias("text_checksum"))


@query(
    r"""WITH p AS (SELECT page_id, list_filter(string_split(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<script[^>]*>.*?</script>', ' ', 'gis'), '<style[^>]*>.*?</style>', ' ', 'gis'), '<[^>]+>', ' ', 'gs'), '\s+', ' ', 'g')), ' '), lambda x: x <> '') AS t FROM pages)
SELECT page_id, k AS window_index, k * 90 AS token_start, least(k * 90 + 100, len(t)) AS token_end, sha256(array_to_string(t[k * 90 + 1 : k * 90 + 100], ' ')) AS digest
FROM (SELECT page_id, t, unnest(range(0, CAST(greatest(0, ceil((len(t) - 100) / 90)) AS BIGINT) + 1)) AS k FROM p)"""
)
def html_windows(spark, d):
    pages = table(spark, d, "pages").select("page_id", text.tokens(text.html_to_text(F.col("html"))).alias("t"))
    return windows.token_windows(pages, "t", 100, 10, ["page_id"]).select("page_id", "window_index", "token_start", "token_end", ids.checksum(F.col("text")).alias("digest"))


@query(
    r"""SELECT doc_id, k AS window_index, sha256(substr(x, k * s + 1, w)) AS digest FROM (
SELECT doc_id, x, w, s, unnest(range(0, CAST(greatest(0, ceil((length(x) - w) / s)) AS BIGINT) + 1)) AS k FROM (
SELECT doc_id, x, greatest(200, e * 200) AS w, greatest(1, greatest(200, e * 200) - e * 20) AS s FROM (
SELECT doc_id, x, greatest(1, length(x) // greatest(1, len(list_filter(regexp_split_to_array(x, '\s+'), lambda t: t <> '')))) AS e FROM (
SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS x FROM documents))))"""
)
def char_windows(spark, d):
    docs = table(spark, d, "documents").select("doc_id", text.canonicalize(F.col("text")).alias("x"))
    return windows.char_windows(docs, "x", 200, 20, ["doc_id"]).select("doc_id", "window_index", ids.checksum(F.col("text")).alias("digest"))


@query(
    """SELECT conv_id, CAST(floor((turn_no - 1) / 7) AS BIGINT) AS group_no, min(turn_no) || '-' || max(turn_no) AS slide_range, count(*) AS n, sha256(string_agg(text, chr(10) ORDER BY turn_no)) AS digest
FROM (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS turn_no FROM conversations) GROUP BY 1, 2"""
)
def slide_groups(spark, d):
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = table(spark, d, "conversations").withColumn("turn_no", F.row_number().over(order))
    grouped = turns.groupBy("conv_id", windows.tumbling(F.col("turn_no"), 7).alias("group_no")).agg(F.min("turn_no").alias("a"), F.max("turn_no").alias("b"), F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("turn_no", "text"))).alias("l"))
    return grouped.select("conv_id", "group_no", F.concat_ws("-", "a", "b").alias("slide_range"), "n", F.sha2(F.array_join(F.transform("l", lambda e: e["text"]), "\n"), 256).alias("digest"))


@query(
    """SELECT doc_id, pos AS line_no, line FROM (SELECT doc_id, pos, line, row_number() OVER (PARTITION BY doc_id, lower(trim(line)) ORDER BY pos) AS r FROM (
SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))) WHERE r = 1"""
)
def dedupe_lines(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    first = F.row_number().over(Window.partitionBy("doc_id", F.lower(F.trim("line"))).orderBy("line_no"))
    return lines.withColumn("r", first).where("r = 1").drop("r")


@query(
    """SELECT user_id, event_id, sum(CASE WHEN gap > 1.5 * median_gap THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS island FROM (
SELECT *, quantile_cont(gap, 0.5) OVER (PARTITION BY user_id) AS median_gap FROM (
SELECT user_id, event_id, s, s - lag(s) OVER (PARTITION BY user_id ORDER BY s, event_id) AS gap FROM (SELECT user_id, event_id, epoch_us(ts) / 1000000 AS s FROM events)))"""
)
def gap_islands(spark, d):
    s = F.unix_micros(F.col("ts").cast("timestamp")) / 1000000
    events = table(spark, d, "events").select("user_id", "event_id", s.alias("s"), s.alias("e"))
    return windows.islands(events, ["user_id"], "s", "e", 1.5, tie="event_id").select("user_id", "event_id", "island")


@query(
    r"""WITH seg AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS o, list_filter(regexp_split_to_array(text, '\s+'), lambda t: t <> '') AS t FROM conversations),
tok AS (SELECT conv_id, o, i, (o - 1) * 10.0 + 10.0 * (i - 1 + 0.5) / n AS s FROM (SELECT conv_id, o, len(t) AS n, unnest(range(1, len(t) + 1)) AS i FROM seg)),
num AS (SELECT conv_id, s, row_number() OVER (PARTITION BY conv_id ORDER BY o, i) - 1 AS p, count(*) OVER (PARTITION BY conv_id) AS n FROM tok),
win AS (SELECT conv_id, n, unnest(range(0, CAST(greatest(0, ceil((n - 50) / 45)) AS BIGINT) + 1)) AS k FROM (SELECT DISTINCT conv_id, n FROM num)),
agg AS (SELECT conv_id, k, count(*) AS c, min_by(s, p) AS a, max_by(s, p) AS b FROM win JOIN num USING (conv_id) WHERE p >= k * 45 AND p < k * 45 + 50 GROUP BY ALL)
SELECT conv_id, k AS window_index, c AS token_count, CAST(round(a * 1000) AS BIGINT) AS start_ms, CAST(round(b * 1000) AS BIGINT) AS end_ms FROM agg"""
)
def segment_time_interp(spark, d):
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = table(spark, d, "conversations").withColumn("o", F.row_number().over(order))
    segs = turns.select("conv_id", "o", "text", ((F.col("o") - 1) * 10.0).alias("a"), (F.col("o") * 10.0).alias("b"))
    out = windows.segment_windows(segs, "conv_id", "o", "text", "a", "b", 50)

    def ms(c):
        h, m, rest = (F.split(c, ":")[k] for k in range(3))
        return (h.cast("long") * 3600 + m.cast("long") * 60) * 1000 + F.replace(rest, F.lit("."), F.lit("")).cast("long")

    return out.select("conv_id", "window_index", "token_count", ms(F.col("range_start")).alias("start_ms"), ms(F.col("range_end")).alias("end_ms"))


ORDER_ROWS = """SELECT o_custkey AS doc, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn, CAST(3 + o_orderkey % 40 AS BIGINT) AS c FROM orders"""


@query(
    f"""WITH RECURSIVE r AS (SELECT *, (rn - 1) // 20 AS batch FROM ({ORDER_ROWS})),
q AS (SELECT doc, batch, c, row_number() OVER (PARTITION BY doc, batch ORDER BY rn) AS i, rn FROM r),
f AS (SELECT doc, batch, i, rn, c, c AS s, CAST(1 AS BIGINT) AS g FROM q WHERE i = 1
UNION ALL SELECT q.doc, q.batch, q.i, q.rn, q.c, CASE WHEN f.s + q.c + 6 <= 90 THEN f.s + q.c ELSE q.c END, CASE WHEN f.s + q.c + 6 <= 90 THEN f.g ELSE f.g + 1 END FROM f JOIN q ON q.doc = f.doc AND q.batch = f.batch AND q.i = f.i + 1)
SELECT doc, batch, g AS group_no, min(rn) AS row_first, max(rn) AS row_last, CAST(sum(c) AS BIGINT) AS tokens FROM f GROUP BY ALL"""
)
def row_groups(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("doc"), "o_orderkey", (F.col("o_orderkey") % 40 + 3).alias("c"))
    rn = F.row_number().over(Window.partitionBy("doc").orderBy("o_orderkey"))
    rows = orders.withColumn("rn", rn).withColumn("batch", F.floor((F.col("rn") - 1) / 20))
    lists = rows.groupBy("doc", "batch").agg(F.array_sort(F.collect_list(F.struct("rn", "c"))).alias("l"))
    grouped = lists.withColumn("g", packing.groups_of_rows(F.transform("l", lambda e: e["c"]), 6, 90))
    flat = grouped.select("doc", "batch", F.explode(F.arrays_zip("l", "g")).alias("z")).select("doc", "batch", F.col("z.l.rn").alias("rn"), F.col("z.l.c").alias("c"), F.col("z.g").alias("group_no"))
    return flat.groupBy("doc", "batch", "group_no").agg(F.min("rn").alias("row_first"), F.max("rn").alias("row_last"), F.sum("c").alias("tokens"))


@query("SELECT c_custkey, least(100, greatest(1, CAST(floor(greatest(1, 1000 - c_custkey % 1200) / greatest(c_nationkey, 1)) AS BIGINT))) AS rows_per_chunk FROM customer")
def rows_per_chunk(spark, d):
    return table(spark, d, "customer").select("c_custkey", packing.rows_per_chunk(F.col("c_custkey") % 1200, F.col("c_nationkey"), 1000).alias("rows_per_chunk"))


def _pack_sql(items: str, budget: int, following: str) -> str:
    """Chunks of (doc, c: list of counts) by a recursion over chunks; p holds 0 and the running sums."""
    return f"""WITH RECURSIVE items AS ({items}),
sums AS (SELECT doc, len(c) AS n, list_transform(range(0, len(c) + 1), lambda i: CAST(coalesce(list_sum(c[1:i]), 0) AS BIGINT)) AS p FROM items WHERE len(c) > 0),
w AS (SELECT doc, n, p, CAST(0 AS BIGINT) AS lo, CAST(0 AS BIGINT) AS k, greatest(CAST(1 AS BIGINT), CAST(len(list_filter(p, lambda s: s <= {budget})) - 1 AS BIGINT)) AS e FROM sums
UNION ALL SELECT doc, n, p, nx, k + 1, greatest(nx + 1, CAST(len(list_filter(p, lambda s: s <= p[nx + 1] + {budget})) - 1 AS BIGINT)) FROM (
SELECT *, CAST(greatest(lo + 1, {following}) AS BIGINT) AS nx FROM w WHERE e < n))
SELECT doc, k AS chunk_no, lo + 1 AS item_first, e AS item_last, p[e + 1] - p[lo + 1] AS tokens FROM w"""


@query(_pack_sql(r"SELECT doc_id AS doc, list_transform(string_split(text, chr(10)), lambda l: len(list_filter(regexp_split_to_array(l, '\s+'), lambda t: t <> ''))) AS c FROM documents", 200, "len(list_filter(p, lambda s: s <= p[e + 1] - 20)) - 1"))
def line_chunks(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), F.transform(F.split("text", "\n"), lambda x: text.token_count(x)).alias("c"))
    chunks = docs.select("doc", F.posexplode(packing.pack(F.col("c"), 200, overlap_tokens=20)).alias("chunk_no", "x"))
    return chunks.select("doc", "chunk_no", F.col("x.first").alias("item_first"), F.col("x.last").alias("item_last"), F.col("x.tokens").alias("tokens"))


@query(
    r"""WITH RECURSIVE l AS (SELECT doc_id AS doc, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc, l, list_transform(l, lambda x: len(list_filter(regexp_split_to_array(x, '\s+'), lambda t: t <> ''))) AS c FROM l),
s AS (SELECT doc, l, c, len(c) AS n, list_transform(range(0, len(c) + 1), lambda i: CAST(coalesce(list_sum(c[1:i]), 0) AS BIGINT)) AS p FROM c),
w AS (SELECT doc, n, c, p, CAST(0 AS BIGINT) AS lo, CASE WHEN c[1] > 20 THEN 1 ELSE greatest(1, len(list_filter(p, lambda x: x <= 20)) - 1) END AS e, c[1] > 20 AS long FROM s
UNION ALL SELECT doc, n, c, p, nx, CASE WHEN c[nx + 1] > 20 THEN nx + 1 ELSE greatest(nx + 1, len(list_filter(p, lambda x: x <= p[nx + 1] + 20)) - 1) END, c[nx + 1] > 20 FROM (
SELECT *, CASE WHEN long THEN e WHEN b > lo THEN b ELSE e END AS nx FROM (SELECT *, len(list_filter(p, lambda x: x <= p[e + 1] - 4)) - 1 AS b FROM w WHERE e < n))),
k AS (SELECT w.doc, w.lo, w.e, w.long, s.l, length(s.l[w.lo + 1]) AS chars, greatest(1, length(s.l[w.lo + 1]) // greatest(w.c[w.lo + 1], 1)) AS each FROM w JOIN s ON s.doc = w.doc),
x AS (SELECT doc, lo, e, 0 AS piece, array_to_string(l[lo + 1 : e], chr(10)) AS t FROM k WHERE NOT long UNION ALL
SELECT doc, lo, e, i + 1, substr(l[lo + 1], CAST(i * step + 1 AS BIGINT), CAST(least(chars, i * step + width) - i * step AS BIGINT)) FROM (SELECT *, unnest(range(0, least(1000, 1 + greatest(0, CAST(ceil((chars - width) / step) AS BIGINT))))) AS i FROM (
SELECT *, greatest(1, width - each * 4) AS step FROM (SELECT *, greatest(50, each * 20) AS width FROM k WHERE long)))),
y AS (SELECT doc, lo, e, piece, trim(regexp_replace(t, '\s+', ' ', 'g')) AS t FROM x)
SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY lo, e, piece) - 1 AS chunk_no, lo AS start_line, e AS end_line, piece, CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END AS token_count, sha256(t) AS digest FROM y"""
)
def long_line_chunks(spark, d):
    """Lines under 20 tokens with an overlap of four, longer lines in windows of characters."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), "text")
    return packing.long_line_chunks(docs, "text", ["doc"], 20, 4, least_chars=50).withColumn("digest", F.sha2("text", 256)).drop("text")


SENTENCES = r"list_filter(string_split(regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '([.!?]) ', '\1' || chr(10), 'g'), chr(10)), lambda x: x <> '')"


@query(
    _pack_sql(
        rf"""SELECT doc_id AS doc, flatten(list_transform({SENTENCES}, lambda s: list_transform(range(0, CAST(ceil(len(string_split(s, ' ')) / 60) AS BIGINT)), lambda k: least(60, len(string_split(s, ' ')) - k * 60)))) AS c FROM documents""",
        120,
        "e - 2",
    )
)
def sentence_chunks(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), text.sentences(F.col("text")).alias("s"))
    words = F.transform("s", lambda s: F.size(F.split(s, " ")))
    chunks = docs.select("doc", F.posexplode(packing.pack(words, 120, overlap_items=2, piece=60)).alias("chunk_no", "x"))
    return chunks.select("doc", "chunk_no", F.col("x.first").alias("item_first"), F.col("x.last").alias("item_last"), F.col("x.tokens").alias("tokens"))


@query(
    rf"""WITH RECURSIVE st AS (SELECT doc_id AS doc, trim(regexp_replace(text, '\s+', ' ', 'g')) AS x, {SENTENCES} AS s FROM documents),
se AS (SELECT doc, unnest(s) AS t, generate_subscripts(s, 1) - 1 AS i FROM st),
sa AS (SELECT doc, i, string_split(t, ' ') AS w, coalesce(sum(length(t) + 1) OVER (PARTITION BY doc ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM se),
pk AS (SELECT doc, i, w, a, unnest(range(0, len(w), 45)) AS k FROM sa),
pc AS (SELECT doc, i, least(45, len(w) - k) AS c, k + 45 < len(w) AS more, a + CASE WHEN k = 0 THEN 0 ELSE length(array_to_string(w[1:k], ' ')) + 1 END AS a, a + length(array_to_string(w[1:k + 45], ' ')) AS b, row_number() OVER (PARTITION BY doc ORDER BY i, k) AS item FROM pk),
ch AS ({_pack_sql("SELECT doc, list(c ORDER BY item) AS c FROM pc GROUP BY doc", 45, "e - 2")}),
cu AS (SELECT ch.doc, ch.chunk_no, ch.tokens, count(*) FILTER (pc.more) > 0 AS cut, min(i) AS first, max(i) + 1 AS ending, min(a) AS a, max(b) AS b FROM ch JOIN pc ON pc.doc = ch.doc AND item BETWEEN item_first AND item_last GROUP BY ALL),
g AS (SELECT *, sum(CASE WHEN chunk_no = 0 OR tokens >= 12 THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY chunk_no) - 1 AS n FROM cu)
SELECT g.doc, CAST(n AS BIGINT) AS chunk_no, min(first) AS sentence_first, max(ending) AS sentence_end, CAST(min(a) AS BIGINT) AS start_char, CAST(max(b) AS BIGINT) AS end_char, CAST(sum(tokens) AS BIGINT) AS token_count, bool_or(cut) AS truncated,
sha256(string_agg(x[CAST(a + 1 AS BIGINT) : CAST(b AS BIGINT)], ' ' ORDER BY g.chunk_no)) AS digest FROM g JOIN st ON g.doc = st.doc GROUP BY g.doc, n"""
)
def sentence_spans(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), text.squeezed(F.col("text")).alias("text"))
    return packing.sentence_chunks(docs, "text", ["doc"], 45, 2, 12).withColumn("digest", F.sha2("text", 256)).drop("text")


@query(
    r"""WITH RECURSIVE l AS (SELECT doc_id AS doc, list_transform(string_split(text, chr(10)), lambda l: CAST(len(list_filter(regexp_split_to_array(l, '\s+'), lambda t: t <> '')) AS BIGINT)) AS c FROM documents),
f AS (SELECT doc, c, CAST(1 AS BIGINT) AS i, c[1] AS s, CAST(1 AS BIGINT) AS g FROM l
UNION ALL SELECT doc, c, i + 1, CASE WHEN s < 40 AND s + c[i + 1] <= 150 THEN s + c[i + 1] ELSE c[i + 1] END, CASE WHEN s < 40 AND s + c[i + 1] <= 150 THEN g ELSE g + 1 END FROM f WHERE i < len(c))
SELECT doc, g AS group_no, min(i) AS first, max(i) AS last, CAST(sum(c[i]) AS BIGINT) AS tokens FROM f GROUP BY doc, g"""
)
def merge_sections(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), F.transform(F.split("text", "\n"), lambda x: text.token_count(x)).alias("c"))
    grouped = docs.withColumn("g", packing.merged_sections(F.col("c"), 40, 150))
    flat = grouped.select("doc", F.posexplode(F.arrays_zip("c", "g")).alias("i", "z"))
    return flat.groupBy("doc", F.col("z.g").alias("group_no")).agg((F.min("i") + 1).alias("first"), (F.max("i") + 1).alias("last"), F.sum("z.c").alias("tokens"))


@query(
    _pack_sql(
        rf"""SELECT doc_id AS doc, list_transform({SENTENCES}, lambda s: least(60, len(string_split(s, ' ')))) AS c FROM documents""",
        60,
        "e - 1",
    )
)
def sentence_overlaps(spark, d):
    """Long sentences cut to the budget, one sentence of overlap."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), F.transform(text.sentences(F.col("text")), lambda s: F.least(F.lit(60), F.size(F.split(s, " ")))).alias("c"))
    chunks = docs.select("doc", F.posexplode(packing.pack(F.col("c"), 60, overlap_items=1)).alias("chunk_no", "x"))
    return chunks.select("doc", "chunk_no", F.col("x.first").alias("item_first"), F.col("x.last").alias("item_last"), F.col("x.tokens").alias("tokens"))


LINE_COUNTS = r"""SELECT doc_id AS doc, generate_subscripts(l, 1) AS i, unnest(l) AS c FROM (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda l: CAST(len(list_filter(regexp_split_to_array(l, '\s+'), lambda t: t <> '')) AS BIGINT)) AS l FROM documents)"""


@query(
    f"""WITH RECURSIVE q AS ({LINE_COUNTS}),
f AS (SELECT doc, i, c, c AS s, CAST(1 AS BIGINT) AS g FROM q WHERE i = 1
UNION ALL SELECT q.doc, q.i, q.c, CASE WHEN q.c <= 80 AND f.c <= 80 AND f.s + q.c + 7 <= 80 THEN f.s + q.c ELSE q.c END, CASE WHEN q.c <= 80 AND f.c <= 80 AND f.s + q.c + 7 <= 80 THEN f.g ELSE f.g + 1 END FROM f JOIN q ON q.doc = f.doc AND q.i = f.i + 1)
SELECT doc, min(i) AS row_first, max(i) AS row_last, CAST(NULL AS BIGINT) AS token_start, CAST(NULL AS BIGINT) AS token_end, true AS with_header, CAST(sum(c) + 7 AS BIGINT) AS tokens FROM f WHERE c <= 80 GROUP BY doc, g
UNION ALL SELECT doc, i, i, a, least(c, a + 80), least(c, a + 80) - a + 7 <= 80, CAST(least(c, a + 80) - a + CASE WHEN least(c, a + 80) - a + 7 <= 80 THEN 7 ELSE 0 END AS BIGINT)
FROM (SELECT doc, i, c, 72 * unnest(range(0, CAST(ceil((c - 80) / 72) AS BIGINT) + 1)) AS a FROM q WHERE c > 80)"""
)
def oversize_rows(spark, d):
    """Rows packed under a header of 7 tokens, rows over the budget cut into windows."""
    docs = table(spark, d, "documents").where("text IS NOT NULL").select(F.col("doc_id").alias("doc"), F.transform(F.split("text", "\n"), lambda x: text.token_count(x)).alias("c"))
    chunks = docs.select("doc", F.explode(packing.row_chunks(F.col("c"), F.lit(7), 80)).alias("x"))
    return chunks.select("doc", F.col("x.first").alias("row_first"), F.col("x.last").alias("row_last"), "x.token_start", "x.token_end", "x.with_header", "x.tokens")


MD_LINES = """SELECT doc, line_no, line, CASE WHEN line_no % 7 = 1 THEN CAST(1 + (doc + line_no) % 3 AS BIGINT) ELSE 0 END AS level FROM (SELECT doc_id AS doc, unnest(l) AS line, generate_subscripts(l, 1) AS line_no FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"""


@query(
    f"""WITH h AS (SELECT *, sum(CASE WHEN level > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS section FROM ({MD_LINES})),
s AS (SELECT doc, CAST(section AS BIGINT) AS section, max(level) AS level, min(line_no) AS start_line, max(line_no) AS end_line, min_by('H' || line_no, line_no) AS heading FROM h GROUP BY doc, section),
p AS (SELECT a.doc, a.section, string_agg(b.heading, ' > ' ORDER BY b.level) AS heading_path FROM s a JOIN s b ON a.doc = b.doc AND b.start_line <= a.start_line AND b.level > 0 AND (b.section = a.section OR b.level < a.level)
WHERE NOT EXISTS (SELECT 1 FROM s c WHERE c.doc = a.doc AND c.level > 0 AND c.start_line > b.start_line AND c.start_line <= a.start_line AND c.level <= b.level) GROUP BY a.doc, a.section)
SELECT s.doc, s.section, s.level, s.start_line, s.end_line, coalesce(p.heading_path, '') AS heading_path FROM s LEFT JOIN p USING (doc, section)"""
)
def heading_paths(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")).withColumn("line_no", F.col("line_no") + 1)
    level = F.when(F.col("line_no") % 7 == 1, 1 + (F.col("doc") + F.col("line_no")) % 3).otherwise(0)
    marked = docs.withColumn("level", level.cast("int")).withColumn("heading", F.when(F.col("level") > 0, F.concat(F.lit("H"), "line_no")))
    return sections.sections(marked).select("doc", "section", "level", "start_line", "end_line", "heading_path")


@query(
    r"""WITH l AS (SELECT doc_id AS doc, unnest(x) AS line, generate_subscripts(x, 1) AS line_no FROM (SELECT doc_id, string_split(regexp_replace(text, '(^|\n)(\w+)\.(\n|$)', '\1## \2.\3', 'g'), chr(10)) AS x FROM documents)),
h AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^#{1,6}\s+\S') THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS section FROM l)
SELECT doc, CAST(section AS BIGINT) AS section, min(line_no) AS start_line, max(line_no) AS end_line, sha256(string_agg(line, chr(10) ORDER BY line_no)) AS digest FROM h GROUP BY doc, section"""
)
def md_sections(spark, d):
    docs = table(spark, d, "documents").withColumn("text", F.regexp_replace("text", r"(^|\n)([A-Za-z0-9_]+)\.(\n|$)", "$1## $2.$3"))
    return sections.sections(sections.markdown_lines(docs, "doc_id", "text")).select("doc", "section", "start_line", "end_line", F.sha2("text", 256).alias("digest"))


@query(
    """SELECT o_custkey AS doc, gs AS gap_start, ge AS gap_end FROM (SELECT o_custkey, coalesce(max(e) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS gs, s - 1 AS ge
FROM (SELECT o_custkey, o_orderkey AS s, o_orderkey + o_orderkey % 900 AS e FROM orders)) WHERE gs <= ge"""
)
def section_gaps(spark, d):
    spans = table(spark, d, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("s"), (F.col("o_orderkey") + F.col("o_orderkey") % 900).alias("e"))
    return sections.gaps(spans, "doc", "s", "e")
