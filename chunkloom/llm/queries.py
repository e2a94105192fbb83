"""The subpackage's registered queries: each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

from . import ball_tree, decontamination, embedding_dedup, huffman_ids, jaccard_join, language_id, line_dedup, secrets, sentencepiece_codec, surrogates, toxicity, turn_repair, wordpiece_counts
from .common import table


#: A key for the registered query; users pass their own.
PSEUDONYM_KEY = "example key"


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


def op2_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_groups(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark, sf_dir):
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark, sf_dir):
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark, sf_dir):
    return sentencepiece_codec.encode_decode(table(spark, sf_dir, "documents"), tokenizer_file())


def op6_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_token_counts(spark, sf_dir):
    return wordpiece_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file())


def op8_decontamination(spark, sf_dir):
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_surrogates(spark, sf_dir):
    return surrogates.pseudonymize(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op13_ball_tree(spark, sf_dir):
    return ball_tree.cluster(table(spark, sf_dir, "embeddings"))


#: Squared distances to 40 centroids in five rounds and a last one.
BALL_TREE_SQL = """WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), q) - 1 AS c, q AS m FROM v QUALIFY c < 40)""" + "".join(
    f""", d{k} AS MATERIALIZED (SELECT vec_id, q, min({{'d': list_sum(list_transform(list_zip(q, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'c': c}}) AS a FROM v, c{k} GROUP BY vec_id, q)"""
    + (
        ""
        if k == 5
        else f""", s{k} AS (SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT a.c AS c, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM d{k}) GROUP BY c, i),
c{k + 1} AS MATERIALIZED (SELECT c, coalesce(f, m) AS m FROM c{k} LEFT JOIN (SELECT c, list((s - (s % n + n) % n) // n ORDER BY i) AS f FROM s{k} GROUP BY c) USING (c))"""
    )
    for k in range(6)
) + """ SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
sha256(array_to_string(m, ',')) AS centroid_sha256 FROM d5 JOIN c5 ON a.c = c5.c"""


def op11_huffman_ids(spark, sf_dir):
    return huffman_ids.write_and_read(table(spark, sf_dir, "documents"), byte_tokenizer_file())


def op12_turn_repair(spark, sf_dir):
    return turn_repair.repair(table(spark, sf_dir, "conversations"))


#: The CRC is worked out bit by bit; the repair relaxes every edit turn by turn, with one best row for each state.
TURN_REPAIR_SQL = r"""WITH RECURSIVE crc AS MATERIALIZED (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
lambda ch: list_prepend(CAST(ord(ch) AS BIGINT), list_transform(range(8), lambda k: CAST(-1 AS BIGINT)))))), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) % 20 AS fate FROM conversations),
dam AS MATERIALIZED (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS k FROM crc),
num AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, k) AS i, substr(role, 1, 1) AS r, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS l FROM dam),
tr AS MATERIALIZED (SELECT conv_id, i, turn, role, r, text, CASE WHEN l = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2 WHEN l NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault, lag(r) OVER (PARTITION BY conv_id ORDER BY i) AS b FROM num),
per AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
count(*) FILTER (b IS NOT NULL AND b || r NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM tr GROUP BY conv_id),
way(f, t, ins, said) AS (VALUES ('', 's', 0, ''), ('', 'u', 0, ''), ('', 'a', 1, 'user:' || chr(10)), ('s', 'u', 0, ''), ('s', 'a', 1, 'user:' || chr(10)), ('u', 'a', 0, ''), ('u', 'u', 1, 'assistant:' || chr(10)), ('a', 'u', 0, ''), ('a', 'a', 1, 'user:' || chr(10))),
st(conv_id, i, state, best) AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT), '', {'cost': CAST(0 AS BIGINT), 'audit': '', 'body': ''} FROM tr
UNION ALL SELECT conv_id, i, state, min({'cost': cost, 'audit': audit, 'body': body}) FROM (
SELECT st.conv_id, tr.i, st.state, st.best.cost + 2 AS cost, st.best.audit || 'D' AS audit, st.best.body AS body FROM st JOIN tr ON st.conv_id IS NOT DISTINCT FROM tr.conv_id AND tr.i = st.i + 1
UNION ALL SELECT st.conv_id, tr.i, t, st.best.cost + CASE WHEN r = t THEN 0 ELSE 1 END + 5 * ins + CASE WHEN fault = 3 THEN 5 ELSE 0 END, st.best.audit || repeat('I', ins) || CASE WHEN r = t THEN 'K' ELSE 'R' END,
st.best.body || said || CASE WHEN r = t THEN role WHEN t = 'u' THEN 'user' ELSE 'assistant' END || ':' || text || chr(10)
FROM st JOIN tr ON st.conv_id IS NOT DISTINCT FROM tr.conv_id AND tr.i = st.i + 1 JOIN way ON f = state AND (t <> 's' OR r = 's') WHERE fault IN (0, 3)) GROUP BY conv_id, i, state),
fin AS (SELECT st.conv_id, min({'cost': best.cost + CASE state WHEN 'u' THEN 5 WHEN 's' THEN 10 ELSE 0 END, 'audit': best.audit || CASE state WHEN 'u' THEN 'I' WHEN 's' THEN 'II' ELSE '' END,
'body': best.body || CASE state WHEN 'u' THEN 'assistant:' || chr(10) WHEN 's' THEN 'user:' || chr(10) || 'assistant:' || chr(10) ELSE '' END}) AS e FROM st JOIN per ON st.conv_id IS NOT DISTINCT FROM per.conv_id AND st.i = per.n GROUP BY st.conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.cost, 0) AS cost, coalesce(e.audit, '') AS audit,
sha256(coalesce(e.body[:-2], '')) AS repaired_sha256 FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN per ON c.conv_id IS NOT DISTINCT FROM per.conv_id LEFT JOIN fin ON c.conv_id IS NOT DISTINCT FROM fin.conv_id"""


def queries():
    return {f.__name__: f for f in (op1_language_id, op2_jaccard_join, op3_line_dedup, op4_secret_scan, op5_sentencepiece, op6_toxicity, op7_token_counts, op8_decontamination, op9_embedding_dedup, op10_surrogates, op11_huffman_ids, op12_turn_repair, op13_ball_tree)}


def oracle_sql() -> dict[str, str]:
    return {"op12_turn_repair": TURN_REPAIR_SQL, "op13_ball_tree": BALL_TREE_SQL}
