"""SQL for DuckDB that gives the rows of the queries, where SQL can express them."""

OP10 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(role) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""

_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Sets of five-word runs, links of likeness 0.8, and groups of linked documents.
JACCARD = f"""
words AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
runs AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') AS g
  FROM words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id),
sets AS (SELECT doc_id, md5(string_agg(g, '|' ORDER BY g)) AS s FROM runs GROUP BY doc_id),
classes AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS class_id FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM runs a JOIN runs b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 5 * shared.n >= 4 * (x.n + y.n - shared.n)),
reached(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
groups AS (SELECT a AS doc_id, min(b) AS group_id FROM reached GROUP BY a)
"""

OP2 = f"""
WITH RECURSIVE {JACCARD}
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, group_id,
  (SELECT count(*) FROM links WHERE a = doc_id) AS n_links
FROM documents LEFT JOIN classes USING (doc_id) JOIN groups USING (doc_id)
"""

#: The given pages hold their main text in one article of h1, p, b and br.
OP4 = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1) AS t FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(t, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS t FROM a),
c AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(t, '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&amp;?', '&', 'g') AS t FROM b),
d AS (SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM c)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM d
"""

OP5 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS g
  FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) t(i) WHERE len(w) > 0
),
lengths AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM d, lengths, unnest(range(1, len(w) - n + 2)) t(i)
),
met AS (SELECT dw.r, dw.n, dw.i, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM met, unnest(range(i, i + n)) t(p) GROUP BY r),
items AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
    array_to_string(list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))), ',') AS ids
  FROM met GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

OP8 = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, url, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, url, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""



def _assigned(n: int) -> str:
    """Every vector's cluster among the centroids ``c{n}`` and its distance."""
    return f"""
f{n} AS (SELECT r, c, sum((x - m) * (x - m)) AS far FROM v JOIN c{n} USING (d) GROUP BY r, c),
a{n} AS (SELECT r, c, far FROM f{n} QUALIFY row_number() OVER (PARTITION BY r ORDER BY far, c) = 1)"""


def _moved(n: int) -> str:
    """The centroids after round ``n``; what has no vector stays."""
    return f"""
s{n} AS (SELECT c, d, sum(x) AS s, count(*) AS k FROM a{n} JOIN v USING (r) GROUP BY c, d),
c{n + 1} AS (
  SELECT c, d, CAST(CASE WHEN k IS NULL THEN m ELSE (s - ((s % k) + k) % k) // k END AS HUGEINT) AS m
  FROM c{n} LEFT JOIN s{n} USING (c, d)
)"""


#: Five rounds of centroids over the integer entries, a row per vector and dimension.
OP11 = f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64
),
v AS (SELECT r, d, CAST(floor(256 * CAST(embedding[d] AS DOUBLE)) AS HUGEINT) AS x FROM kept, unnest(range(1, 65)) t(d)),
first AS (
  SELECT r, row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)) NULLS LAST, embedding) - 1 AS c
  FROM kept QUALIFY c < 40
),
c0 AS (SELECT c, d, x AS m FROM first JOIN v USING (r)),
{",".join(_assigned(n) + "," + _moved(n) for n in range(5))},
{_assigned(5)},
ends AS (SELECT c, sha256(string_agg(CAST(m AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c5 GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(far AS BIGINT) AS distance,
  CAST(sum(far) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(far) OVER () AS BIGINT) AS inertia,
  centroid_sha256
FROM a5 JOIN kept USING (r) JOIN ends USING (c)
"""

ORACLE_SQL = {
    "op2_jaccard_join": OP2,
    "op4_main_text": OP4,
    "op5_decontaminate": OP5,
    "op8_warc": OP8,
    "op10_chat_format": OP10,
    "op11_centroids": OP11,
}
