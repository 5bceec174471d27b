"""DuckDB formulations of the training-data queries that SQL can express."""

from __future__ import annotations

from tillroll.llm.bisectors import CLUSTERS, DIMENSION, LIMIT, ROUNDS, SCALE
from tillroll.llm.decontamination import WINDOW
from tillroll.llm.lexical import TOP
from tillroll.llm.mixing import BLOCK_DOCS, PERIOD_SLOTS
from tillroll.llm.near_dups import LINK_PCT, SHINGLE
from tillroll.llm.quality_rules import (BOILERPLATE, CLOSING, MAX_BOILERPLATE_WORDS, MAX_LOST_PCT, MAX_REPEAT_PCT,
                                        MIN_OPEN_LINE_WORDS, MIN_WORDS, SEPARATORS, SYMBOLS)
from tillroll.llm.warc import MIN_REVISIT_BYTES

WORD = r"'[^\x20\x09-\x0D]+'"
BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _texts(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _count(of: str, text: str = "body") -> str:
    return f"length(regexp_replace({text}, '[^{of}]+', '', 'g'))"


QUALITY_RULES = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {WORD}) AS words FROM documents),
pieces AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS piece
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
found_again AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, piece) AS n FROM pieces) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM found_again) GROUP BY doc_id),
line AS (
  SELECT doc_id, line, trim(line, {BLANKS}) AS body FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)),
fact AS (
  SELECT doc_id, line, body, len(regexp_extract_all(body, {WORD})) AS n,
    length(list_aggregate(regexp_extract_all(body, {WORD}), 'string_agg', '')) AS chars,
    {_count("!")} AS shouted, {_count(SYMBOLS)} AS symbols, {_count(SEPARATORS)} AS separators,
    list_contains([{_texts(CLOSING)}], right(body, 1)) AS closed,
    len(list_filter([{_texts(BOILERPLATE)}], lambda p: contains(lower(body), p))) > 0 AS phrase
  FROM line WHERE body <> ''),
judged AS (
  SELECT *, (NOT closed AND n < {MIN_OPEN_LINE_WORDS}) OR (shouted > 3 AND shouted >= n) OR (symbols > 0 AND 2 * symbols >= n)
    OR (separators > 0 AND 5 * separators >= n) OR (phrase AND n <= {MAX_BOILERPLATE_WORDS}) AS fails
  FROM fact),
per_doc AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (fails) AS n_removed_lines,
    coalesce(sum(chars) FILTER (fails), 0) AS lost_chars
  FROM judged GROUP BY doc_id),
joined AS (
  SELECT d.doc_id, len(words) AS n_words, coalesce(length(list_aggregate(words, 'string_agg', '')), 0) AS word_chars,
    {_count(SYMBOLS, "text")} AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_removed_lines, 0) AS n_removed_lines, coalesce(lost_chars, 0) AS lost_chars
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN per_doc USING (doc_id)),
base AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM joined)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND 100 * lost_chars <= {MAX_LOST_PCT} * word_chars AS kept, CAST(n_lines AS BIGINT) AS n_lines,
  CAST(n_removed_lines AS BIGINT) AS n_removed_lines, CAST(lost_chars AS BIGINT) AS lost_chars
FROM base"""

SOURCE_MIX = f"""
WITH RECURSIVE sized AS (SELECT source, count(*) AS docs, CAST(floor(sqrt(count(*))) AS BIGINT) AS w FROM documents GROUP BY source),
whole AS (SELECT *, greatest({PERIOD_SLOTS}, 2 * count(*) OVER ()) AS slots, count(*) OVER () AS s, CAST(sum(w) OVER () AS BIGINT) AS ws FROM sized),
floors AS (SELECT source, slots, 1 + (w * (slots - s)) // ws AS f, (w * (slots - s)) % ws AS rest FROM whole),
share AS (
  SELECT source, slots, f + CASE WHEN row_number() OVER (ORDER BY rest DESC, source) <= slots - sum(f) OVER () THEN 1 ELSE 0 END AS q FROM floors),
numbered AS (SELECT source, slots, q, row_number() OVER (ORDER BY source) AS k FROM share),
lists AS (SELECT max(slots) AS slots, list(CAST(q AS BIGINT) ORDER BY k) AS qs FROM numbered),
turn(t, used, pick) AS (
  SELECT CAST(-1 AS BIGINT), list_transform(qs, lambda q: CAST(0 AS BIGINT)), CAST(NULL AS BIGINT) FROM lists
  UNION ALL
  SELECT t + 1, list_transform(used, lambda u, i: u + CASE WHEN i = pick2 THEN 1 ELSE 0 END), pick2
  FROM (SELECT t, used, slots, list_min(list_filter(list_transform(used, lambda u, i:
            CASE WHEN u < qs[i] AND u * slots // qs[i] <= t + 1 THEN (((u + 1) * slots + qs[i] - 1) // qs[i]) * 100000 + i END),
            lambda x: x IS NOT NULL)) % 100000 AS pick2
        FROM turn, lists WHERE t + 1 < slots)),
schedule AS (SELECT pick AS k, row_number() OVER (PARTITION BY pick ORDER BY t) AS j, t AS slot FROM turn WHERE pick IS NOT NULL),
ranked AS (
  SELECT doc_id, d.source, k, q, slots, row_number() OVER (PARTITION BY d.source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS rank
  FROM documents d JOIN numbered n ON n.source IS NOT DISTINCT FROM d.source),
blocks AS (SELECT *, rank // {BLOCK_DOCS} AS b FROM ranked)
SELECT doc_id, source, CAST(q AS BIGINT) AS source_share, CAST(slots AS BIGINT) AS period_slots, CAST(rank AS BIGINT) AS source_rank,
  CAST(b + 1 AS BIGINT) AS block, CAST((b // q) * slots + slot AS BIGINT) AS slot, CAST(rank % {BLOCK_DOCS} AS INTEGER) AS in_block
FROM blocks JOIN schedule ON schedule.k = blocks.k AND schedule.j = b % q + 1"""

NEAR_DUPS = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORD}) AS w
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - {SHINGLE - 2}))) AS i FROM d WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingle x JOIN shingle y USING (s) WHERE x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM shared JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * k >= {LINK_PCT} * (p.n + q.n - k)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(node, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT node, b FROM reach JOIN both_ways ON a = other),
root AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN root ON node = d.doc_id LEFT JOIN size ON size.doc_id = d.doc_id"""

WARC = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
l AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND page_id < last THEN last END AS refers_to
FROM l"""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TERMS = "regexp_extract_all(" + LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LEXICAL_SEARCH = f"""
WITH dt AS (SELECT row_number() OVER () AS r, doc_id, {TERMS.format("coalesce(text, '')")} AS w FROM documents),
bt AS (SELECT row_number() OVER () AS item, item_id, {TERMS.format("coalesce(text, '')")} AS w FROM benchmark),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM dt WHERE len(w) > 0),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM dt) GROUP BY r, t),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
weight AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM df, corpus),
wanted AS (SELECT item, t, count(*) AS q FROM (SELECT item, unnest(w) AS t FROM bt) GROUP BY item, t),
damp AS (SELECT r, doc_id, 75 + (25 * len(w) * n_docs) // n_terms AS m FROM dt, corpus WHERE len(w) > 0),
scored AS (
  SELECT item, r, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM wanted JOIN tf USING (t) JOIN weight USING (t) JOIN damp USING (r) GROUP BY item, r),
placed AS (SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scored JOIN damp USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed JOIN bt USING (item) WHERE rank <= {TOP}"""


def _assigned(k: int) -> str:
    return f"""a{k} AS (
  SELECT r, c, distance FROM (
    SELECT r, c, distance, row_number() OVER (PARTITION BY r ORDER BY distance, c) AS place FROM (
      SELECT r, c, CAST(sum((v.x - m.x) * (v.x - m.x)) AS BIGINT) AS distance FROM v JOIN m{k} m USING (i) GROUP BY r, c)) WHERE place = 1)"""


def _moved(k: int) -> str:
    return f"""m{k + 1} AS (
  SELECT c, i, coalesce(g.x, m.x) AS x FROM m{k} m LEFT JOIN (
    SELECT c, i, CAST(sum(x) // count(*) - CASE WHEN sum(x) < 0 AND sum(x) % count(*) <> 0 AND sum(x) // count(*) * count(*) > sum(x) THEN 1 ELSE 0 END AS BIGINT) AS x
    FROM v JOIN a{k} USING (r) GROUP BY c, i) g USING (c, i))"""


CENTROIDS = f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor(CAST(e AS DOUBLE) * {SCALE}) AS BIGINT)) AS x FROM (
    SELECT * FROM embeddings WHERE len(embedding) = {DIMENSION}
      AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e) AND abs(CAST(e AS DOUBLE)) < {LIMIT})) = {DIMENSION})),
v AS (SELECT r, unnest(range(1, {DIMENSION + 1})) AS i, unnest(x) AS x FROM kept),
start AS (
  SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS c FROM kept WHERE vec_id IS NOT NULL
  QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id), x) <= {CLUSTERS}),
m0 AS (SELECT c, i, x FROM start JOIN v USING (r)),
{", ".join(part for k in range(ROUNDS) for part in (_assigned(k), _moved(k)))},
{_assigned(ROUNDS)},
named AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM m{ROUNDS} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{ROUNDS} JOIN kept USING (r) JOIN named USING (c)"""

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TERMS.format("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT item_id, {TERMS.format("coalesce(text, '')")} AS w FROM benchmark),
wanted AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS k, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - {WINDOW - 2}))) AS i FROM b WHERE len(w) > 0)),
place AS (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM wanted)),
found AS (SELECT r, i, k, item_id FROM place JOIN wanted USING (k) WHERE array_to_string(w[i:i + k - 1], ' ') = s),
inside AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM found) GROUP BY r),
listed AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN inside USING (r) LEFT JOIN listed USING (r)"""

SQL = {"op1_quality_rules": QUALITY_RULES, "op2_source_mix": SOURCE_MIX, "op6_near_dups": NEAR_DUPS, "op9_warc": WARC,
       "op11_lexical_search": LEXICAL_SEARCH, "op12_centroids": CENTROIDS, "op13_decontamination": DECONTAMINATION}
