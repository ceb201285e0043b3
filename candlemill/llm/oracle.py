"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from .licenses import CONTAINMENT, SHINGLE_WORDS, TEMPLATES

_WORDS = r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP5 = f"""
WITH item AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS words
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM item WHERE len(w) > 0)
), doc AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents
), hit AS (
  SELECT d.r, d.i, s.n, s.item_id
  FROM (SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS words
        FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
              FROM doc, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)) d
  JOIN windows s ON d.n = s.n AND d.words = s.words
), counted AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN counted USING (r) LEFT JOIN named USING (r)
"""

_ESCAPED = "regexp_replace({text}, '<(\\\\*)\\|', '<\\\\\\1|', 'g')"
_CHAT_ROLE = r"replace(replace(replace(coalesce(role, ''), '\', '\\'), chr(10), '\n'), '<', '\l')"

_OP10 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         {_CHAT_ROLE} AS written_role, {_ESCAPED.format(text="coalesce(text, '')")} AS written
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
        UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(written_role) + length(written) + 24)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

_OP4_TEMPLATES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items())
_OP4 = f"""
WITH template AS (
  SELECT license, list_distinct(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS shingles, k
  FROM (SELECT license, w, least({SHINGLE_WORDS}, len(w)) AS k
        FROM (SELECT license, {_WORDS.format(text="text")} AS w FROM (VALUES {_OP4_TEMPLATES}) v(license, text)))
), doc AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents
), place AS (
  SELECT r, doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS shingle
  FROM (SELECT r, doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM doc, (SELECT DISTINCT k FROM template) WHERE len(w) >= k)
), hit AS (
  SELECT p.r, p.doc_id, t.license, len(t.shingles) AS m, (p.i - 1) // len(t.shingles) AS block, p.shingle
  FROM place p JOIN (SELECT license, k, shingles, unnest(shingles) AS shingle FROM template) t ON p.k = t.k AND p.shingle = t.shingle
), held AS (
  SELECT r, doc_id, license, m, q, count(DISTINCT shingle) / m AS containment
  FROM (SELECT *, block AS q FROM hit UNION ALL SELECT *, block - 1 FROM hit WHERE block > 0)
  GROUP BY r, doc_id, license, m, q
)
SELECT doc_id, license, count(*) AS n_windows, min(q * m)::BIGINT AS first_word, max(containment) AS containment
FROM held WHERE containment >= {CONTAINMENT} GROUP BY doc_id, license
"""

# Bits of the filters A to E are 1 to 16; an order is a list of them.
_OP13 = r"""
WITH doc AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), label AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id
), cell AS (
  SELECT part, bits, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
               (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
               + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t))::INT
               + 8 * regexp_matches(t, '[#$%&*|]')::INT
               + 16 * coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false)::INT AS bits
        FROM doc LEFT JOIN label USING (doc_id))
  GROUP BY part, bits
), letter(f, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
filter_orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1 : step - 1]), 0)::INT AS before
  FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM filter_orders)
), counted AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (bits & (before | own) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (bits & before = 0 AND bits & own <> 0), 0) AS removed,
         coalesce(sum(n) FILTER (bits & before <> 0 AND bits & own <> 0), 0) AS redundant,
         coalesce(sum(n) FILTER (bits = own), 0) AS unique_fails,
         coalesce(sum(good) FILTER (bits & before = 0 AND bits & own <> 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (bits & before = 0 AND bits & own <> 0), 0) AS toxic_lost
  FROM cell, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
"""

ORACLE: dict[str, str] = {
    "op4_licenses": _OP4,
    "op5_decontaminate": _OP5,
    "op10_chat": _OP10,
    "op13_filter_audit": _OP13,
}
