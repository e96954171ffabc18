"""SQL (DuckDB dialect) of the queries that SQL can state, over the same tables."""

from __future__ import annotations

from .chat_format import END, MORE, SEP, START

_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _ASCII_LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Every pair of a label by brute force, components by the closure of the links.
EMBEDDINGS = """
WITH RECURSIVE ok AS MATERIALIZED (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS u, b.vec_id AS v FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT vec_id AS n, vec_id AS r FROM embeddings
  UNION
  SELECT l.v, reach.r FROM reach JOIN links l ON l.u = reach.n),
low AS (SELECT n, min(r) AS component_id FROM reach GROUP BY n),
cnt AS (SELECT u, count(*) AS n_links FROM links GROUP BY u)
SELECT e.vec_id, coalesce(c.n_links, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN low l ON l.n = e.vec_id LEFT JOIN cnt c ON c.u = e.vec_id
"""

_ESCAPED = "replace(replace({}, '\\', '\\\\'), '<|', '<\\|')"

#: Digests from the turns themselves; the formatted length from the template's marks and escapes.
CHAT = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok' FROM range(2) r(i)),
marked AS (
  SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) = role, false) AS goes_on FROM said)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length({_ESCAPED.format('text')}) + CASE WHEN goes_on THEN {len(MORE)}
                ELSE {len(START + SEP + END)} + length({_ESCAPED.format('role')}) END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

#: Windows of items and of documents as strings, joined; hit words are the distinct places under the joined windows.
DECONTAMINATION = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
bw AS MATERIALIZED (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + 9), ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw))),
hit AS MATERIALIZED (SELECT doc_id, i, dw.n, item FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit
           FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
          FROM (SELECT DISTINCT doc_id, item FROM hit WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(p.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.listed, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places p ON p.doc_id = d.doc_id LEFT JOIN items i ON i.doc_id = d.doc_id
"""

#: Every kept term against every two groups of a lang, counts of zero included.
DIVERGENCE = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
said AS MATERIALIZED (SELECT i, lang, source, term, count(*) AS n FROM (SELECT i, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS MATERIALIZED (SELECT lang, term, sum(n)::HUGEINT AS n FROM said GROUP BY lang, term HAVING count(*) >= 30),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n) AS total FROM kept GROUP BY lang),
cnt AS MATERIALIZED (SELECT lang, source, term, sum(said.n)::HUGEINT AS n FROM said SEMI JOIN kept USING (lang, term) GROUP BY ALL),
grp AS MATERIALIZED (SELECT lang, source, coalesce((SELECT sum(n) FROM cnt WHERE cnt.lang = g.lang AND cnt.source = g.source), 0)::HUGEINT AS total
        FROM (SELECT DISTINCT lang, source FROM d) g),
p AS MATERIALIZED (
  SELECT lang, source, term, coalesce(cnt.n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(cnt.n, 0) + 5) // (grp.total + 5 * langs.v) AS p,
         1 + 1000000000::HUGEINT * (kept.n + 5) // (langs.total + 5 * langs.v) AS q
  FROM grp JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN cnt USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce((SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y USING (lang, term)
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source),
raised AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)))::INTEGER AS rank FROM pairs
UNION ALL
SELECT * FROM (SELECT *, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)))::INTEGER AS rank FROM raised)
WHERE rank <= 50
"""

#: Lines as lists, the hash as hex digits.
FILL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT doc_id, t, l, len(l) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(l) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(l) + 1) AS y,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 100 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
s AS (
  SELECT doc_id, t, n, form, array_to_string(l[1:least(x, y)], '') AS p, array_to_string(l[least(x, y) + 1:greatest(x, y)], '') AS m,
         array_to_string(l[greatest(x, y) + 1:], '') AS s FROM u)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s
"""

#: Every 200-byte string as 400 hex digits, cut from pieces of a text; runs of covered bytes, and the rest between them.
REPEATS = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS MATERIALIZED (SELECT r, c, n, substr(h, 800 * c + 1, 1200) AS p
      FROM (SELECT r, h, length(h) // 2 AS n, unnest(range(0, (length(h) // 2 - 200) // 400 + 1)) AS c FROM d WHERE length(h) >= 400)),
w AS MATERIALIZED (SELECT r, 400 * c + j AS i, md5(substr(p, 2 * j + 1, 400)) AS k
      FROM (SELECT r, c, p, unnest(range(0, least(400, n - 199 - 400 * c))) AS j FROM c)),
again AS MATERIALIZED (SELECT r, i FROM w JOIN (SELECT k FROM w GROUP BY k HAVING count(*) > 1) USING (k)),
marks AS (SELECT r, i, CASE WHEN i > lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 1 ELSE 0 END AS fresh FROM again),
runs AS (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS g FROM marks),
spans AS MATERIALIZED (SELECT r, min(i) AS lo, max(i) + 200 AS hi FROM runs GROUP BY r, g),
gaps AS (SELECT r, lo AS upto, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) AS since FROM spans
         UNION ALL SELECT d.r, length(d.h) // 2, coalesce(max(hi), 0) FROM d LEFT JOIN spans ON spans.r = d.r GROUP BY d.r, d.h),
kept AS (SELECT g.r, string_agg(substr(h, 2 * since + 1, 2 * (upto - since)), '' ORDER BY since) AS rest FROM gaps g JOIN d ON d.r = g.r GROUP BY g.r)
SELECT d.doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(s.gone, 0) AS BIGINT) AS n_removed, coalesce(s.n, 0) AS n_spans,
       sha256(unhex(rest)) AS kept_sha256
FROM d JOIN kept ON kept.r = d.r LEFT JOIN (SELECT r, count(*) AS n, sum(hi - lo) AS gone FROM spans GROUP BY r) s ON s.r = d.r
"""
