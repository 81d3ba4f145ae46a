"""DuckDB SQL of the corpus queries that SQL can express, written from their contracts."""

from __future__ import annotations

from meadowlark.llm import hard_negatives, html_text, importance, pii, warc_revisit

_WORDS = r"""d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda x: x <> '') AS w FROM documents),
k AS (SELECT doc_id, w, array_to_string(w, ' ') AS t FROM d)"""

NGRAM_JOIN = f"""
WITH RECURSIVE {_WORDS},
reps AS (SELECT t, min(doc_id) AS rep, any_value(w) AS w FROM k WHERE len(w) > 0 GROUP BY t),
sh AS (SELECT DISTINCT rep, array_to_string(list_slice(w, i, i + 4), ' ') AS s FROM (SELECT rep, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM reps)),
n AS (SELECT rep, count(*) AS n FROM sh GROUP BY 1),
pairs AS (SELECT a.rep AS a, b.rep AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.rep < b.rep GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.rep = a JOIN n y ON y.rep = b WHERE c * 5 >= 4 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT DISTINCT a, a AS b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON e.a = r.b),
class AS (SELECT a AS rep, min(b) AS class_id FROM reach GROUP BY 1),
degree AS (SELECT a AS rep, count(*) AS n_links FROM both_ways GROUP BY 1)
SELECT k.doc_id, coalesce(r.rep, k.doc_id) AS copy_of, coalesce(c.class_id, r.rep, k.doc_id) AS class_id, coalesce(g.n_links, 0) AS n_links
FROM k LEFT JOIN reps r ON r.t = k.t LEFT JOIN class c ON c.rep = r.rep LEFT JOIN degree g ON g.rep = r.rep
"""

PASSAGES = f"""
WITH {_WORDS},
x AS (SELECT doc_id, w, md5(t) AS t FROM k WHERE len(w) >= 50 AND doc_id IS NOT NULL),
texts AS (SELECT t, min(doc_id) AS low, max(doc_id) AS high, any_value(w) AS w FROM x GROUP BY t),
win AS (SELECT t, CASE WHEN low = high THEN 'id ' || low ELSE t END AS owner, low = high AS single, i - 1 AS s, hash(list_slice(w, i, i + 49)) AS h FROM (SELECT *, unnest(range(1, len(w) - 48)) AS i FROM texts)),
multi AS (SELECT h FROM win GROUP BY h HAVING min(owner) < max(owner)),
hit AS (SELECT t, s FROM win SEMI JOIN multi USING (h) WHERE single),
marked AS (SELECT *, CASE WHEN s <= lag(s) OVER (PARTITION BY t ORDER BY s) + 50 THEN 0 ELSE 1 END AS fresh FROM hit),
islands AS (SELECT *, sum(fresh) OVER (PARTITION BY t ORDER BY s) AS island FROM marked),
spans AS (
  SELECT any_value(low) AS doc_id, min(s) AS start, max(s) + 50 AS stop FROM islands JOIN texts USING (t) GROUP BY t, island
  UNION ALL SELECT doc_id, 0, len(x.w) FROM x JOIN texts USING (t) WHERE low < high)
SELECT DISTINCT doc_id, start, stop, stop - start AS n_words FROM spans
"""

CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')) v(conv_id, turn, role, text)),
w AS (SELECT *, '### ' || regexp_replace(role, '([\\:\n])', '\\\1', 'g') || ': ' || regexp_replace(text, '(\\*)(### |</turn>)', '\\\1\2', 'g') || chr(10) || '</turn>' || chr(10) AS form FROM c),
g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, role) FILTER (role = 'assistant'), '') AS learned, sum(length(form))::BIGINT AS formatted_chars
  FROM w GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256, formatted_chars FROM g
"""

#: The contract's patterns, and the added kinds' own.
_PLAIN = pii.PATTERN | {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(range(1, 21), lambda i: CAST(substr(CASE WHEN i % 2 = 1 THEN translate(lpad({_DIGITS}, 20, '0'), '0123456789', '0246813579') ELSE lpad({_DIGITS}, 20, '0') END, i, 1) AS INTEGER))) % 10 = 0"
_SQUEEZED = "replace(v, ' ', '')"
_NUMBER = f"array_to_string(list_transform(string_split(substr({_SQUEEZED}, 5) || left({_SQUEEZED}, 4), ''), lambda x: CASE WHEN x BETWEEN '0' AND '9' THEN x ELSE CAST(ascii(x) - 55 AS VARCHAR) END), '')"
_REST1 = f"CAST(CAST(left({_NUMBER}, 30) AS HUGEINT) % 97 AS VARCHAR) || substr({_NUMBER}, 31, 30)"
_REST2 = f"CAST(CAST({_REST1} AS HUGEINT) % 97 AS VARCHAR) || substr({_NUMBER}, 61)"
_CONFIRMED = {
    "email": "TRUE",
    "ip": rf"regexp_full_match(v, '{_PART}\.{_PART}\.{_PART}\.{_PART}')",
    "card": f"length({_DIGITS}) BETWEEN 12 AND 19 AND {_LUHN}",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
    "iban": f"length({_SQUEEZED}) BETWEEN 15 AND 34 AND CAST({_REST2} AS HUGEINT) % 97 = 1",
    "ssn": "NOT regexp_matches(v, '^(000|666|9)|-00-|-0000$')",
}
_KINDS = " UNION ALL ".join(
    f"SELECT doc_id, t, '{kind}' AS kind, {n} AS ord, string_split_regex(t, '{_PLAIN[kind]}') AS gaps, regexp_extract_all(t, '{_PLAIN[kind]}') AS vals FROM d WHERE regexp_matches(t, '{_PLAIN[kind]}')" for n, kind in enumerate(pii.KINDS)
)
_OK = " ".join(f"WHEN '{kind}' THEN {test}" for kind, test in _CONFIRMED.items())
_NEAR = " ".join(f"WHEN '{kind}' THEN regexp_matches(ctx, '{words}')" for kind, words in pii.CONTEXT.items())
_SCORES = " ".join(f"WHEN '{kind}' THEN {score}::DOUBLE" for kind, score in pii.SCORE.items())
_BASE = ", ".join(f"'{k}'" for k in pii.BASE)

PII = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({_KINDS}),
u AS (SELECT doc_id, t, kind, ord, unnest(range(1, len(gaps) + 1)) AS i, unnest(gaps) AS gap, unnest(list_concat(vals, [NULL])) AS v FROM m),
p AS (SELECT *, CAST(sum(length(gap) + coalesce(length(v), 0)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS stop FROM u),
q AS (SELECT *, stop - length(v) AS start FROM p WHERE v IS NOT NULL AND CASE kind {_OK} END),
c AS (SELECT *, lower(substr(t, greatest(start - {pii.NEAR}, 0) + 1, least(start, {pii.NEAR})) || chr(10) || substr(t, stop + 1, {pii.NEAR})) AS ctx FROM q),
s AS (SELECT *, round(CASE kind {_SCORES} END + CASE WHEN CASE kind {_NEAR} END THEN {pii.GAIN}::DOUBLE ELSE 0 END, 2) AS score FROM c),
f AS (SELECT *, kind || ':' || start || ':' || stop AS span FROM s WHERE kind IN ({_BASE}) OR score >= {pii.LEAST}),
g AS (
  SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in pii.KINDS)},
         string_agg(span, ',' ORDER BY start, ord) FILTER (kind IN ({_BASE})) AS base, string_agg(span, ',' ORDER BY start, ord) AS spans, string_agg(score, ',' ORDER BY start, ord) AS scores
  FROM f GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in pii.KINDS)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM d LEFT JOIN g ON g.doc_id = d.doc_id
"""

SQL = {"op1_ngram_join": NGRAM_JOIN, "op2_suffix_dedup": PASSAGES, "op6_chat_format": CHAT, "op8_warc_revisits": warc_revisit.ORACLE, "op10_pii": PII, "op11_importance": importance.ORACLE, "op12_hard_negatives": hard_negatives.ORACLE, "op13_html_text": html_text.ORACLE}
