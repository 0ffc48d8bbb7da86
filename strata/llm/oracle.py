"""DuckDB SQL of the queries of this subpackage that SQL can express.

Absent: op2 (iterated components of 64-bit fingerprints), op3 (byte suffixes), op4
(a tokenizer), op5 and op6 (trained models), op7 (Newton iterations), op8 (a trained
model), op12 (eigenvectors). Their tests compare with brute force, a round trip or
held-out accuracy.
"""

from __future__ import annotations

from strata.llm.chat_format import TEMPLATE
from strata.llm.decontaminate import NOT_WORD, WINDOW
from strata.llm.merkle import COLUMNS, FAN
from strata.llm.quality_rules import RULES, STOP_WORDS, Rule


def _passes(r: Rule) -> str:
    return f"({r.numerator} >= {r.low} * {r.denominator} AND {r.numerator} <= {r.high} * {r.denominator})"


QUALITY_RULES = rf"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), win AS (
  SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM t WHERE len(w) >= 8)
), rep AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1
), covered AS (
  SELECT rid, sum(k) AS n
  FROM (SELECT rid, least(8, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 8)) AS k FROM rep)
  GROUP BY rid
), counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         len(l) AS n_lines,
         len(list_filter(w, lambda x: lower(x) IN ({", ".join(repr(x) for x in dict.fromkeys(STOP_WORDS))}))) AS n_stop,
         length(text) - length(replace(text, '!', '')) AS n_bangs,
         length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) AS n_capitals,
         length(text) - length(regexp_replace(text, '\p{{L}}', '', 'g')) AS n_letters
  FROM t LEFT JOIN covered USING (rid)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(_passes(r) for r in RULES)} AS kept
FROM judged
"""


def _escaped(column: str) -> str:
    out = rf"replace({column}, '\', '\\')"
    for c in TEMPLATE.controls:
        out = rf"replace({out}, '{c}', '{c[0]}\{c[1:]}')"
    return out


CHAT_FORMAT = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({sum(map(len, TEMPLATE.controls))} + length({_escaped("role")}) + length({_escaped("text")})) AS BIGINT)
         AS formatted_chars,
       list_reduce(list_prepend('start', list(role ORDER BY turn, role, text)), lambda state, role:
         CASE state || ' ' || role {" ".join(f"WHEN '{s} {r}' THEN '{t}'" for (s, r), t in TEMPLATE.transitions.items())}
         ELSE 'error ' || role END) IN {TEMPLATE.accepting} AS valid
FROM turns GROUP BY conv_id
"""

TOPK_SEARCH = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(a.q, b.q, true), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 20 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20
"""



def _leaf(columns: dict[str, str]) -> str:
    parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns.values()]
    return f"sha256({' || '.join(parts)})"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# crc32 of a decimal id, bit by bit
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
         list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
       lambda state, byte: list_reduce([xor(state, byte), 0, 0, 0, 0, 0, 0, 0, 0],
         lambda s, bit: xor(s >> 1, 3988292384 * (s & 1)))))"""

# the documents' trees (key = source) and the tree over their roots are climbed by the same steps
_CLIMB = f"""
  SELECT key, level + 1, i // {FAN}, sha256(string_agg(h, '' ORDER BY i)), (n + {FAN - 1}) // {FAN}
  FROM {{nodes}} WHERE n > 1 GROUP BY key, level, i // {FAN}, n"""
_FOLD = f"""
  SELECT p.rid, p.key, p.level + 1, p.i // {FAN}, (p.n + {FAN - 1}) // {FAN},
         p.siblings || coalesce(s.l, '') || coalesce(s.r, ''),
         sha256(coalesce(s.l, '') || p.now || coalesce(s.r, ''))
  FROM {{paths}} p LEFT JOIN {{sides}} s ON s.key = p.key AND s.level = p.level AND s.i = p.i
  WHERE p.n > 1"""
_SIDES = f"""
  SELECT a.key, a.level, a.i, string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i) AS l,
         string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i) AS r
  FROM {{nodes}} a JOIN {{nodes}} b ON b.key = a.key AND b.level = a.level AND b.i // {FAN} = a.i // {FAN}
  GROUP BY a.key, a.level, a.i"""

MERKLE_MANIFEST = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce('=' || source, '') AS key,
         {_leaf({c: c for c in COLUMNS})} AS leaf,
         {_leaf({c: _LOWER if c == "text" else c for c in COLUMNS})} AS lowered,
         doc_id IS NOT NULL AND ({_CRC32}) % 5 = 0 AS tampered
  FROM documents
), leaves AS (
  SELECT row_number() OVER () AS rid, *, count(*) OVER (PARTITION BY key) AS n,
         row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM hashed
), nodes(key, level, i, h, n) AS (
  SELECT key, 0, i, leaf, n FROM leaves UNION ALL {_CLIMB.format(nodes="nodes")}
), subroots AS (SELECT key, h AS subroot FROM nodes WHERE n = 1
), sources(key, level, i, h, n) AS (
  SELECT '', 0, row_number() OVER (ORDER BY key) - 1, subroot, count(*) OVER () FROM subroots
  UNION ALL {_CLIMB.format(nodes="sources")}
), sides AS ({_SIDES.format(nodes="nodes")}
), source_sides AS ({_SIDES.format(nodes="sources")}
), inner_paths(rid, key, level, i, n, siblings, now) AS (
  SELECT rid, key, 0, i, n, '', CASE WHEN tampered THEN lowered ELSE leaf END FROM leaves
  UNION ALL {_FOLD.format(paths="inner_paths", sides="sides")}
), outer_paths(rid, key, level, i, n, siblings, now) AS (
  SELECT p.rid, '', 0, s.i, s.n, p.siblings, p.now
  FROM inner_paths p
  JOIN (SELECT key, row_number() OVER (ORDER BY key) - 1 AS i, count(*) OVER () AS n FROM subroots) s ON s.key = p.key
  WHERE p.n = 1
  UNION ALL {_FOLD.format(paths="outer_paths", sides="source_sides")}
)
SELECT l.doc_id, l.leaf, r.subroot, t.h AS root, sha256(p.siblings) AS proof_sha256, p.now AS folded_root,
       p.now = t.h AS verified
FROM leaves l JOIN subroots r ON r.key = l.key JOIN outer_paths p ON p.rid = l.rid AND p.n = 1
CROSS JOIN (SELECT h FROM sources WHERE n = 1) t
"""


def _words(column: str) -> str:
    lower = _LOWER.replace("text", f"coalesce({column}, '')")
    return f"list_filter(regexp_split_to_array({lower}, '{NOT_WORD}+'), lambda x: x <> '')"


DECONTAMINATION = f"""
WITH items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_words("text")} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT item, w, least(len(w), {WINDOW}) AS k, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS i
        FROM items WHERE len(w) > 0)
), docs AS (SELECT row_number() OVER () AS rid, doc_id, {_words("text")} AS w FROM documents
), sizes AS (SELECT DISTINCT k FROM windows
), hits AS (
  SELECT d.rid, d.i, d.k, x.item
  FROM (SELECT rid, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
        FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, sizes WHERE len(w) >= k)) d
  JOIN windows x ON x.k = d.k AND x.g = d.g
), hit_words AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + k)) AS j FROM hits) GROUP BY rid
), hit_items AS (
  SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
       sha256(coalesce(t.names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words h ON h.rid = d.rid LEFT JOIN hit_items t ON t.rid = d.rid
"""

SQL: dict[str, str] = {
    "op1_quality_rules": QUALITY_RULES,
    "op9_topk_search": TOPK_SEARCH,
    "op10_chat_format": CHAT_FORMAT,
    "op11_merkle_manifest": MERKLE_MANIFEST,
    "op13_decontamination": DECONTAMINATION,
}
