"""The queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from starloom.llm import chat_format as chat
from starloom.llm.fill_middle import MIDDLE, PLAIN_PERCENT, PREFIX, SPM_PERCENT, SUFFIX
from starloom.llm.line_rules import HOST_SHARE, LEAST_LEFT, MAX_DOCUMENTS, MIN_DOCUMENTS, MIN_WORDS, MOST_REPEATED, WINDOW

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = r"\x20\x09-\x0D"


def _lower(column: str) -> str:
    return f"translate({column}, '{_UPPER}', '{_LOWER}')"


def _words(column: str, lower: bool = True) -> str:
    text = f"coalesce({column}, '')"
    return rf"regexp_extract_all({_lower(text) if lower else text}, '[^{_SPACE}]+')"


def _ink(column: str) -> str:
    text = f"coalesce({column}, '')"
    return rf"regexp_extract_all({_lower(text)}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


DECONTAMINATION = f"""
WITH item AS (SELECT item_id, {_ink("text")} AS w FROM benchmark),
win AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(list_slice(w, k, k + least(13, len(w)) - 1), ' ') AS win
      FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, {_ink("text")} AS w FROM documents),
place AS (
    SELECT d.doc_id, n, k, array_to_string(list_slice(w, k, k + n - 1), ' ') AS win
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM doc, (SELECT DISTINCT n FROM win)) d),
hit AS (SELECT doc_id, item_id, k, win.n AS n FROM place JOIN win ON win.win = place.win AND win.n = place.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hit) GROUP BY doc_id),
ids AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
  FROM doc LEFT JOIN pos ON pos.doc_id = doc.doc_id LEFT JOIN ids ON ids.doc_id = doc.doc_id
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE doc AS (SELECT doc_id, {_words("text")} AS w FROM documents),
sh AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, k, k + 3), ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS k FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
    SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * same >= 80 * (x.n + y.n - same)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(doc_id, to_id) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON e.a = r.to_id)
SELECT doc.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, m.component_id, doc.doc_id = m.component_id AS kept
  FROM doc LEFT JOIN size ON size.doc_id = doc.doc_id
  JOIN (SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY doc_id) m ON m.doc_id = doc.doc_id
"""

LINE_RULES = rf"""
WITH doc AS (SELECT doc_id, coalesce(source, '') AS source, source IS NULL AS none, coalesce(text, '') AS text,
                    {_words("text", lower=False)} AS w FROM documents),
win AS (SELECT doc_id, k, array_to_string(list_slice(w, k, k + {WINDOW - 1}), ' ') AS win
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS k FROM doc)),
twice AS (SELECT doc_id, k FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(k, k + {WINDOW})) AS p FROM twice) GROUP BY doc_id),
line AS (
    SELECT doc_id, source, none, nth, line, {_words("line")} AS w
      FROM (SELECT doc_id, source, none, unnest(string_split(text, chr(10))) AS line,
                   unnest(range(len(string_split(text, chr(10))))) AS nth FROM doc)),
full_line AS (
    SELECT *, regexp_replace(array_to_string(w, ' '), '[0-9]', '0', 'g') AS norm FROM line WHERE len(w) > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM full_line GROUP BY doc_id),
often AS (
    SELECT f.source, f.none, f.norm
      FROM (SELECT DISTINCT f.source, f.none, f.norm, doc.text FROM full_line f JOIN doc ON doc.doc_id = f.doc_id) f
      JOIN (SELECT source, none, least(greatest({HOST_SHARE} * count(DISTINCT text), {MIN_DOCUMENTS}), {MAX_DOCUMENTS}) AS most
              FROM doc GROUP BY source, none) h ON h.source = f.source AND h.none = f.none
     GROUP BY f.source, f.none, f.norm, h.most HAVING count(*) > h.most),
gone AS (
    SELECT doc_id, sum(len(w)) AS n FROM full_line f JOIN often o ON o.source = f.source AND o.none = f.none AND o.norm = f.norm
     GROUP BY doc_id),
stat AS (
    SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
           CAST(coalesce(gone.n, 0) AS BIGINT) AS gone
      FROM doc LEFT JOIN dup ON dup.doc_id = doc.doc_id LEFT JOIN rep ON rep.doc_id = doc.doc_id
      LEFT JOIN gone ON gone.doc_id = doc.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words)
       AND n_words - gone >= {LEAST_LEFT} * n_words AS kept
  FROM stat
"""

_SAFE = rf"regexp_replace(%s, '{chat.CONTROL.pattern}', '\1~\2\3', 'g')"
_NAME = f"replace(replace({_SAFE % 'role'}, '\\', '\\\\'), chr(10), '\\n')"

CHAT_FORMAT = f"""
WITH turn AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
written AS (
    SELECT *, length({_SAFE % "text"}) + CASE role
               WHEN 'system' THEN {sum(map(len, chat.SYSTEM))}
               WHEN 'user' THEN {len(chat.USER[1])} + CASE WHEN lag(role) OVER t = 'system' THEN 0 ELSE {len(chat.USER[0])} END
               WHEN 'assistant' THEN {sum(map(len, chat.ASSISTANT))}
               ELSE {sum(map(len, chat.OTHER)) + 1} + length({_NAME}) END AS n
      FROM turn WINDOW t AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = '{chat.LOSS_ROLE}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = '{chat.LOSS_ROLE}'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
  FROM written GROUP BY conv_id
"""


def _draw(k: int) -> str:
    return f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT)"


FILL_MIDDLE = f"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
cut AS (
    SELECT *, least({_draw(0)} % (n + 1), {_draw(1)} % (n + 1)) AS a, greatest({_draw(0)} % (n + 1), {_draw(1)} % (n + 1)) AS b,
           CASE WHEN n = 0 OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}')
                     OR {_draw(2)} % 100 >= {100 - PLAIN_PERCENT} THEN 'plain'
                WHEN {_draw(3)} % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
      FROM drawn),
part AS (SELECT *, substring(text, 1, a) AS p, substring(text, a + 1, b - a) AS m, substring(text, b + 1) AS s FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
                        ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
  FROM part
"""

ORACLE = {
    "op2_decontaminate": DECONTAMINATION,
    "op4_near_duplicates": NEAR_DUPLICATES,
    "op6_line_rules": LINE_RULES,
    "op11_chat_format": CHAT_FORMAT,
    "op12_fill_middle": FILL_MIDDLE,
}
