"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

import string

from hourloom.llm import licenses, quality_rules

_SPACE = r"[\x20\x09-\x0D]"


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def quality_rules_sql() -> str:
    """The rule table of ``quality_rules`` compiled into SQL."""
    failed = []
    for r in quality_rules.RULES:
        tests = [f"{r.measure} >= {r.least}"] * (r.least is not None) + [f"{r.measure} <= {r.most}"] * (r.most is not None)
        failed.append(f"CASE WHEN NOT ({' AND '.join(tests)}) THEN '{r.name}' END")

    def ratio(a, b, name):
        return f"CASE WHEN {b} > 0 THEN {a} * 1.0::DOUBLE / {b} ELSE 0.0 END AS {name}"

    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
a AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{_SPACE}+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
u AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM a),
g AS (SELECT doc_id, i, word || ' ' || lead(word, 1) OVER s || ' ' || lead(word, 2) OVER s AS g
      FROM u WINDOW s AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g WHERE g IS NOT NULL)
      WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM r, range(3) x(j) GROUP BY doc_id),
m AS (SELECT a.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
             coalesce(c.n, 0) AS n_repeat_words, len(l) AS n_lines,
             len(list_filter(w, lambda x: lower(x) IN ({_quoted(dict.fromkeys(quality_rules.STOP_WORDS))}))) AS n_stop_words,
             len(list_filter(l, lambda x: regexp_matches(x, '^\\s*(?:[-*•]\\s|\\d+[.)]\\s)'))) AS n_bullet_lines,
             len(list_filter(l, lambda x: regexp_matches(x, '(?:\\.\\.\\.|…)\\s*$'))) AS n_ellipsis_lines
      FROM a LEFT JOIN c ON a.doc_id = c.doc_id),
q AS (SELECT *, {ratio('word_chars', 'n_words', 'mean_word_chars')}, {ratio('n_symbols', 'n_words', 'symbol_ratio')},
             {ratio('n_stop_words', 'n_words', 'stop_ratio')}, {ratio('n_dup_lines', 'n_lines', 'dup_line_ratio')},
             {ratio('n_bullet_lines', 'n_lines', 'bullet_line_ratio')},
             {ratio('n_ellipsis_lines', 'n_lines', 'ellipsis_line_ratio')},
             {ratio('n_repeat_words', 'n_words', 'repeat_ratio')},
             n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
f AS (SELECT *, concat_ws(',', {', '.join(failed)}) AS failed_rules FROM q)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, failed_rules,
       NOT base_failed AND failed_rules = '' AS kept
FROM f
"""


SUBSTRING_DEDUP = f"""
WITH a AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}+'), lambda x: x <> '') AS w
           FROM documents),
u AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS n FROM a),
g AS (SELECT doc_id, i, n, word, list(word) OVER (PARTITION BY doc_id ORDER BY i
                                                  ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS g FROM u),
f AS (SELECT doc_id, i, word, i + 19 <= n AND doc_id * 100000000::HUGEINT + i
             > min(doc_id * 100000000::HUGEINT + i) OVER (PARTITION BY g) AS again FROM g),
r AS (SELECT doc_id, i, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i
                                                   ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM f),
k AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
             string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM r GROUP BY doc_id)
SELECT a.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM a LEFT JOIN k ON a.doc_id = k.doc_id
"""


def license_scan_sql() -> str:
    """Diagonal voting over the templates of ``licenses``."""
    listed = [(i, label, exact, text) for i, (label, exact, text) in enumerate(
        [(a, True, b) for a, b in licenses.PHRASES] + [(a, False, b) for a, b in licenses.TEMPLATES])]
    rows = ",\n  ".join(f"({i}, '{label}', {exact}, '{text}')" for i, label, exact, text in listed)
    return f"""
WITH p(template, label, exact, t) AS (VALUES {rows}),
pw AS (SELECT template, label, exact, string_split(t, ' ') AS w FROM p),
pu AS (SELECT template, label, exact, len(w) AS length, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS j FROM pw),
pg AS (SELECT *, word || ' ' || lead(word, 1) OVER s || ' ' || lead(word, 2) OVER s AS g
       FROM pu WINDOW s AS (PARTITION BY template ORDER BY j)),
a AS (SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
u AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM a),
g AS (SELECT doc_id, i, word || ' ' || lead(word, 1) OVER s || ' ' || lead(word, 2) OVER s AS g
      FROM u WINDOW s AS (PARTITION BY doc_id ORDER BY i)),
v AS (SELECT doc_id, template, label, exact, length, i - j AS diagonal, list(DISTINCT j) AS js
      FROM g JOIN pg ON g.g = pg.g GROUP BY ALL),
n AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal)
                          > {licenses.NEIGHBOUR} THEN 1 ELSE 0 END AS apart FROM v),
s AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span,
             len(js) = length - {licenses.GRAM - 1} AS whole FROM n),
m AS (SELECT doc_id, template, label, exact, length, span, flatten(list(js)) AS js,
             count(*) FILTER (WHERE whole) AS places, min(diagonal) FILTER (WHERE whole) AS first,
             max(diagonal) FILTER (WHERE whole) AS last FROM s GROUP BY ALL),
c AS (SELECT *, len(list_distinct(list_concat(js, list_transform(js, lambda x: x + 1),
                                             list_transform(js, lambda x: x + 2)))) * 1.0::DOUBLE / length AS share FROM m),
f AS (SELECT doc_id, sum(places) FILTER (WHERE exact) AS n_base, min(first) FILTER (WHERE exact) AS first_word,
             max(last) FILTER (WHERE exact) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE exact AND places > 0) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (
               WHERE CASE WHEN exact THEN places > 0 ELSE share >= {licenses.COVERAGE} END) AS labels,
             max(share) AS score FROM c GROUP BY doc_id)
SELECT a.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(least(coalesce(score, 0.0), 1.0) AS DOUBLE) AS score
FROM a LEFT JOIN f ON a.doc_id = f.doc_id
"""


def conversation_repair_sql() -> str:
    """The repair as a walk over the rows: the least (cost, audit) of each place of ``(s?(ua)+)?``."""
    def closed(v):
        """Insertions after a row: places 0 start, 1 system, 2 user, 3 assistant."""
        one = [f"{v}[1]", f"{v}[2]", f"least({v}[3], {ins(v + '[1]')}, {ins(v + '[2]')}, {ins(v + '[4]')})",
               f"least({v}[4], {ins(v + '[3]')})"]
        return "[" + ", ".join(one) + "]"

    def ins(cell):
        return f"{{'c': {cell}.c + 2, 'a': {cell}.a || 'I'}}"

    def edit(cell, cost, letter):
        return f"{{'c': v[{cell}].c + {cost}, 'a': v[{cell}].a || '{letter}'}}"

    none = "{'c': 1000000000, 'a': ''}"

    def reach(place, sources, letter):
        """Ways to ``place``: delete, keep or give the role ``letter`` to the row."""
        ways = [edit(place, 3, "D")]
        for p in sources:
            ways.append(f"CASE WHEN s = 'd' OR lower(s) <> '{letter}' THEN {none} ELSE {edit(p, 'x', 'K')} END")
            if letter in "ua":
                ways.append(f"CASE WHEN s = 'd' THEN {none} ELSE {edit(p, '2 + x', 'R')} END")
        return f"list_min([{', '.join(ways)}])"

    moved = ("[" + edit(1, 3, "D") + ", " + reach(2, [1], "s") + ", " + reach(3, [1, 2, 4], "u") + ", "
             + reach(4, [3], "a") + "]")
    start = closed(f"[{{'c': 0, 'a': ''}}, {none}, {none}, {none}]")
    return f"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                        lambda ch: CAST(ord(ch) AS BIGINT)) AS key
  FROM conversations),
hashed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, key), lambda crc, b: list_reduce(
           list_prepend(xor(crc, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
           lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS kind
  FROM raw),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed WHERE kind <> 0),
numbered AS (
  SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM damaged),
faults AS (
  SELECT *, left(role, 1) AS initial,
         CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
              WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM numbered),
symbols AS (
  SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 'd' WHEN initial IN ('s', 'u', 'a') THEN initial ELSE 'o' END AS s,
         CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS x,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM faults),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, {start} AS v FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, {closed('v')} FROM (
    SELECT w.conv_id, y.i, {moved.replace('v[', 'w.v[')} AS v
    FROM walk w JOIN symbols y ON w.conv_id IS NOT DISTINCT FROM y.conv_id AND y.i = w.i + 1)),
counts AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM symbols GROUP BY conv_id),
least_edits AS (
  SELECT w.conv_id, least(v[1], v[4]) AS best
  FROM walk w LEFT JOIN counts c ON w.conv_id IS NOT DISTINCT FROM c.conv_id WHERE w.i = coalesce(c.n, 0)),
steps AS (
  SELECT conv_id, best.a AS audit, unnest(range(1, length(best.a) + 1)) AS k FROM least_edits),
edits AS (
  SELECT conv_id, k, substr(audit, k, 1) AS e,
         length(replace(substr(audit, 1, k), 'I', '')) AS i,
         length(replace(substr(audit, 1, k - 1), 'D', '')) - length(replace(audit, 'D', '')) % 2 AS place
  FROM steps),
lines AS (
  SELECT e.conv_id, string_agg(CASE WHEN e.e = 'K' THEN y.role WHEN place % 2 = 0 THEN 'user' ELSE 'assistant' END
           || ':' || CASE WHEN e.e = 'I' THEN '' ELSE y.text END, chr(10) ORDER BY k) AS repaired
  FROM edits e LEFT JOIN symbols y ON e.conv_id IS NOT DISTINCT FROM y.conv_id AND y.i = e.i
  WHERE e.e <> 'D' GROUP BY e.conv_id)
SELECT l.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(best.c AS BIGINT) AS cost, best.a AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM least_edits l LEFT JOIN counts c ON l.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN lines r ON l.conv_id IS NOT DISTINCT FROM r.conv_id
"""


SOURCE_DIVERGENCE = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 3),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
t AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             CAST(1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (t.n + v.v) AS HUGEINT) AS p,
             CAST(1 + 1000000000::HUGEINT * (k.n + 1) // (v.n + v.v) AS HUGEINT) AS q
      FROM g JOIN k USING (lang) JOIN v USING (lang) JOIN t USING (lang, source) LEFT JOIN c USING (lang, source, term)),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
          UNION ALL
          SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM r WHERE part = 'pair' OR rank <= 200
"""
