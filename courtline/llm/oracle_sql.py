"""DuckDB SQL for the operators that SQL can express on whole tables."""

from __future__ import annotations

from courtline.llm import infill, licenses, merkle, quality

_SPLIT = r"regexp_split_to_array({t}, '[\x20\x09-\x0D]+')"

WARC = r"""
WITH payloads AS (
  SELECT page_id, trim(regexp_replace(ifnull(url, ''), '\s+', ' ', 'g')) AS url, strlen(ifnull(html, '')) AS payload_bytes,
    sha1(ifnull(html, '')) AS payload_digest FROM pages),
grouped AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM payloads)
SELECT page_id, url, payload_bytes, payload_digest,
  if(payload_bytes >= 1000 AND page_id < last, 'revisit', 'response') AS record_type,
  if(payload_bytes >= 1000 AND page_id < last, last, NULL) AS refers_to
FROM grouped"""


def _per(a: str, b: str) -> str:
    return f"if({b} > 0, {a} / {b}, 0.0)"


QUALITY = rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, lang, source, ifnull(text, '') AS t FROM documents),
split AS (SELECT *, list_filter({_SPLIT.format(t="t")}, lambda x: x <> '') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, list_extract(g, 1), g) AS n FROM (
  SELECT r, i, w[i:i + 7] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM split))),
repeats AS (SELECT r, count(DISTINCT i + j) AS n FROM (SELECT r, i, unnest(range(8)) AS j FROM windows WHERE n > 1) GROUP BY r),
counts AS (
  SELECT r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS n_upper, len(lines) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(ifnull(n, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN repeats USING (r)),
measured AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    {_per("n_symbols", "n_words")} AS symbols_per_word, {_per("n_upper", "word_chars")} AS upper_share,
    {_per("n_dup_lines", "n_lines")} AS dup_line_share, {_per("n_repeat_words", "n_words")} AS repeat_share,
    {_per("word_chars", "n_words")} AS word_length FROM counts),
tall AS (SELECT r, lang, source, measure, v FROM measured UNPIVOT (v FOR measure IN ({", ".join(quality.SPREAD)}))),
bucketed AS (SELECT lang, source, measure, if(v > 0, ceil(ln(v) / ln({quality.GAMMA})), -1000000) AS b, v FROM tall),
levels AS (
  SELECT 1 AS level, lang, source, measure, count(*) AS docs, quantile_disc(b, [0.25, 0.75]) AS q FROM bucketed GROUP BY ALL
  UNION ALL SELECT 2, lang, NULL, measure, count(*), quantile_disc(b, [0.25, 0.75]) FROM bucketed GROUP BY ALL
  UNION ALL SELECT 3, NULL, NULL, measure, count(*), quantile_disc(b, [0.25, 0.75]) FROM bucketed GROUP BY ALL),
fences AS (
  SELECT level, lang, source, measure, docs, q75 + {quality.FENCE} * greatest(q75 - q25, spread) AS fence FROM (
    SELECT *, if(q[1] = -1000000, 0, pow({quality.GAMMA}, q[1])) AS q25, if(q[2] = -1000000, 0, pow({quality.GAMMA}, q[2])) AS q75
    FROM levels) JOIN (VALUES {", ".join(f"('{m}', {s})" for m, s in quality.SPREAD.items())}) s(measure, spread) USING (measure)),
above AS (
  SELECT DISTINCT t.r FROM tall t
  JOIN fences c ON c.level = 1 AND c.lang IS NOT DISTINCT FROM t.lang AND c.source IS NOT DISTINCT FROM t.source AND c.measure = t.measure
  JOIN fences l ON l.level = 2 AND l.lang IS NOT DISTINCT FROM t.lang AND l.measure = t.measure
  JOIN fences a ON a.level = 3 AND a.measure = t.measure
  WHERE t.v > CASE WHEN c.docs >= {quality.MIN_CELL} THEN c.fence WHEN l.docs >= {quality.MIN_CELL} THEN l.fence ELSE a.fence END)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND r NOT IN (SELECT r FROM above) AS kept,
  symbols_per_word, upper_share, dup_line_share, repeat_share, word_length
FROM measured"""


def _words(text: str) -> str:
    return rf"list_filter(regexp_split_to_array(lower({text}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


LICENSES = rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, {_words("replace(ifnull(text, ''), chr(0), ' ')")} AS w FROM documents),
phrases AS (SELECT string_split(p, ' ') AS p, label FROM (VALUES {", ".join(f"({_q(p)}, {_q(x)})" for p, x in licenses.PHRASES.items())}) v(p, label)),
spots AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM texts),
base AS (
  SELECT r, count(*) AS n_base, min(i) - 1 AS first_word, max(i) - 1 AS last_word, list(DISTINCT label) AS labels
  FROM spots JOIN phrases ON w[i] = p[1] AND w[i:i + len(p) - 1] = p GROUP BY r),
templates AS (SELECT id, label, {_words("text")} AS w
  FROM (VALUES {", ".join(f"({k}, {_q(x)}, {_q(t)})" for k, (x, t) in enumerate(licenses.TEMPLATES))}) v(id, label, text)),
grams AS (SELECT id, label, len(w) AS size, i AS place, w[i:i + {licenses.K - 1}] AS g
  FROM (SELECT *, unnest(range(1, len(w) - {licenses.K - 2})) AS i FROM templates)),
hits AS (SELECT r, id, label, size, place, i - place AS diagonal
  FROM (SELECT r, i, w[i:i + {licenses.K - 1}] AS g FROM spots) s JOIN grams USING (g)),
steps AS (SELECT *, diagonal - lag(diagonal) OVER o > {licenses.NEAR} AS fresh
  FROM (SELECT DISTINCT r, id, diagonal FROM hits) WINDOW o AS (PARTITION BY r, id ORDER BY diagonal)),
runs AS (SELECT *, sum(if(fresh, 1, 0)) OVER (PARTITION BY r, id ORDER BY diagonal) AS run FROM steps),
held AS (SELECT DISTINCT r, id, label, size, run, place + j AS word
  FROM (SELECT r, id, label, size, run, place, unnest(range({licenses.K})) AS j FROM hits JOIN runs USING (r, id, diagonal))),
found AS (SELECT r, list(DISTINCT label) AS labels, max(cover) AS cover
  FROM (SELECT r, id, label, run, count(*) / any_value(size) AS cover FROM held GROUP BY ALL) WHERE cover >= {licenses.COVER} GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(ifnull(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, array_to_string(list_sort(ifnull(b.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(ifnull(b.labels, []), ifnull(f.labels, [])))), ',') AS labels,
  if(n_base > 0, 1.0, least(ifnull(cover, 0.0), 1.0)) AS score
FROM texts LEFT JOIN base b USING (r) LEFT JOIN found f USING (r)"""


def _times(text: str, what: str) -> str:
    return f"(length({text}) - length(replace({text}, {_q(what)}, ''))) // {len(what)}"


def _escaped(text: str, *controls: str) -> str:
    return f"length({text}) + " + " + ".join(_times(text, c) for c in ("\\", "### ", "</turn>", *controls))


CHAT = rf"""
WITH turns AS (
  SELECT conv_id, turn, ifnull(role, '') AS role, ifnull(text, '') AS text FROM conversations
  UNION ALL SELECT -7, k, if(k = 0, 'user', 'assistant'), '\### Assistant: </turn> ok' FROM range(2) r(k)),
sized AS (
  SELECT *, {_escaped("text")} + 8 + CASE role WHEN 'assistant' THEN 15 WHEN 'user' THEN 10 WHEN 'system' THEN 12
    ELSE 11 + {_escaped("role", ": ")} END AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(ifnull(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(ifnull(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""

#: crc32 of a decimal number, bit by bit: a digit enters at the first of its eight shifts.
_CRC = ("xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split({s}, ''), lambda c: [ascii(c), 0, 0, 0, 0, 0, 0, 0]))), "
        "lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))))")


def _levels(name: str, depth: int) -> str:
    """``depth`` levels above ``name``0 (tree, idx, n, h); a tree that has come to one node is carried on."""
    f = merkle.FANOUT
    return ",\n".join(rf"""{name}{k} AS (
  SELECT tree, idx // {f} AS idx, (max(n) + {f - 1}) // {f} AS n, list(h ORDER BY idx) AS kids, sha256(string_agg(h, '' ORDER BY idx)) AS h
  FROM {name}{k - 1} WHERE n > 1 GROUP BY tree, idx // {f}
  UNION ALL SELECT tree, 0, 1, NULL, h FROM {name}{k - 1} WHERE n = 1)""" for k in range(1, depth + 1))


def _fold(depth: int, start: str, way: str) -> str:
    """Columns that gather the siblings and hash upwards along ``way``1, ``way``2, ... (lists of children)."""
    f, out, acc = merkle.FANOUT, [], start
    for k in range(1, depth + 1):
        slot = f"(({way}.idx // {f ** (k - 1)}) % {f})"
        kids = f"{way}{k}.kids"
        left, right = f"array_to_string({kids}[1:{slot}], '')", f"array_to_string({kids}[{slot} + 2:], '')"
        out.append(f"if({kids} IS NULL, '', {left} || {right}) AS {way}_sib{k}")
        out.append(f"if({kids} IS NULL, {acc}, sha256({left} || {acc} || {right})) AS {way}_f{k}")
        acc = f"{way}_f{k}"
    return ", ".join(out)


_DEPTH, _TOP = 6, 3  # enough for 8 ** 6 rows of a language and 8 ** 3 languages
_FIELDS = " || ".join(f"ifnull(strlen(CAST({{{c}}} AS VARCHAR)) || ':' || {{{c}}}, '-')" for c in merkle.FIELDS)
_OWN = {c: c for c in merkle.FIELDS}
MANIFEST = rf"""
WITH hashed AS (
  SELECT ifnull('=' || lang, '') AS tree, doc_id, sha256({_FIELDS.format(**_OWN)}) AS h,
    sha256({_FIELDS.format(**_OWN | {"text": "found_text"})}) AS found
  FROM (SELECT *, if({_CRC.format(s="CAST(doc_id AS VARCHAR)")} % 3 = 0, translate(text, '{merkle.UPPER}', '{merkle.LOWER}'), text) AS found_text
        FROM documents)),
a0 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM hashed),
{_levels("a", _DEPTH)},
b0 AS (SELECT '' AS tree, tree AS lang, h, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM a{_DEPTH}),
{_levels("b", _TOP)},
ways AS (
  SELECT a.doc_id, a.h AS leaf, b.h AS subroot, b{_TOP}.h AS root, {_fold(_DEPTH, "a.found", "a")}, {_fold(_TOP, f"a_f{_DEPTH}", "b")}
  FROM a0 a {" ".join(f"JOIN a{k} ON a{k}.tree = a.tree AND a{k}.idx = a.idx // {merkle.FANOUT ** k}" for k in range(1, _DEPTH + 1))}
  JOIN b0 b ON b.lang = a.tree {" ".join(f"JOIN b{k} ON b{k}.idx = b.idx // {merkle.FANOUT ** k}" for k in range(1, _TOP + 1))})
SELECT doc_id, leaf, subroot, root, sha256({" || ".join([f"a_sib{k}" for k in range(1, _DEPTH + 1)] + [f"b_sib{k}" for k in range(1, _TOP + 1)])}) AS proof_sha256,
  b_f{_TOP} AS folded_root, b_f{_TOP} = root AS verified FROM ways"""


INFILL = rf"""
WITH texts AS (
  SELECT doc_id, ifnull(text, '') AS t, CAST(length(ifnull(text, '')) AS BIGINT) AS n, sha256('1:' || ifnull(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
drawn AS (
  SELECT doc_id, t, n, {", ".join(f"CAST('0x' || d[{8 * k + 1}:{8 * k + 8}] AS BIGINT) AS h{k + 1}" for k in range(4))} FROM texts),
cuts AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '{infill.PREFIX}') OR contains(t, '{infill.SUFFIX}') OR contains(t, '{infill.MIDDLE}')
      OR h3 % 100 >= {infill.PLAIN_FROM} THEN 'plain' WHEN h4 % 100 < {infill.SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1, n - b) AS s FROM cuts)
SELECT doc_id, n, form, if(form = 'plain', NULL, a) AS prefix_chars, if(form = 'plain', NULL, b - a) AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{infill.PREFIX}' || p || '{infill.SUFFIX}' || s || '{infill.MIDDLE}' || m
    ELSE '{infill.SUFFIX}' || s || '{infill.PREFIX}' || p || '{infill.MIDDLE}' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM parts"""

SQL = {"op4_warc": WARC, "op6_licenses": LICENSES, "op7_quality": QUALITY, "op11_chat": CHAT, "op12_manifest": MANIFEST, "op13_infill": INFILL}
