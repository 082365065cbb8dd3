"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from clickmart.llm import line_quality, url_filter
from clickmart.llm.queries import KEYWORD_BARS, SPAM_LABELS

_SPACE = r"[\x20\x09-\x0D]+"
_WORDS = rf"list_filter(regexp_split_to_array({{text}}, '{_SPACE}'), lambda x: x <> '')"


def _words(text: str) -> str:
    return _WORDS.format(text=text)


def _lower(text: str) -> str:
    return f"translate({text}, '{url_filter.UPPER}', '{url_filter.LOWER}')"


OP2 = rf"""
WITH d AS (SELECT doc_id, text AS raw, source, coalesce(text, '') AS text FROM documents),
words AS (SELECT *, {_words("text")} AS w,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
document AS (SELECT DISTINCT doc_id, raw, source, w, lines FROM words),
windows AS (SELECT doc_id, raw, source, i, list_slice(w, i, i + 4) AS win
            FROM (SELECT doc_id, raw, source, w, unnest(generate_series(1, len(w) - 4)) AS i FROM document WHERE len(w) >= 5)),
again AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, raw, source, win) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, raw, source, count(DISTINCT p) AS n_repeat
            FROM (SELECT doc_id, raw, source, unnest(generate_series(i, i + 4)) AS p FROM again) GROUP BY ALL),
line AS (SELECT doc_id, raw, source, trim(regexp_replace({_lower("l")}, '{_SPACE}', ' ', 'g')) AS norm, len({_words("l")}) AS n
         FROM (SELECT doc_id, raw, source, unnest(lines) AS l FROM document)),
hosts AS (SELECT source, count(*) AS host_docs FROM (SELECT DISTINCT source, doc_id, raw FROM d) GROUP BY source),
frequent AS (SELECT l.source, norm FROM (SELECT source, norm, count(*) AS docs
                                         FROM (SELECT DISTINCT source, norm, doc_id, raw FROM line) GROUP BY source, norm) l
             JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source WHERE docs >= 20 AND 100 * docs > 2 * host_docs),
removed AS (SELECT l.doc_id, l.raw, l.source, sum(n) AS gone FROM line l JOIN frequent f
            ON l.norm = f.norm AND l.source IS NOT DISTINCT FROM f.source GROUP BY ALL),
stats AS (
  SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(w.text, '{_SPACE}', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(w.text) - length(translate(w.text, '{line_quality.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n_repeat, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(r.gone, 0) AS BIGINT) AS n_removed_words
  FROM words w
  LEFT JOIN covered c ON w.doc_id IS NOT DISTINCT FROM c.doc_id AND w.raw IS NOT DISTINCT FROM c.raw AND w.source IS NOT DISTINCT FROM c.source
  LEFT JOIN removed r ON w.doc_id IS NOT DISTINCT FROM r.doc_id AND w.raw IS NOT DISTINCT FROM r.raw AND w.source IS NOT DISTINCT FROM r.source)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
       AND n_words - n_removed_words >= 10 AND 100 * (n_words - n_removed_words) >= 30 * n_words AS kept
FROM stats
"""

OP3 = rf"""
WITH words AS (SELECT doc_id, {_words("coalesce(text, '')")} AS w FROM documents),
windows AS (SELECT doc_id, i, list_slice(w, i, i + 19) AS win
            FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM words WHERE len(w) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM windows) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS p FROM later),
each AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM words),
kept AS (SELECT e.doc_id, count(g.p) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY e.p) FILTER (WHERE g.p IS NULL), '') AS kept
         FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.p = g.p GROUP BY e.doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP8 = rf"""
WITH doc AS (SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_ALNUM}') AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_ALNUM}') AS w FROM benchmark),
test AS (SELECT DISTINCT item_id, n, list_slice(w, i, i + n - 1) AS win
         FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM test),
place AS (SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS win
          FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM doc, sizes WHERE len(w) >= n)),
found AS (SELECT doc_id, item_id, i, test.n AS n FROM place JOIN test ON place.win = test.win AND place.n = test.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM found) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit ON doc.doc_id = hit.doc_id LEFT JOIN ids ON doc.doc_id = ids.doc_id
"""

_RULE = " ".join(
    f"WHEN (host = '{d}' OR ends_with(host, '.{d}')) AND starts_with(path, '/{p}') THEN '{r}'"
    for r, _ in sorted(url_filter.RULES, key=lambda x: -len(x[0])) for d, _, p in [r.partition("/")])
_ALLOW, _BLOCK = (", ".join(f"'{r}'" for r, v in url_filter.RULES if v == x) for x in ("allow", "block"))
_LABELS = "|".join(SPAM_LABELS)

OP9 = rf"""
WITH cut AS (SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
part AS (SELECT page_id, html, {_lower("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host, regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM cut),
ruled AS (SELECT *, CASE {_RULE} END AS rule FROM part),
keywords AS (SELECT DISTINCT host || path AS url FROM part
             WHERE host <> '' AND path <> '' AND contains(html, '|') AND 100 * (length(html) - length(replace(html, '|', ''))) >= {KEYWORD_BARS} * length(html))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ({_ALLOW}) THEN 'allow' WHEN rule IN ({_BLOCK}) THEN 'block'
            WHEN regexp_matches(host, '(^|\.)({_LABELS})(\.|$)') THEN 'block'
            WHEN host <> '' AND path <> '' AND keywords.url IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN keywords ON host || path = keywords.url
"""

#: All pairs of vectors; components by reachability.
OP11 = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS k, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
fine AS (SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.k AS a, b.k AS b FROM fine a JOIN fine b ON a.k <> b.k AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT k AS a, k AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
part AS (SELECT reach.a AS k, min(v.vec_id) AS component_id FROM reach JOIN v ON v.k = reach.b GROUP BY reach.a),
degree AS (SELECT a AS k, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM v JOIN part ON v.k = part.k LEFT JOIN degree ON v.k = degree.k
"""


def _crc32(string: str) -> str:
    """Unsigned CRC-32 of a string of code points below 256, one bit at a time: -1 shifts, a byte is added."""
    code = "lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)] ELSE [195, ord(x) - 64] END"
    steps = f"flatten(list_transform(flatten(list_transform(string_split({string}, ''), {code})), lambda x: [x, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "lambda c, y: CASE WHEN y >= 0 THEN xor(c, y) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform({steps}, lambda x: x::BIGINT)), {step}), 4294967295::BIGINT)"


#: Prefixes as strings of digests; a subtree's sums by joining each node to all its prefixes.
OP12 = rf"""
WITH turn AS (SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
                     md5(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
              FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'d': digest, 'c': chars}} ORDER BY turn NULLS FIRST, digest) AS w, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h
        FROM turn GROUP BY conv_id),
conv AS (SELECT o.conv_id, list_concat(coalesce(list_slice(f.w, 1, o.h), []), list_slice(o.w, o.h + 1, len(o.w))) AS w
         FROM own o LEFT JOIN own f ON f.conv_id = o.conv_id - o.conv_id % 100),
prefix AS (SELECT conv_id, w, unnest(generate_series(0, len(w))) AS depth FROM conv),
member AS (SELECT conv_id, depth, len(w) AS size, CASE WHEN depth > 0 THEN w[depth].c ELSE 0 END AS chars,
                  list_aggregate(list_transform(list_slice(w, 1, depth), lambda x: x.d), 'string_agg', '') AS key,
                  list_aggregate(list_transform(list_slice(w, 1, depth - 1), lambda x: x.d), 'string_agg', '') AS above FROM prefix),
node AS (SELECT coalesce(key, '') AS key, depth, coalesce(any_value(above), '') AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
                sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE size = depth), '')) AS ends_sha256
         FROM member GROUP BY ALL),
kids AS (SELECT above AS key, count(*) AS n FROM node WHERE depth > 0 GROUP BY above),
node2 AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids ON node.key = kids.key),
under AS (SELECT substr(key, 1, 32 * top) AS key, n_children, n_convs, chars
          FROM (SELECT *, unnest(generate_series(0, depth)) AS top FROM node2)),
sums AS (SELECT key, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved FROM under GROUP BY key)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM node2 n JOIN sums s ON n.key = s.key LEFT JOIN node2 p ON n.depth > 0 AND p.key = n.above
"""

#: Near words by the words' strings with one letter taken out.
OP13 = rf"""
WITH RECURSIVE run AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, {_lower("r")} AS w, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents) GROUP BY ALL),
hashed AS (SELECT w, n, {_crc32("doc || ':' || w")} AS h FROM run),
made AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM hashed),
vocabulary AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM made WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(generate_series(1, length(word))) AS i FROM vocabulary)),
near AS (SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
         UNION SELECT cut.word, v.word FROM cut JOIN vocabulary v ON cut.rest = v.word
         UNION SELECT v.word, cut.word FROM cut JOIN vocabulary v ON cut.rest = v.word),
best AS (SELECT a, count(*) AS n_near, min({{'k': -v.n, 'w': b}}) AS top FROM near JOIN vocabulary v ON v.word = near.b GROUP BY a),
form AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.k >= 2 * v.n THEN top.w END AS form,
                CASE WHEN -top.k >= 2 * v.n THEN -top.k END AS form_n FROM vocabulary v LEFT JOIN best ON best.a = v.word),
chain AS (SELECT word, word AS at FROM form UNION ALL SELECT chain.word, form.form FROM chain JOIN form ON form.word = chain.at WHERE form.form IS NOT NULL)
SELECT form.word, form.form, chain.at AS root, form.n, form.n_near, form.form_n
FROM form JOIN chain ON chain.word = form.word JOIN form last ON last.word = chain.at AND last.form IS NULL
"""

ORACLE = {"op2_line_frequency": OP2, "op3_phrase_automata": OP3, "op8_suffix_arrays": OP8, "op9_bloom_cascade": OP9,
          "op11_lattice_hashing": OP11, "op12_prefix_trie": OP12, "op13_bit_sliced_spelling": OP13}
