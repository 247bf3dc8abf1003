"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from barwise.llm import licenses, urlrules

SQL: dict[str, str] = {}


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEPARATOR = r"\x00-\x2F\x3A-\x60\x7B-\x7F"


def _low(x: str) -> str:
    return f"translate({x}, '{_UPPER}', '{_LOWER}')"


def _words(x: str) -> str:
    return f"regexp_extract_all({x}, '[^{_SEPARATOR}]+')"


# The pair with no second word is null, which list_distinct leaves out.
_BIGRAMS = "list_distinct(list_transform(list_zip(w, w[2:]), lambda x: x[1] || ' ' || x[2]))"


SQL["op2_license_scan"] = f"""WITH template AS (
  SELECT name, {_BIGRAMS} AS grams
  FROM (SELECT name, {_words(_low('body'))} AS w
        FROM (VALUES {', '.join(f'({_text(n)}, {_text(t)})' for n, t in licenses.TEMPLATES)}) v(name, body))),
body AS (SELECT doc_id, {_low("coalesce(text, '')")} AS t FROM documents),
segment AS (
  SELECT doc_id, unnest(list_distinct(list_concat(string_split(t, chr(10)),
         string_split_regex(t, '\\n[{_SEPARATOR}]*\\n'), [t]))) AS s FROM body),
split AS MATERIALIZED (SELECT doc_id, {_words('s')} AS w FROM segment),
part AS MATERIALIZED (SELECT doc_id, {_BIGRAMS} AS grams FROM split WHERE len(w) > 1),
scored AS (
  SELECT doc_id, name, 2.0::DOUBLE * len(list_intersect(part.grams, template.grams)) / (len(part.grams) + len(template.grams)) AS dice
  FROM part JOIN template ON 2 * least(len(part.grams), len(template.grams)) >= {licenses.THRESHOLD} * (len(part.grams) + len(template.grams))),
best AS (SELECT doc_id, name, max(dice) AS dice FROM scored WHERE dice >= {licenses.THRESHOLD} GROUP BY doc_id, name)
SELECT d.doc_id, count(b.name) AS n_licenses, coalesce(string_agg(b.name, ',' ORDER BY b.name), '') AS licenses,
       first(b.name ORDER BY b.dice DESC, b.name) AS best_license, max(b.dice) AS best_dice
FROM documents d LEFT JOIN best b ON b.doc_id = d.doc_id GROUP BY d.doc_id"""


# CRC-32 step by step over a word's bytes; ``crc(tab)`` holds the 256 values of the byte table, made by its rule.
_CRC_TABLE = """crc AS MATERIALIZED (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) AS v
    FROM range(256) r(i)))"""
_HEX = "0123456789ABCDEF"


def _crc(x: str) -> str:
    """CRC-32 of the text ``x``; ``tab`` must be in scope."""
    digit = lambda at: f"(instr('{_HEX}', substr(hex(encode({x})), {at}, 1)) - 1)"
    byte = f"list_transform(range(octet_length(encode({x}))), lambda i: (16 * {digit('2 * i::INT + 1')} + {digit('2 * i::INT + 2')})::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {byte}), lambda c, b: xor(tab[1 + xor(c, b) % 256], c >> 8)), 4294967295::BIGINT)"


SQL["op11_resampling"] = f"""WITH {_CRC_TABLE},
said AS (SELECT 0 AS target, row_number() OVER () AS r, doc_id, {_words(_low("coalesce(text, '')"))} AS w FROM documents
         UNION ALL SELECT 1, row_number() OVER (), NULL, {_words(_low("coalesce(text, '')"))} FROM benchmark),
word AS MATERIALIZED (SELECT target, r, unnest(w) AS word FROM said),
known AS MATERIALIZED (SELECT word, {_crc('word')} % 10000 AS bucket FROM (SELECT DISTINCT word FROM word), crc),
counted AS (SELECT bucket, count(*) FILTER (target = 0) AS s, count(*) FILTER (target = 1) AS t FROM word JOIN known USING (word) GROUP BY bucket),
total AS (SELECT sum(s)::DOUBLE + 10000 AS s_all, sum(t)::DOUBLE + 10000 AS t_all FROM counted),
gain AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * s_all / ((s + 1)::DOUBLE * t_all)))::BIGINT AS gain FROM counted, total),
weighed AS (SELECT r, sum(gain)::BIGINT AS weight FROM word JOIN known USING (word) JOIN gain USING (bucket) WHERE target = 0 GROUP BY r),
scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         list_reduce(list_prepend(0::BIGINT, list_transform(range(8), lambda i: (instr('{_HEX.lower()}', substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), i::INT + 1, 1)) - 1)::BIGINT)),
                     lambda a, d: 16 * a + d) AS h
  FROM said LEFT JOIN weighed USING (r) WHERE target = 0),
final AS (SELECT doc_id, n_features, weight, weight + floor(-1000.0::DOUBLE * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id, n_features) AS place,
                  count(*) OVER (PARTITION BY n_features >= 20) AS n FROM final)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM ranked"""


def _field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE octet_length(encode({x}::VARCHAR))::VARCHAR || ':' || {x}::VARCHAR END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


# The trees grow level by level in recursion; the second one over the languages' roots. A proof climbs the same levels.
SQL["op12_merkle"] = f"""WITH RECURSIVE {_CRC_TABLE},
leaf AS MATERIALIZED (
  SELECT doc_id, lang, {_leaf('n_chars')} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {_crc('doc_id::VARCHAR')} % 7 = 0 THEN {_leaf('(n_chars + 1)')} ELSE {_leaf('n_chars')} END AS shown
  FROM documents, crc),
seat AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n,
         row_number() OVER () AS r FROM leaf),
node AS (
  SELECT lang, 0 AS level, pos AS i, n, leaf AS h FROM seat
  UNION ALL
  SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM node WHERE n > 1 GROUP BY lang, level, i // 2, n),
grown AS MATERIALIZED (SELECT * FROM node),
sub AS MATERIALIZED (
  SELECT lang, h, row_number() OVER (ORDER BY (lang IS NOT NULL), encode(lang)) - 1 AS pos, count(*) OVER () AS n FROM grown WHERE n = 1),
over_node AS (
  SELECT 0 AS level, pos AS i, n, h FROM sub
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM over_node WHERE n > 1 GROUP BY level, i // 2, n),
top AS MATERIALIZED (SELECT * FROM over_node),
climb AS (
  SELECT r, lang, 0 AS level, pos AS i, n, shown AS h, '' AS seen FROM seat
  UNION ALL
  SELECT c.r, c.lang, c.level + 1, c.i // 2, (c.n + 1) // 2,
         sha256(CASE WHEN s.h IS NULL THEN c.h WHEN c.i % 2 = 1 THEN s.h || c.h ELSE c.h || s.h END), c.seen || coalesce(s.h, '')
  FROM climb c LEFT JOIN grown s ON s.lang IS NOT DISTINCT FROM c.lang AND s.level = c.level AND s.i = xor(c.i, 1) WHERE c.n > 1),
inner_done AS MATERIALIZED (SELECT * FROM climb WHERE n = 1),
climb_top AS (
  SELECT c.r, 0 AS level, s.pos AS i, s.n, c.h, c.seen FROM inner_done c JOIN sub s ON s.lang IS NOT DISTINCT FROM c.lang
  UNION ALL
  SELECT c.r, c.level + 1, c.i // 2, (c.n + 1) // 2,
         sha256(CASE WHEN s.h IS NULL THEN c.h WHEN c.i % 2 = 1 THEN s.h || c.h ELSE c.h || s.h END), c.seen || coalesce(s.h, '')
  FROM climb_top c LEFT JOIN top s ON s.level = c.level AND s.i = xor(c.i, 1) WHERE c.n > 1)
SELECT doc_id, leaf, sub.h AS subroot, top.h AS root, sha256(c.seen) AS proof_sha256, c.h AS folded_root, c.h = top.h AS verified
FROM seat JOIN climb_top c ON c.r = seat.r AND c.n = 1 JOIN sub ON sub.lang IS NOT DISTINCT FROM seat.lang JOIN top ON top.n = 1"""


def _url_words(x: str, mark: str) -> str:
    return f"list_transform({_words(_low(x))}, lambda w: '{mark}' || CASE WHEN regexp_full_match(w, '[0-9]+') THEN '#' ELSE w END)"


# All token sets of a labelled url are spelled out by the bits of a number; FP-growth finds those that are frequent.
SQL["op13_url_filter"] = f"""WITH page AS (
  SELECT row_number() OVER () AS r, page_id, coalesce(url, '') AS u, {_low("regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)")} AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
list(verdict, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
listed AS (
  SELECT r, max_by(rhost || rpath, length(rhost) + length(rpath)) AS rule, max_by(verdict, length(rhost) + length(rpath)) AS verdict
  FROM page JOIN list ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY r),
token AS MATERIALIZED (
  SELECT r, page_id, host, path, rule, verdict,
         list_distinct({_url_words('host', 'h:')} || {_url_words('path', 'p:')} || {_url_words("regexp_extract(u, '(?s)://[^?#]*[?#](.*)', 1)", 'q:')}) AS ts
  FROM page LEFT JOIN listed USING (r)),
known AS MATERIALIZED (SELECT r, verdict, ts FROM token WHERE verdict IS NOT NULL),
total AS (SELECT count(*) AS n, count(*) FILTER (verdict = 'block') AS b FROM known),
seen AS (SELECT t, count(*)::DOUBLE AS c, count(*) FILTER (verdict = 'block')::DOUBLE AS b FROM (SELECT unnest(ts) AS t, verdict FROM known) GROUP BY t),
worth AS (
  SELECT t, c, (seen.b * n - c * total.b) AS off, (c * (n - c) * greatest(total.b, 1) * greatest(n - total.b, 1)) AS spread
  FROM seen, total WHERE c >= {urlrules.SUPPORT}::DOUBLE * n),
telling AS (
  SELECT t, row_number() OVER (ORDER BY round(CASE WHEN spread > 0 THEN off * off / spread ELSE 0 END, 9) DESC, c DESC, t) AS place
  FROM worth ORDER BY place LIMIT {urlrules.VOCABULARY}),
basket AS MATERIALIZED (
  SELECT r, verdict, list_sort(list(t ORDER BY place)[1:{urlrules.WIDTH}]) AS items
  FROM (SELECT r, verdict, unnest(ts) AS t FROM known) JOIN telling USING (t) GROUP BY r, verdict),
part AS (SELECT r, verdict, items, unnest(range(1, (1 << len(items))::BIGINT)) AS bits FROM basket),
itemset AS MATERIALIZED (
  SELECT tokens, verdict, count(*) AS n FROM (
    SELECT list_filter(items, lambda x, i: (bits >> (i - 1)::BIGINT) % 2 = 1) AS tokens, verdict FROM part) GROUP BY tokens, verdict),
rule AS MATERIALIZED (
  SELECT tokens, verdict, conf, row_number() OVER (ORDER BY conf DESC, support DESC, len(tokens), tokens, verdict) AS place FROM (
    SELECT tokens, verdict, i.n::DOUBLE / sum(i.n) OVER (PARTITION BY tokens) AS conf, i.n::DOUBLE / total.n AS support, i.n, total.n AS whole FROM itemset i, total)
  WHERE n >= ceil({urlrules.SUPPORT}::DOUBLE * whole) AND conf >= {urlrules.CONFIDENCE}::DOUBLE),
kind AS (SELECT DISTINCT ts FROM token WHERE rule IS NULL),
best AS (SELECT ts, min(place) AS place FROM kind JOIN rule ON list_has_all(ts, tokens) WHERE place <= {urlrules.RULES} GROUP BY ts)
SELECT page_id, host, path, token.rule, coalesce(token.verdict, rule.verdict, 'allow') AS verdict,
       CASE WHEN token.rule IS NULL THEN array_to_string(rule.tokens, ',') END AS mined
FROM token LEFT JOIN best ON token.rule IS NULL AND best.ts = token.ts LEFT JOIN rule USING (place)"""
