"""DuckDB counterparts of the queries that SQL can express."""

from padron.llm import line_dedup, mixing

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(table: str, key: str) -> str:
    """Lists of words; only A-Z are lower-cased, so other letters keep their case."""
    return f"""(SELECT {key}, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '{_SEPARATORS}'), lambda x: x <> '') AS words FROM {table})"""


OP1 = f"""
WITH doc AS MATERIALIZED {_words("documents", "doc_id")},
item AS MATERIALIZED (
  SELECT *, len(words) AS n, least(10, len(words)) AS width
  FROM {_words("benchmark", "item_id")} WHERE len(words) > 0),
widths AS (SELECT DISTINCT width FROM item),
item_windows AS MATERIALIZED (
  SELECT DISTINCT item_id, width, array_to_string(words[o + 1:o + width], ' ') AS w
  FROM item, unnest(range(0, n - width + 1)) AS u(o)),
doc_windows AS (
  SELECT doc_id, width, o, array_to_string(words[o + 1:o + width], ' ') AS w
  FROM doc, widths, unnest(range(0, len(words) - width + 1)) AS u(o)
  WHERE len(words) >= width),
hits AS MATERIALIZED (
  SELECT doc_id, item_id, o, d.width FROM doc_windows d JOIN item_windows i USING (width, w)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM hits, unnest(range(o, o + width)) AS u(p) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items,
         sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id),
doc_terms AS MATERIALIZED (
  SELECT doc_id, pos, word FROM (
    SELECT doc_id, unnest(words) AS word, unnest(range(0, len(words))) AS pos FROM doc)
  SEMI JOIN (SELECT DISTINCT unnest(words) AS word FROM item) USING (word)),
frequency AS (SELECT word, count(*) AS df FROM doc_terms GROUP BY word),
rare AS MATERIALIZED (
  SELECT item_id, word FROM (
    SELECT item_id, word, row_number() OVER (
             PARTITION BY item_id ORDER BY coalesce(df, 0), word) AS r,
           count(*) OVER (PARTITION BY item_id) AS kinds
    FROM (SELECT DISTINCT item_id, unnest(words) AS word FROM item)
    LEFT JOIN frequency USING (word))
  WHERE r <= 4 AND kinds >= 4),
postings AS MATERIALIZED (
  SELECT doc_id, item_id, word, pos FROM doc_terms JOIN rare USING (word)),
near AS (
  SELECT doc_id, count(*) AS n_near FROM (
    SELECT DISTINCT doc_id, item_id FROM (
      SELECT a.doc_id, a.item_id, a.pos, count(DISTINCT b.word) AS kinds
      FROM postings a JOIN postings b ON a.doc_id = b.doc_id AND a.item_id = b.item_id
        AND b.pos BETWEEN a.pos AND a.pos + 19
      GROUP BY a.doc_id, a.item_id, a.pos) WHERE kinds = 4)
  GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM doc LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
LEFT JOIN near USING (doc_id)
"""


def _replaced(expression: str) -> str:
    for entity, char in line_dedup.ENTITIES.items():
        expression = f"replace({expression}, '{entity}', '{char}')"
    return expression


# The lines of a page: RE2 has no back-references, so script and style are dropped one by one.
_VISIBLE = "coalesce(html, '')"
for _pattern in (r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->",):
    _VISIBLE = f"regexp_replace({_VISIBLE}, '{_pattern}', '', 'g')"
_BROKEN = f"regexp_replace({_VISIBLE}, '{line_dedup.BREAKS}', chr(10), 'g')"
_PLAIN = _replaced(f"regexp_replace({_BROKEN}, '{line_dedup.TAGS}', '', 'g')")

OP2 = f"""
WITH page AS MATERIALIZED (
  SELECT page_id, row_number() OVER () AS k,
         lower(regexp_extract(coalesce(url, ''),
           '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         list_filter(list_transform(string_split(
           regexp_replace({_PLAIN}, '[ \\t\\r\\f\\x0B]+', ' ', 'g'), chr(10)),
           lambda x: trim(x, ' ')), lambda x: x <> '') AS lines
  FROM pages),
totals AS (SELECT host, count(*) AS pages FROM page GROUP BY host),
common AS (
  SELECT host, list(line) AS common FROM (
    SELECT host, line, count(*) AS holding
    FROM (SELECT k, host, unnest(list_distinct(lines)) AS line FROM page)
    GROUP BY host, line) JOIN totals USING (host)
  WHERE holding > 1 AND pages >= 5 AND holding > pages * 0.25 GROUP BY host)
SELECT page_id, host, len(lines)::BIGINT AS n_lines,
       (len(lines) - len(kept))::BIGINT AS n_dropped,
       md5(coalesce(array_to_string(kept, chr(10)), '')) AS text_md5
FROM (SELECT *, list_filter(lines, lambda x: NOT list_contains(coalesce(common, []), x)) AS kept
      FROM page LEFT JOIN common USING (host))
"""

# One period is a recursion over its slots; each step gives the slot to the released block with
# the earliest deadline.
_D = mixing.RESOLUTION
OP5 = f"""
WITH RECURSIVE ranked AS MATERIALIZED (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS key,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS rank
  FROM documents),
weights AS (
  SELECT key, sqrt(count(*)::DOUBLE) AS weight FROM ranked GROUP BY key),
ideal AS (
  SELECT key, weight / sum(weight) OVER () * ({_D} - count(*) OVER ()) AS ideal,
         {_D} - count(*) OVER () AS free FROM weights),
shares AS MATERIALIZED (
  SELECT key, (1 + floor(ideal) + CASE WHEN row_number() OVER (
           ORDER BY ideal - floor(ideal) DESC, key) <= free - sum(floor(ideal)) OVER ()
         THEN 1 ELSE 0 END)::BIGINT AS parts FROM ideal),
listed AS MATERIALIZED (
  SELECT list(key ORDER BY key) AS keys, list(parts ORDER BY key) AS parts FROM shares),
steps AS (
  SELECT -1::BIGINT AS slot, list_transform(parts, lambda p: 0::BIGINT) AS used, 0::BIGINT AS chosen
  FROM listed
  UNION ALL
  SELECT slot, list_transform(used, lambda u, i: CASE WHEN i = chosen THEN u + 1 ELSE u END), chosen
  FROM (SELECT slot, used, list_position(due, list_min(due)) AS chosen
    FROM (SELECT s.slot + 1 AS slot, used, list_transform(used, lambda u, i:
            CASE WHEN (u * {_D}) // parts[i] > s.slot + 1 THEN 1000000000
                 ELSE ((u + 1) * {_D} + parts[i] - 1) // parts[i] END) AS due
          FROM steps s, listed WHERE s.slot < {_D} - 1))),
period AS MATERIALIZED (
  SELECT slot, keys[chosen] AS key,
         row_number() OVER (PARTITION BY chosen ORDER BY slot) - 1 AS turn
  FROM steps, listed WHERE slot >= 0)
SELECT doc_id, source, s.parts, rank // {mixing.BLOCK} AS block,
       (rank // {mixing.BLOCK}) // s.parts * {_D} + slot AS slot, rank % {mixing.BLOCK} AS place
FROM ranked r JOIN shares s USING (key)
JOIN period p ON p.key = r.key AND p.turn = (rank // {mixing.BLOCK}) % s.parts
"""

OP11 = r"""
WITH tokens AS (
  SELECT d, lang, source, unnest(list_filter(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term
  FROM (SELECT row_number() OVER () AS d, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
               coalesce(source, '') AS source FROM documents)),
counts AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT d) AS docs FROM tokens GROUP BY ALL),
kept AS MATERIALIZED (
  SELECT lang, term, sum(n)::HUGEINT AS n FROM counts GROUP BY ALL HAVING sum(docs) >= 10),
sizes AS MATERIALIZED (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang),
groups AS MATERIALIZED (
  SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
cells AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.n AS all_n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c
    ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS MATERIALIZED (
  SELECT c.lang, c.source, c.term, c.n,
         1 + (1000000000 * (c.n + 2)) // (sum(c.n) OVER (PARTITION BY c.lang, c.source) + 2 * s.v) AS p,
         1 + (1000000000 * (c.all_n + 2)) // (s.n + 2 * s.v) AS q
  FROM cells c JOIN sizes s USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(v, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang AS l, x.source AS s, y.source AS t,
           sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS v
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY ALL) ON l = a.lang AND s = a.source AND t = b.source),
terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (
    PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (
    PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms)
WHERE part = 'pair' OR rank <= 10
"""

OP13 = r"""
WITH doc AS MATERIALIZED (
  SELECT row_number() OVER () AS d, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS terms FROM documents),
item AS MATERIALIZED (
  SELECT DISTINCT i, item_id, unnest(list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)),
size AS MATERIALIZED (
  SELECT count(*)::HUGEINT AS n, sum(len(terms))::HUGEINT AS l FROM doc WHERE len(terms) > 0),
posting AS MATERIALIZED (
  SELECT d, doc_id, term, count(*) AS tf, any_value(n) AS n FROM (
    SELECT d, doc_id, len(terms) AS n, unnest(terms) AS term FROM doc)
  SEMI JOIN item USING (term) GROUP BY d, doc_id, term),
impact AS (
  SELECT d, doc_id, term,
         (1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * p.n * s.n) // s.l)) AS impact
  FROM posting p, size s),
weight AS (
  SELECT term, floor(1000 * ln((2 * any_value(s.n) + 2)::DOUBLE / (2 * count(*) + 1)))::HUGEINT AS w
  FROM posting, size s GROUP BY term),
scored AS (
  SELECT i, item_id, d, doc_id, sum(w * impact) AS score
  FROM item JOIN weight USING (term) JOIN impact USING (term) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, d) AS rank
  FROM scored WHERE score > 0) WHERE rank <= 50
"""

ORACLE_SQL = {"op1_decontamination": OP1, "op2_line_dedup": OP2, "op5_mixing": OP5,
              "op11_source_divergence": OP11, "op13_lexical_search": OP13}
