"""DuckDB SQL for the corpus queries that SQL can express, over whole tables."""

from __future__ import annotations

from .quality import GRAM_LIMITS, LINE_LIMIT, SYMBOL_LIMIT

_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Smallest id reachable over the links (a, b), both directions listed, for every id that has one.
_REACHED = """reached AS (SELECT a AS id, b AS other FROM links UNION SELECT r.id, l.b FROM reached r JOIN links l ON l.a = r.other),
lowest AS (SELECT id, least(id, min(other)) AS component FROM reached GROUP BY id)"""

JACCARD = f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
      FROM w, range(1, greatest(len(w) - 3, 2)) t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
sets AS (SELECT doc_id, md5(string_agg(s, '|' ORDER BY s)) AS k FROM s GROUP BY doc_id),
firsts AS (SELECT k, min(doc_id) AS rep FROM sets GROUP BY k),
r AS (SELECT s.* FROM s JOIN firsts f ON f.rep = s.doc_id),
met AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM r x JOIN r y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
near AS (SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
links AS (SELECT a, b FROM near UNION SELECT b, a FROM near),
{_REACHED}
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(lowest.component, f.rep, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN sets USING (doc_id) LEFT JOIN firsts f ON f.k = sets.k
LEFT JOIN lowest ON lowest.id = f.rep"""


def _covered(n: int) -> str:
    return f"""g{n} AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c
       FROM (SELECT doc_id, i AS p, array_to_string(w[i:i + {n - 1}], ' ') AS g FROM w, range(1, len(w) - {n - 2}) t(i))) WHERE c > 1),
c{n} AS (SELECT doc_id, count(*) AS words, sum(chars) AS chars FROM
       (SELECT DISTINCT doc_id, p + j AS p FROM g{n}, range({n}) u(j)) JOIN words USING (doc_id, p) GROUP BY doc_id)"""


QUALITY = rf"""WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format("text")} AS w FROM documents),
words AS (SELECT doc_id, i AS p, length(w[i]) AS chars FROM w, range(1, len(w) + 1) t(i)),
base AS (SELECT w.doc_id, len(w) AS n_words, coalesce((SELECT sum(chars) FROM words WHERE words.doc_id = w.doc_id), 0) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols FROM w),
split AS (SELECT doc_id, i, lines[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM w), range(1, len(lines) + 1) t(i)),
ranked AS (SELECT doc_id, list_sum(list_transform({_WORDS.format("line")}, lambda x: length(x))) AS chars,
         row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS k FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
later AS (SELECT doc_id, count(*) AS n, sum(chars) AS chars FROM ranked WHERE k > 1 GROUP BY doc_id),
{', '.join(_covered(n) for n in sorted({5, *GRAM_LIMITS}))},
joined AS (SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, coalesce(later.n, 0) AS n_dup_lines,
         coalesce(c5.words, 0) AS n_repeat_words, greatest(word_chars, 1) AS whole, coalesce(later.chars, 0) AS line_chars,
         {', '.join(f'coalesce(c{n}.chars, 0) AS chars{n}' for n in GRAM_LIMITS)}
         FROM base LEFT JOIN later USING (doc_id) {' '.join(f'LEFT JOIN c{n} USING (doc_id)' for n in sorted({5, *GRAM_LIMITS}))}),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM joined)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_symbols <= {SYMBOL_LIMIT} * n_words AND line_chars::DOUBLE / whole / {LINE_LIMIT}::DOUBLE <= 1
       {' '.join(f'AND chars{n}::DOUBLE / whole / {limit}::DOUBLE <= 1' for n, limit in GRAM_LIMITS.items())} AS kept
FROM judged"""

LATTICE = f"""WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
usable AS (SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND list_bool_and(list_transform(e, lambda x: x IS NOT NULL AND isfinite(x)))
           AND list_bool_or(list_transform(e, lambda x: x <> 0))),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON len(x.e) = len(y.e) AND x.vec_id <> y.vec_id
          WHERE list_cosine_similarity(x.e, y.e) >= 0.95),
{_REACHED},
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, coalesce(lowest.component, v.vec_id) AS component_id,
       coalesce(lowest.component, v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN n USING (vec_id) LEFT JOIN lowest ON lowest.id = v.vec_id"""

FILTER_AUDIT = r"""WITH letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY text) AS lowest FROM d),
m AS (SELECT doc_id, part, (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
        + 4 * (100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text))::INT
        + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce((lowest < doc_id)::INT, 0) AS mask FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
cells AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
          FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
orders AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
           FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
           AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (SELECT filter_order, CAST(i AS INTEGER) AS step, bits[i] AS bit, CAST(coalesce(list_sum(bits[1:i - 1]), 0) AS INTEGER) AS before
          FROM orders, range(1, 6) t(i)),
metrics AS (SELECT part, filter_order, step, bit, sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
            sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
            sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
            sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
            sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
            sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
            FROM cells, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM metrics"""
