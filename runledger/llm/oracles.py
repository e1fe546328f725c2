"""DuckDB SQL for the queries that it can express."""

from __future__ import annotations

from runledger.llm import line_quality as lq

_HOST = r"regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1)"
_RULES = """
    (VALUES ('org', '/', 'org/', 'allow'), ('example.org', '/es/', 'example.org/es/', 'block'),
            ('example.org', '/en/1', 'example.org/en/1', 'block'), ('com', '/fr/', 'com/fr/', 'allow'),
            ('com', '/de/', 'com/de/', 'block')) AS r(rule_host, rule_path, pattern, verdict)
"""

URLS = rf"""
WITH parts AS (
    SELECT page_id, row_number() OVER () AS nr,
           coalesce(translate({_HOST}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages),
best AS (
    SELECT nr, arg_max(pattern, length(pattern)) AS rule, arg_max(verdict, length(pattern)) AS verdict
    FROM parts JOIN {_RULES} ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY nr)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (nr)
"""


def _q(pattern: str) -> str:
    return pattern.replace("'", "''")


_WORD = r"[^\x20\x09-\x0D]+"

QUALITY = rf"""
WITH docs AS (SELECT row_number() OVER () AS nr, doc_id, coalesce(text, '') AS body FROM documents),
words AS (
    SELECT nr, unnest(regexp_extract_all(body, '{_WORD}')) AS w, generate_subscripts(regexp_extract_all(body, '{_WORD}'), 1) AS i
    FROM docs),
word_counts AS (SELECT nr, count(*) AS n_words, sum(length(w)) AS word_chars FROM words GROUP BY nr),
grams AS (
    SELECT nr, i, [w, lead(w, 1) OVER p, lead(w, 2) OVER p, lead(w, 3) OVER p, lead(w, 4) OVER p] AS g, lead(i, 4) OVER p AS e
    FROM words WINDOW p AS (PARTITION BY nr ORDER BY i)),
twice AS (SELECT nr, i, count(*) OVER (PARTITION BY nr, g) AS n FROM grams WHERE e IS NOT NULL),
repeats AS (SELECT nr, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(5) AS r(k) WHERE n > 1 GROUP BY nr),
lines AS (SELECT nr, unnest(string_split(body, chr(10))) AS line FROM docs),
full_lines AS (SELECT * FROM lines WHERE regexp_matches(line, '{_WORD}')),
judged AS (
    SELECT nr, line,
        NOT regexp_matches(line, '{_q(lq.ENDS_WELL)}')
        OR len(regexp_extract_all(line, '{_q(lq.SHOUTS)}')) >= {lq.MAX_SHOUTS}
        OR (len(regexp_extract_all(line, '{_q(lq.SYMBOL)}')) >= {lq.MIN_SYMBOLS}
            AND 5 * len(regexp_extract_all(line, '{_q(lq.SYMBOL)}')) > {lq.SYMBOLS_PER_5_WORDS} * len(regexp_extract_all(line, '{_WORD}')))
        OR len(regexp_extract_all(line, '{_q(lq.SEPARATOR)}')) >= {lq.MIN_SEPARATORS}
        OR regexp_matches(line, '{_q(lq.NAVIGATION)}') OR regexp_matches(line, '{_q(lq.BOILERPLATE)}') AS fails
    FROM full_lines),
line_counts AS (
    SELECT nr, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (fails) AS n_bad_lines,
           sum(length(line)) AS chars, coalesce(sum(length(line)) FILTER (fails), 0) AS lost_chars
    FROM judged GROUP BY nr),
figures AS (
    SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
           len(regexp_extract_all(body, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines,
           coalesce(n_bad_lines, 0)::BIGINT AS n_bad_lines, coalesce(chars, 0)::BIGINT AS chars,
           coalesce(lost_chars, 0)::BIGINT AS lost_chars
    FROM docs LEFT JOIN word_counts USING (nr) LEFT JOIN repeats USING (nr) LEFT JOIN line_counts USING (nr))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * lost_chars <= {lq.MAX_LOST_PERCENT} * chars AS kept
FROM figures
"""

COPIES = """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
groups AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM docs GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM docs JOIN groups USING (body)
"""

# Every source against every other over all kept terms, without any short cut.
DIVERGENCE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS nr, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
    FROM documents),
tokens AS (
    SELECT nr, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM tokens GROUP BY ALL),
kept AS (SELECT lang, term FROM tokens GROUP BY ALL HAVING count(DISTINCT nr) >= 10),
vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
pairs AS (SELECT DISTINCT lang, source FROM docs),
dense AS (
    SELECT lang, source, term, coalesce(n, 0) AS n
    FROM pairs JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
of_group AS (
    SELECT lang, source, term, n,
           1 + (1000000000 * (n + 2)::HUGEINT) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v)::HUGEINT AS p
    FROM dense JOIN vocabulary USING (lang)),
of_lang AS (
    SELECT lang, term, 1 + (1000000000 * (n + 2)::HUGEINT) // (sum(n) OVER (PARTITION BY lang) + 2 * v)::HUGEINT AS q
    FROM (SELECT lang, term, sum(n) AS n FROM dense GROUP BY ALL) JOIN vocabulary USING (lang)),
apart AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM of_group a JOIN of_group b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM pairs a JOIN pairs b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT
    FROM of_group JOIN of_lang USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""

PHRASES = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
numbered AS (SELECT lang, row_number() OVER () AS nr, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
words AS (SELECT lang, nr, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM numbered),
runs AS (
    SELECT lang, w AS w1, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3, lead(w, 3) OVER p AS w4
    FROM words WINDOW p AS (PARTITION BY nr ORDER BY i)),
grams AS (
    SELECT lang, [w1] AS g FROM runs
    UNION ALL SELECT lang, [w1, w2] FROM runs WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, [w1, w2, w3] FROM runs WHERE w3 IS NOT NULL
    UNION ALL SELECT lang, [w1, w2, w3, w4] FROM runs WHERE w4 IS NOT NULL),
f AS (SELECT lang, g, count(*) AS n FROM grams GROUP BY ALL HAVING count(*) >= 30),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY ALL),
cuts AS (
    SELECT lang, g, n AS a, k, array_to_string(g[1:k], ' ') AS head, array_to_string(g[k + 1:len(g)], ' ') AS tail
    FROM f, range(1, 4) AS t(k) WHERE k < len(g)),
named AS (SELECT lang, array_to_string(g, ' ') AS phrase, n FROM f),
scored AS (
    SELECT c.lang, g, a, k, x.n AS l, y.n AS r, ((2000000 * a::HUGEINT) // (x.n + y.n)::HUGEINT)::BIGINT AS score
    FROM cuts c JOIN named x ON x.lang = c.lang AND x.phrase = head JOIN named y ON y.lang = c.lang AND y.phrase = tail),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS nr FROM scored),
inner_runs AS (
    SELECT lang, n, g[i:i + m - 1] AS g FROM f, range(2, 4) AS t(m), range(1, 4) AS s(i) WHERE m < len(g) AND i + m - 1 <= len(g)),
longer AS (SELECT lang, g, max(n) AS longest FROM inner_runs GROUP BY ALL),
kept AS (
    SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score
    FROM lowest LEFT JOIN longer USING (lang, g) WHERE nr = 1 AND (longest IS NULL OR 100 * longest < 80 * a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES = {
    "op1_url_filter": URLS, "op6_line_quality": QUALITY, "op11_exact_dedup": COPIES, "op12_source_divergence": DIVERGENCE,
    "op13_collocations": PHRASES,
}
