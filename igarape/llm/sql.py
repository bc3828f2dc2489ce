"""DuckDB SQL that states the results of queries of this folder."""

from igarape.llm.quality_rules import STOP_WORDS

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH lines AS (
    SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
    SELECT *, translate(trim(line, {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), common AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
    SELECT doc_id, i, line, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN common USING (key)
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

QUALITY_RULES = f"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS t,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), windows AS (
    SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS three
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM docs WHERE len(w) >= 3)
), counted AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, three) AS n FROM windows
), covered AS (
    SELECT doc_id, count(DISTINCT i + step) AS n_repeat_words
    FROM counted, (VALUES (0), (1), (2)) AS s (step) WHERE n >= 2 GROUP BY doc_id
), lines AS (
    SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs)
    WHERE trim(line, {_WHITE}) <> '' GROUP BY doc_id
), measured AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(length(t) - length(regexp_replace(t, '[!?~^=_{{}}\\[\\]\\\\]', '', 'g')) AS BIGINT) AS n_marks,
           len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop,
           coalesce(n_lines, 0) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
    FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 20 * n_words
       AND CAST(n_symbols AS DOUBLE) <= CAST(0.1 AS DOUBLE) * n_words
       AND CAST(n_marks AS DOUBLE) <= CAST(0.3 AS DOUBLE) * n_words
       AND CAST(n_stop AS DOUBLE) >= CAST(0.02 AS DOUBLE) * n_words
       AND CAST(n_dup_lines AS DOUBLE) <= CAST(0.6 AS DOUBLE) * n_lines AS kept
FROM judged
"""

WARC = """
WITH docs AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), first AS (
    SELECT hex, min(page_id) AS low FROM docs GROUP BY hex
), fives AS (
    SELECT hex, low, list_transform(range(0, 8), lambda i: CAST('0x' || substr(hex, 5 * i + 1, 5) AS BIGINT)) AS v FROM first
), named AS (
    SELECT hex, low, array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((v[j // 4 + 1] >> (15 - 5 * (j % 4))) & 31 AS INTEGER) + 1, 1)), '') AS digest FROM fives
)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = low THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> low THEN low END AS refers_to
FROM docs JOIN named USING (hex)
"""


_KINDS = (
    (
        "assign",
        "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
        "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?[A-Za-z0-9+/_.=-]+",
        "[A-Za-z0-9+/_.=-]{12}$",
    ),
    ("access", "AKIA[A-Z0-9]+", "^.{18}"),
    ("hex", "[0-9a-f]+", "^.{16}"),
    ("private_key", "-----BEGIN (RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY-----+", "."),
    ("github", "gh[pousr]_[A-Za-z0-9]+", "^.{40}"),
)


def _spans(number: int, kind: str, pattern: str, enough: str) -> str:
    """Rows (doc_id, kind, a, b): the pattern's matches with their text before, added up to places."""
    return f"""
    SELECT doc_id, {number} AS number, '{kind}' AS kind, a, b FROM (
        SELECT doc_id, hit, i, sum(length(gap) + length(hit)) OVER w - length(hit) AS a, sum(length(gap) + length(hit)) OVER w AS b
        FROM (
            SELECT doc_id, unnest(gaps) AS gap, unnest(hits) AS hit, generate_subscripts(hits, 1) AS i FROM (
                SELECT doc_id, regexp_extract_all(t, '(?s)(.*?)({pattern})', 1) AS gaps,
                       regexp_extract_all(t, '(?s)(.*?)({pattern})', 2) AS hits FROM docs
            )
        ) WINDOW w AS (PARTITION BY doc_id ORDER BY i)
    ) WHERE regexp_matches(hit, '{enough}')"""


SECRETS = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(_spans(i, *x) for i, x in enumerate(_KINDS))}
), told AS (
    SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k, _, _ in _KINDS)},
           string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(b AS BIGINT), ',' ORDER BY a, number) AS spans,
           string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(b AS BIGINT), ',' ORDER BY a, number)
               FILTER (WHERE number < 3) AS base
    FROM spans GROUP BY doc_id
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k, _, _ in _KINDS)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN told USING (doc_id)
"""


SOURCE_AUDIT = """
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t
    FROM documents
), words AS (
    SELECT r, lang, source, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS w FROM docs)
), kept AS (
    SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), counted AS (
    SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), langs AS (
    SELECT lang, sum(lang_n) AS lang_total, count(*) AS v FROM kept GROUP BY lang
), sources AS (
    SELECT lang, source, coalesce(total, 0) AS total
    FROM (SELECT DISTINCT lang, source FROM docs)
    LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counted GROUP BY lang, source) USING (lang, source)
), shares AS (
    SELECT lang, source, term, coalesce(n, 0) AS n,
           1 + CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 1) // (total + v) AS p,
           1 + CAST(1000000000 AS HUGEINT) * (lang_n + 1) // (lang_total + v) AS q
    FROM sources JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN counted USING (lang, source, term)
), gaps AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source
), terms AS (
    SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
) WHERE part = 'pair' OR rank <= 200
"""
