"""The registered queries of the text operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import (
    ann, exact_dedup, filter_audit, licenses, mixing, ngram_join, packing, quality, repetition, token_counts, url_filter, warc, whitening,
)
from basketry.llm.common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).drop("version")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(table(spark, sf_dir, "pages"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("version")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_licenses,
        op3_packing,
        op4_ngram_join,
        op5_url_filter,
        op6_nearest,
        op7_mixing,
        op8_quality,
        op9_warc,
        op10_exact_dedup,
        op11_whitening,
        op12_repetition,
        op13_filter_audit,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _license_sql() -> str:
    """The scan over the whole table: k-grams joined by their words; spans with few
    of them by the longest common subsequence of the words around a diagonal."""
    k = licenses.K
    grams = []
    for exact, entries in ((True, licenses.PHRASES), (False, licenses.TEMPLATES)):
        for label, text in entries:
            w = text.split()
            n = len(w) - k + 1
            grams += [f"('{label}', {exact}, {n}, {i}, '{' '.join(w[i : i + k])}')" for i in range(n)]
    wordings = ", ".join(f"('{label}', string_split('{text}', ' '))" for label, text in licenses.TEMPLATES)
    shift = licenses.MAX_SHIFT
    # one row of the table of common subsequences from the one before: per word of
    # the text the list of template words that equal it
    longest = """list_reduce(list_transform(near, lambda x: list_transform(t, lambda y: (x = y)::INTEGER)),
        lambda upper, same: list_reduce(list_transform(range(1, len(t) + 1), lambda j: [j::INTEGER]),
            lambda done, j: list_append(done, greatest(done[len(done)], upper[j[1] + 1], upper[j[1]] + same[j[1]])), [0]),
        list_transform(range(len(t) + 1), lambda j: 0))"""
    return rf"""
WITH words AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), templates(label, whole, n, tpos, gram) AS (
    VALUES {", ".join(grams)}
), texts AS (
    SELECT doc_id, pos, array_to_string(w[pos + 1:pos + {k}], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(len(w) - {k - 1})) AS pos FROM words)
), diagonals AS (
    SELECT doc_id, label, whole, n, pos - tpos AS d, list(DISTINCT tpos) AS hits FROM texts JOIN templates USING (gram) GROUP BY ALL
), steps AS (
    SELECT *, CASE WHEN d - lag(d) OVER (PARTITION BY doc_id, label ORDER BY d) <= {licenses.MAX_SHIFT} THEN 0 ELSE 1 END AS fresh
    FROM diagonals WHERE NOT whole
), merged AS (
    SELECT *, sum(fresh) OVER (PARTITION BY doc_id, label ORDER BY d) AS span FROM steps
), similar_spans AS (
    SELECT doc_id, label, len(list_distinct(flatten(list(hits)))) / n AS score, list(d) AS ds FROM merged GROUP BY doc_id, label, n, span
), wordings(label, t) AS (
    VALUES {wordings}
), around AS (
    SELECT doc_id, label, t, w[greatest(d - {shift}, 0) + 1:d + len(t) + {shift}] AS near
    FROM (SELECT doc_id, label, unnest(ds) AS d FROM similar_spans WHERE score < {licenses.MIN_SCORE}) JOIN wordings USING (label) JOIN words USING (doc_id)
    WHERE d + len(t) + {shift} > 0
), edited AS (
    SELECT doc_id, label, list_max({longest}) / len(t) AS score FROM around
), found AS (
    SELECT doc_id, label, 1.0 AS score, d AS first FROM diagonals WHERE whole AND len(hits) = n
    UNION ALL SELECT doc_id, label, score, NULL FROM similar_spans WHERE score >= {licenses.MIN_SCORE}
    UNION ALL SELECT doc_id, label, score, NULL FROM edited WHERE score >= {licenses.MIN_SCORE}
), summed AS (
    SELECT doc_id, count(first) AS n_base, min(first) AS first_word, max(first) AS last_word, max(score) AS score,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (first IS NOT NULL) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM found GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM words LEFT JOIN summed USING (doc_id)
"""


OP4_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(LOWERED,
                                      '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
    FROM words WHERE len(w) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)
), ends AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM words UNION SELECT reach.a, ends.b FROM reach JOIN ends ON ends.a = reach.b
)
SELECT words.doc_id, coalesce(n, 0) AS n_shingles, (SELECT min(b) FROM reach WHERE reach.a = words.doc_id) AS component_id
FROM words LEFT JOIN sizes USING (doc_id)
""".replace("LOWERED", _LOWER)


def _url_sql() -> str:
    """Rules, host graph and both rankings; one step of a ranking is one subquery."""
    host = r"translate(regexp_extract(coalesce({0}, ''), '^[\s\S]*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    path = r"regexp_extract(coalesce(url, ''), '^[\s\S]*?://[^/?#]*([^?#]*)', 1)"
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_filter.RULES)
    parts = [
        f"rules(kind, h, p) AS (VALUES {rules})",
        f"named AS (SELECT row_number() OVER () AS id, page_id, html, {host.format('url')} AS host, {path} AS path FROM pages)",
        "fitting AS (SELECT id, arg_max(kind, length(h || p)) AS by_rule, arg_max(h || p, length(h || p)) AS rule FROM named, rules "
        "WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY id)",
        "seen AS (SELECT * FROM named LEFT JOIN fitting USING (id))",
        "hosts AS (SELECT host, count(*) FILTER (by_rule = 'allow') AS allow, count(*) FILTER (by_rule = 'block') AS block, count(*) AS pages "
        "FROM seen WHERE host <> '' GROUP BY host)",
        "links AS (SELECT host AS src, " + host.format("link") + " AS dst FROM (SELECT DISTINCT id, host, unnest(regexp_extract_all(html, "
        + "'" + url_filter._LINK.replace("'", "''") + "', 1)) AS link FROM seen WHERE host <> ''))",
        f"names AS (SELECT string_split(host, '.') AS l, pages FROM hosts WHERE octet_length(encode(host)) <= {url_filter.MAX_NAME})",
        "up AS (SELECT array_to_string(l[i:], '.') AS src, array_to_string(l[i + 1:], '.') AS dst, pages AS weight "
        "FROM (SELECT l, pages, unnest(range(1, len(l) - 1)) AS i FROM names))",
        "edges AS (SELECT src, dst, sum(weight)::DOUBLE AS weight FROM (SELECT src, dst, 1 AS weight FROM links WHERE dst <> src UNION ALL "
        "SELECT src, dst, weight FROM up UNION ALL SELECT dst, src, weight FROM up) WHERE src <> '' AND dst <> '' GROUP BY src, dst)",
    ]
    for name, kind, a, b in (("trust", "allow", "src", "dst"), ("distrust", "block", "dst", "src")):
        # what a seed sends out arrives along all walks; beyond 150 steps nothing that shows is left
        parts += [
            f"{name}_moves AS (SELECT {a} AS src, {b} AS dst, weight / sum(weight) OVER (PARTITION BY {a}) * {url_filter.DAMPING} AS share FROM edges)",
            f"{name}_walks(step, host, mass) AS (SELECT 0, host, {1 - url_filter.DAMPING} * {kind} / sum({kind}) OVER () FROM hosts WHERE {kind} > 0 "
            f"UNION ALL SELECT step + 1, dst, sum(share * mass) FROM {name}_walks JOIN {name}_moves ON src = host WHERE step < 150 GROUP BY step, dst)",
            f"{name} AS (SELECT host, sum(mass) AS score FROM {name}_walks GROUP BY host)",
        ]
    parts.append(
        "judged AS (SELECT hosts.host, coalesce(t.score, 0) AS trust, coalesce(d.score, 0) AS distrust FROM hosts "
        "LEFT JOIN trust t ON t.host = hosts.host LEFT JOIN distrust d ON d.host = hosts.host)"
    )
    share = f"round(distrust / (distrust + trust), {url_filter.DIGITS})"
    return (
        "WITH RECURSIVE " + ",\n".join(parts) + "\nSELECT page_id, seen.host, path, rule, coalesce(by_rule, CASE WHEN distrust > 0 AND "
        f"{share} >= {url_filter.BLOCK_SHARE} THEN 'block' ELSE 'allow' END) AS verdict FROM seen LEFT JOIN judged ON judged.host = seen.host"
    )


OP10_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
    SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm
"""

OP9_SQL = r"""
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), d AS (
    SELECT page_id, octet_length(body) AS n, sha256(body) AS digest FROM p
), f AS (
    SELECT digest, min(page_id) AS first_id FROM d WHERE n >= 100 GROUP BY digest
)
SELECT d.page_id, d.n AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN f.first_id IS NULL OR f.first_id IS NOT DISTINCT FROM d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first_id IS DISTINCT FROM d.page_id THEN f.first_id END AS refers_to
FROM d LEFT JOIN f ON f.digest = d.digest AND d.n >= 100
"""


def _repetition_sql() -> str:
    """All windows of every length by their words; a word is covered if any repeated window holds it."""
    lengths = sorted(repetition.LIMITS)
    windows = "\nUNION ALL ".join(
        f"SELECT id, {n} AS n, pos, array_to_string(w[pos:pos + {n - 1}], ' ') AS gram FROM (SELECT id, w, unnest(range(1, len(w) - {n - 2})) AS pos FROM words)"
        for n in (repetition.BASE_N, *lengths)
    )
    chars = ", ".join(f"coalesce(sum(len(w[spot])) FILTER (n = {n}), 0) AS dup_chars_{n}" for n in lengths)
    names = [f"dup_chars_{n}" for n in lengths]
    keep = " AND ".join(f"100 * coalesce({c}, 0) <= {repetition.LIMITS[n]} * word_chars" for n, c in zip(lengths, names))
    outputs = ", ".join(f"coalesce({c}, 0)::BIGINT AS {c}" for c in names)
    return rf"""
WITH words AS (
    SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
{windows}
), repeated AS (
    SELECT id, n, pos FROM windows QUALIFY count(*) OVER (PARTITION BY id, n, gram) > 1
), spots AS (
    SELECT DISTINCT id, n, unnest(range(pos, pos + n)) AS spot FROM repeated
), covered AS (
    SELECT id, count(*) FILTER (n = {repetition.BASE_N}) AS n_repeat_words, {chars} FROM spots JOIN words USING (id) GROUP BY id
), lines AS (
    SELECT id, line, count(*) AS c FROM (SELECT id, unnest(string_split(t, chr(10))) AS line FROM words) GROUP BY ALL
), dup_lines AS (
    SELECT id, sum(c - 1) AS n_dup_lines, sum(c * length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) AS dup_line_chars
    FROM lines WHERE c > 1 AND regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY id
), counted AS (
    SELECT id, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM words
), judged AS (
    SELECT *, n_words < {repetition.MIN_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {repetition.MAX_REPEAT} * n_words AS base_failed
    FROM counted LEFT JOIN covered USING (id) LEFT JOIN dup_lines USING (id)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND 100 * coalesce(dup_line_chars, 0) <= {repetition.LINE_LIMIT} * word_chars AND {keep} AS kept,
       coalesce(dup_line_chars, 0)::BIGINT AS dup_line_chars, {outputs}
FROM judged
"""


OP13_SQL = r"""
WITH d AS (
    SELECT coalesce(lang, '') AS part, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), firsts AS (
    SELECT t, min(doc_id) AS first_id FROM d GROUP BY t
), marks AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), masks AS (
    SELECT part, CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS fails,
        count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM d JOIN firsts USING (t) LEFT JOIN marks USING (doc_id) GROUP BY ALL
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS o FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), gone AS (
    SELECT part, o, fails, n, good, toxic, CASE WHEN fails = '' THEN 6 ELSE list_min([strpos(o, x) FOR x IN string_split(fails, '')]) END AS gone_at FROM masks, orders
), steps AS (
    SELECT part, o, step, substr(o, step, 1) AS f, sum(n) FILTER (gone_at > step) AS kept, sum(n) FILTER (gone_at = step) AS removed,
           sum(n) FILTER (gone_at < step AND contains(fails, substr(o, step, 1))) AS redundant, sum(n) FILTER (fails = substr(o, step, 1)) AS unique_fails,
           sum(good) FILTER (gone_at = step) AS good_lost, sum(toxic) FILTER (gone_at = step) AS toxic_lost
    FROM gone, range(1, 6) AS s(step) GROUP BY ALL
)
SELECT part, o AS filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       sum(coalesce(removed, 0)) OVER (PARTITION BY part, f)::BIGINT AS shapley
FROM steps
"""

ORACLE_SQL = {
    "op2_licenses": _license_sql(),
    "op4_ngram_join": OP4_SQL,
    "op5_url_filter": _url_sql(),
    "op9_warc": OP9_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op12_repetition": _repetition_sql(),
    "op13_filter_audit": OP13_SQL,
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
