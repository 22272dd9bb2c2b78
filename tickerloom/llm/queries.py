"""The registered queries of this package, and SQL for those that SQL can express.

Each query applies its operator, with production parameters, to whole tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickerloom.llm import (
    compression,
    jaccard_join,
    line_dedup,
    mixture,
    multi_index,
    packing,
    quality_rules,
    secret_scan,
    spelling,
    token_counts,
    toxicity,
    warc,
    whitening,
)
from tickerloom.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.toxicity_scores(docs, model)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, removed="lines_removed")


def op5_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(table(spark, sf_dir, "embeddings"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), path)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return jaccard_join.jaccard_components(docs, words=3, percent=90).drop("key")


def op8_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


def op9_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents"))


def op10_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = compression.fit_compression(docs, table(spark, sf_dir, "labels"))
    return compression.quality_scores(docs, model)


def op11_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.normalised_pages(table(spark, sf_dir, "pages"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_quality_rules,
        op2_best_fit_packing,
        op3_toxicity,
        op4_line_dedup,
        op5_multi_index,
        op6_token_counts,
        op7_jaccard_join,
        op8_secret_spans,
        op9_source_mixture,
        op10_compression_quality,
        op11_warc_members,
        op12_spelling_variants,
        op13_whitening,
    )
}

_STOP_WORDS = ", ".join(f"'{word}'" for word in quality_rules.STOP_WORDS)
_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE_SQL: dict[str, str] = {
    "op11_warc_members": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS n FROM pages
        ),
        m AS (
            SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY payload) END AS head FROM p
        )
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
               CASE WHEN head > coalesce(page_id, head - 1) THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN head > coalesce(page_id, head - 1) THEN head END AS refers_to
        FROM m
    """,
    "op7_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ),
        s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
                ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])
                END) AS g
            FROM w
        ),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
            FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
        ),
        link AS (
            SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * shared >= 90 * (x.n + y.n - shared)
        ),
        both_ AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
        reach(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION
            SELECT reach.doc_id, both_.b FROM reach JOIN both_ ON reach.other = both_.a
        )
        SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.low AS component_id
        FROM documents d LEFT JOIN n USING (doc_id)
        JOIN (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id) r USING (doc_id)
    """,
    "op9_source_mixture": r"""
        WITH RECURSIVE sized AS (
            SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                   length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS symbols,
                   CAST('0x' || substr(md5('42|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')),
                                       1, 13) AS BIGINT) AS bits
            FROM documents
        ),
        keyed AS (
            SELECT doc_id, source, size,
                   -ln((bits + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE))
                   / (CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE)
                      + CAST(4 AS DOUBLE) * coalesce(symbols, 0) / greatest(size, 1))) AS key
            FROM sized
        ),
        sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(3 * sum(size) AS BIGINT) AS cap,
                   1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
            FROM keyed GROUP BY source
        ),
        capped(round, source, source_size, cap, weight, full_) AS (
            SELECT 0, *, false FROM sources
            UNION ALL
            SELECT round + 1, source, source_size, cap, weight,
                   full_ OR cap * sum(CASE WHEN full_ THEN 0 ELSE weight END) OVER ()
                            <= weight * (sum(source_size) OVER () - sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER ())
            FROM capped WHERE round < 40
        ),
        targets AS (
            SELECT source, source_size,
                   CASE WHEN full_ THEN CAST(cap AS DOUBLE)
                        ELSE CAST(CAST(sum(source_size) OVER () - sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER () AS BIGINT)
                                  AS DOUBLE)
                             * weight / CAST(sum(CASE WHEN full_ THEN 0 ELSE weight END) OVER () AS DOUBLE) END AS target
            FROM capped WHERE round = 40
        ),
        plan AS (
            SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 3) ELSE 0 END
                      AS epochs
            FROM targets
        ),
        reached AS (
            SELECT k.doc_id, k.size, p.source_size, p.target, p.epochs,
                   greatest(p.target - p.epochs * p.source_size, 0) AS rest,
                   sum(k.size) OVER (PARTITION BY k.source ORDER BY key) AS reach,
                   sum(k.size) OVER (PARTITION BY k.source, key) AS words
            FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source
        ),
        copied AS (
            SELECT *, epochs + CASE WHEN reach <= rest
                                      OR (reach - words <= rest AND rest - (reach - words) >= words / 2) THEN 1 ELSE 0 END
                      AS copies
            FROM reached
        )
        SELECT doc_id, size, source_size, target, CAST(copies AS BIGINT) AS copies, CAST(copies * size AS BIGINT) AS taken
        FROM copied
    """,
    "op4_line_dedup": rf"""
        WITH split AS (
            SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL
        ),
        line AS (
            SELECT doc_id, unnest(parts) AS raw, generate_subscripts(parts, 1) - 1 AS p FROM split
        ),
        worded AS (
            SELECT doc_id, p, trim(raw, {_SPACES}) AS line,
                   len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')) AS w,
                   row_number() OVER (PARTITION BY doc_id ORDER BY p) AS i,
                   sum(len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+'))) OVER (PARTITION BY doc_id ORDER BY p) AS c
            FROM line WHERE trim(raw, {_SPACES}) <> ''
        ),
        span AS (
            SELECT a.doc_id, a.i AS first, b.i AS last, a.p AS pa, b.p AS pb
            FROM worded a JOIN worded b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.i < a.i + 50
            WHERE b.c - a.c + a.w >= 50
              AND (b.c - b.w - a.c + a.w < 50 OR b.c - a.c < 50)
        ),
        run AS (
            SELECT s.doc_id, pa, pb, string_agg(line, chr(10) ORDER BY i) AS run
            FROM span s JOIN worded w ON w.doc_id = s.doc_id AND w.i BETWEEN s.first AND s.last
            GROUP BY s.doc_id, pa, pb
        ),
        later AS (
            SELECT doc_id, pa, pb, row_number() OVER (PARTITION BY run ORDER BY doc_id, pa) AS n FROM run
        ),
        gone AS (
            SELECT DISTINCT line.doc_id, line.p FROM line JOIN later
              ON line.doc_id = later.doc_id AND line.p BETWEEN pa AND pb WHERE n > 1
        ),
        kept AS (
            SELECT line.doc_id, string_agg(CASE WHEN gone.p IS NULL THEN raw END, chr(10) ORDER BY line.p) AS text,
                   count(gone.p) AS n
            FROM line LEFT JOIN gone ON line.doc_id = gone.doc_id AND line.p = gone.p GROUP BY line.doc_id
        )
        SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text,
               CAST(coalesce(n, 0) AS BIGINT) AS lines_removed
        FROM documents d LEFT JOIN kept USING (doc_id)
    """,
    "op1_quality_rules": rf"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                   list_filter(string_split(coalesce(text, ''), chr(10)),
                               lambda x: trim(x, {_SPACES}) <> '') AS lines
            FROM documents
        ),
        word AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM d),
        win AS (
            SELECT doc_id, i, lead(w, 7) OVER o AS last,
                   concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o,
                             lead(w, 5) OVER o, lead(w, 6) OVER o, lead(w, 7) OVER o) AS k
            FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i)
        ),
        rep AS (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win WHERE last IS NOT NULL
        ),
        covered AS (
            SELECT doc_id, count(DISTINCT i + j) AS n FROM rep, range(0, 8) AS t(j) WHERE c > 1 GROUP BY doc_id
        ),
        m AS (
            SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
                   CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
                   CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                   CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                   CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
                   CAST(len(lines) AS BIGINT) AS n_lines,
                   len(list_filter(words, lambda x: lower(x) IN ({_STOP_WORDS}))) AS stops,
                   len(list_filter(lines, lambda x: regexp_matches(trim(x, {_SPACES}), '^[-*•‣◦·]'))) AS bullets,
                   len(list_filter(lines, lambda x: regexp_matches(trim(x, {_SPACES}), '(\.\.\.|…)$'))) AS dots
            FROM d LEFT JOIN covered USING (doc_id)
        ),
        r AS (
            SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
                   n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
                   CASE WHEN n_words > 0 THEN CAST(word_chars AS DOUBLE) / n_words ELSE CAST(0 AS DOUBLE) END
                       AS mean_word_chars,
                   CASE WHEN n_words > 0 THEN CAST(n_symbols AS DOUBLE) / n_words ELSE CAST(0 AS DOUBLE) END
                       AS symbols_per_word,
                   CASE WHEN n_words > 0 THEN CAST(stops AS DOUBLE) / n_words ELSE CAST(0 AS DOUBLE) END
                       AS stop_word_share,
                   CASE WHEN n_lines > 0 THEN CAST(n_dup_lines AS DOUBLE) / n_lines ELSE CAST(0 AS DOUBLE) END
                       AS dup_line_share,
                   CASE WHEN n_lines > 0 THEN CAST(bullets AS DOUBLE) / n_lines ELSE CAST(0 AS DOUBLE) END
                       AS bullet_line_share,
                   CASE WHEN n_lines > 0 THEN CAST(dots AS DOUBLE) / n_lines ELSE CAST(0 AS DOUBLE) END
                       AS ellipsis_line_share
            FROM m
        )
        SELECT *, NOT base_failed AND mean_word_chars >= 1.5 AND mean_word_chars <= 20 AND symbols_per_word <= 0.3
                  AND stop_word_share >= 0.02 AND dup_line_share <= 0.5 AND bullet_line_share <= 0.9
                  AND ellipsis_line_share <= 0.3 AS kept
        FROM r
    """,
}
