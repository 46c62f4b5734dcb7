"""The corpus queries over the standard tables, and SQL that gives the same rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import adaptive_kmeans, decontamination, filter_audit, html_extraction, language_model, mixing, near_dedup, repetition, sharding, surrogates, token_counts, url_filters, warc_store
from .common import table


def op1_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"), n_shards=40)


def op3_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_quality_rules(spark, sf_dir):
    got = repetition.repetition(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", *(F.col(f"quality.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")))


_GRAM_SQL = "\n".join(
    f"""g{n} AS (SELECT w.r, i, w.w, CASE WHEN i + {n - 1} <= nw THEN hash(list_slice(w0.ws, i, i + {n - 1})) END AS gram FROM w JOIN w0 USING (r)),
d{n} AS (SELECT r, i, w, CASE WHEN gram IS NOT NULL AND count(*) OVER (PARTITION BY r, gram) > 1 THEN 1 ELSE 0 END AS dup FROM g{n}),
c{n} AS (SELECT r, w, max(dup) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS inside FROM d{n}),"""
    for n in (3, *repetition.GRAM_LIMITS)
) + "\nca AS (" + " UNION ALL ".join(f"SELECT r, {n} AS n, {most} AS most, sum(inside) AS words, sum(CASE WHEN inside = 1 THEN length(w) ELSE 0 END) AS chars, sum(length(w)) AS total FROM c{n} GROUP BY r" for n, most in {3: 100, **repetition.GRAM_LIMITS}.items()) + "),"
OP9_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w0 AS (SELECT r, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
w AS (SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i, len(ws) AS nw FROM w0 WHERE len(ws) > 0),
ln AS (SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM d),
ln2 AS (SELECT r, length(line) AS c, row_number() OVER (PARTITION BY r, line ORDER BY k) > 1 AS again FROM ln WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
la AS (SELECT r, count(*) FILTER (WHERE again) AS n_dup_lines, sum(c) AS line_chars, coalesce(sum(c) FILTER (WHERE again), 0) AS dup_line_chars FROM ln2 GROUP BY r),
{_GRAM_SQL}
cb AS (SELECT r, max(CASE WHEN n = 3 THEN words END) AS n_repeat_words, bool_or(n > 3 AND 100 * chars > most * total) AS over FROM ca GROUP BY r),
wa AS (SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars FROM w GROUP BY r),
a AS (SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(over, false) OR coalesce(100 * dup_line_chars > {repetition.LINE_LIMIT} * line_chars, false) AS over
  FROM d LEFT JOIN wa USING (r) LEFT JOIN la USING (r) LEFT JOIN cb USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT over AS kept FROM a
"""

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_decontamination": decontamination.query,
    "op3_token_counts": op3_token_counts,
    "op4_html_extraction": html_extraction.query,
    "op5_url_filters": url_filters.query,
    "op6_pii": surrogates.query,
    "op7_near_dedup": near_dedup.query,
    "op8_lm_scoring": language_model.query,
    "op9_quality_rules": op9_quality_rules,
    "op10_mixing": mixing.query,
    "op11_filter_audit": filter_audit.query,
    "op12_adaptive_kmeans": adaptive_kmeans.query,
    "op13_warc_store": warc_store.query,
}
ORACLE = {
    "op2_decontamination": decontamination.SQL,
    "op5_url_filters": url_filters.SQL,
    "op9_quality_rules": OP9_SQL,
    "op10_mixing": mixing.SQL,
    "op11_filter_audit": filter_audit.SQL,
    "op12_adaptive_kmeans": adaptive_kmeans.SQL,
    "op13_warc_store": warc_store.SQL,
}
