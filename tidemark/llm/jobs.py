"""The operators as named queries over the given tables, and the SQL of those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    chat,
    extract,
    hashing,
    licenses,
    lines,
    mix,
    pieces,
    private,
    quality,
    runs,
    search,
    shards,
    simhash,
)
from tidemark.llm.common import table


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_digest(table(spark, folder, "documents"))


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(table(spark, folder, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_digest(table(spark, folder, "documents"))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.line_digest(table(spark, folder, "documents"))


def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat.chat_digest(table(spark, folder, "conversations"))


def op6_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix.mix_digest(table(spark, folder, "documents"))


def op7_private_spans(spark: SparkSession, folder: str) -> DataFrame:
    return private.private_digest(table(spark, folder, "documents"))


def op8_multi_index_hashing(spark: SparkSession, folder: str) -> DataFrame:
    return hashing.neighbour_digest(table(spark, folder, "embeddings"))


def op9_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shards.shard_digest(table(spark, folder, "documents"))


def op10_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.piece_digest(table(spark, folder, "documents"))


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search_digest(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def op12_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract.page_digest(table(spark, folder, "pages"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.runs_digest(table(spark, folder, "documents"))


#: The beta prior and its moments as in ``quality``; one line a rule.
QUALITY_SQL = r"""
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                     lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT rid, i, words[i:i+4] AS gram
  FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM split)),
twins AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM windows)
  WHERE n > 1),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n
  FROM twins, (SELECT unnest(range(0, 5)) AS k) GROUP BY rid),
measured AS (
  SELECT doc_id, source, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines
  FROM split LEFT JOIN covered USING (rid)),
failing AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         unnest(['symbols', 'lines', 'length']) AS rule,
         unnest([100 * n_symbols > 10 * n_words, 100 * n_dup_lines > 30 * n_lines,
                 word_chars < 3 * n_words OR word_chars > 10 * n_words]) AS fails
  FROM measured),
hosts AS (
  SELECT rule, source, count(*)::DOUBLE AS n, count(*) FILTER (fails)::DOUBLE AS f
  FROM failing GROUP BY rule, source),
moments AS (
  SELECT rule, count(*) AS k, sum(n) AS n, sum(n * n) AS nn, sum(f) AS f, sum(f) / sum(n) AS m,
         sum(f * f / n) - sum(f) * sum(f) / sum(n) AS spread
  FROM hosts GROUP BY rule),
fitted AS (
  SELECT *, CASE WHEN m * (1 - m) > 0 AND k > 1 THEN
    (spread - (k - 1) * m * (1 - m)) / (m * (1 - m) * (n - nn / n - (k - 1))) END AS rho
  FROM moments),
priors AS (
  SELECT rule, m, CASE WHEN rho > 0 THEN least(1e6, greatest(0, 1 / rho - 1)) ELSE 1e6 END AS s
  FROM fitted),
strict AS (
  SELECT rule, source, (f + m * s) / (n + s) >= 0.3 AS strict
  FROM hosts JOIN priors USING (rule)),
judged AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
         NOT base_failed AND NOT (
           (s.strict AND 100 * n_symbols > 10 * n_words)
           OR (l.strict AND 100 * n_dup_lines > 30 * n_lines)
           OR (w.strict AND (word_chars < 3 * n_words OR word_chars > 10 * n_words))) AS kept
  FROM (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
        FROM measured) d
  JOIN strict s ON s.source IS NOT DISTINCT FROM d.source AND s.rule = 'symbols'
  JOIN strict l ON l.source IS NOT DISTINCT FROM d.source AND l.rule = 'lines'
  JOIN strict w ON w.source IS NOT DISTINCT FROM d.source AND w.rule = 'length')
SELECT * FROM judged
"""

LINES_SQL = r"""
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id, text, string_split(text, chr(10)) AS lines
  FROM documents),
windows AS (
  SELECT rid, doc_id, i, lines[i:i+2] AS w
  FROM (SELECT rid, doc_id, lines, unnest(range(1, len(lines) - 1)) AS i FROM split)
  WHERE regexp_matches(array_to_string(lines[i:i+2], ''), '[^\x20\x09-\x0D]')),
later AS (
  SELECT rid, i FROM (
    SELECT rid, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS nth FROM windows)
  WHERE nth > 1),
covered AS (
  SELECT rid, list(DISTINCT i + k) AS gone
  FROM later, (SELECT unnest(range(0, 3)) AS k) GROUP BY rid),
kept AS (
  SELECT rid, string_agg(lines[i], chr(10) ORDER BY i) AS text, count(*) AS n
  FROM (SELECT rid, lines, unnest(range(1, len(lines) + 1)) AS i FROM split)
  JOIN covered USING (rid) WHERE NOT list_contains(gone, i) GROUP BY rid)
SELECT s.doc_id,
       CASE WHEN c.gone IS NULL THEN s.text ELSE coalesce(k.text, '') END AS text,
       coalesce(len(s.lines), 0)::BIGINT AS n_lines,
       CASE WHEN c.gone IS NULL THEN 0 ELSE len(s.lines) - coalesce(k.n, 0) END::BIGINT AS n_removed
FROM split s LEFT JOIN covered c USING (rid) LEFT JOIN kept k USING (rid)
"""

JOBS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_license_scan": op2_license_scan,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_chat_format": op5_chat_format,
    "op6_mix_sources": op6_mix_sources,
    "op7_private_spans": op7_private_spans,
    "op8_multi_index_hashing": op8_multi_index_hashing,
    "op9_kd_shards": op9_kd_shards,
    "op10_sentence_pieces": op10_sentence_pieces,
    "op11_lexical_search": op11_lexical_search,
    "op12_html_extraction": op12_html_extraction,
    "op13_periodic_runs": op13_periodic_runs,
}

SQL: dict[str, str] = {
    "op1_quality_rules": QUALITY_SQL.strip(),
    "op2_license_scan": licenses.license_sql().strip(),
    "op4_line_dedup": LINES_SQL.strip(),
    "op11_lexical_search": search.SEARCH_SQL.strip(),
}
