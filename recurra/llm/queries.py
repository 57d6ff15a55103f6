"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can say it.

Each query applies its operator, with production parameters, to the whole of its table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.llm import (bpe, collocations, dart_minhash, exact_dedup, knn_quality, license_scan, mixing,
                         quality_rules, revisits, spelling_variants, suffix_dedup, token_shards, url_filter)
from recurra.llm.common import table
from recurra.session import ensure_checkpoint_dir

VOCABULARY = "word_bpe_49k.json"


def vocabulary_path() -> str:
    return public_tokenizers.path(VOCABULARY)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_copies(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return planned.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target",
                          (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op2_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").filter(~held_out)
    scored = knn_quality.score_quality(docs, knn_quality.train(docs, labels))
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents")))
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"), "kept",
                      "failed_bits")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_digests(docs)


def token_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    coded = bpe.round_trip(docs, vocabulary_path())
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (dart_minhash.near_duplicates(table(spark, sf_dir, "documents"))
            .select("doc_id", "class_id", "class_size", "kept"))


def op6_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve(revisits.crawl_records(table(spark, sf_dir, "pages")))
    listed = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.select("record_id", "url_key", "original_id", "outcome", F.array_join(listed, "; ").alias("headers"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.cut_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.train(spark))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.equal_groups(table(spark, sf_dir, "documents")).drop("text_sha")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(table(spark, sf_dir, "documents"))


def op12_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark)}/token-shards-{uuid.uuid4().hex}"
    token_shards.write_shards(table(spark, sf_dir, "documents"), path, vocabulary_path())
    return token_shards.read_documents(spark, path)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_knn_quality": op2_knn_quality,
    "op3_quality_rules": op3_quality_rules,
    "op4_bpe": op4_bpe,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_revisits": op6_revisits,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_license_scan": op8_license_scan,
    "op9_url_filter": op9_url_filter,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_token_shards": op12_token_shards,
    "op13_collocations": op13_collocations,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_BITS = " + ".join(f"CASE WHEN {cond} THEN {1 << i} ELSE 0 END"
                   for i, cond in enumerate(quality_rules.RULES.values()))

ORACLES: dict[str, str] = {
    "op1_mix_sources": f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, md5(coalesce(text, '')) AS text_md5 FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source),
shared(round, source, source_size, weight, capped) AS (
  SELECT 0, source, source_size, weight, FALSE FROM per
  UNION ALL
  SELECT round + 1, source, source_size, weight,
         capped OR 3.0::DOUBLE * source_size < weight * (
           CAST(sum(source_size) OVER () - coalesce(sum(CASE WHEN capped THEN 3 * source_size END) OVER (), 0) AS DOUBLE)
           / CAST(sum(CASE WHEN NOT capped THEN weight END) OVER () AS DOUBLE))
  FROM shared WHERE round < (SELECT count(*) FROM per)),
plan AS (
  SELECT source, source_size,
         CASE WHEN capped THEN 3.0::DOUBLE * source_size ELSE weight * (
           CAST(sum(source_size) OVER () - coalesce(sum(CASE WHEN capped THEN 3 * source_size END) OVER (), 0) AS DOUBLE)
           / CAST(sum(CASE WHEN NOT capped THEN weight END) OVER () AS DOUBLE)) END AS target
  FROM shared WHERE round = (SELECT count(*) FROM per)),
rated AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size = 0 THEN 0.0 ELSE target / source_size END AS rate,
         CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '~') || ':' || text_md5), 1, 13) AS BIGINT)
           / 4503599627370496.0::DOUBLE AS coin
  FROM sized JOIN plan ON sized.source IS NOT DISTINCT FROM plan.source),
copied AS (
  SELECT *, CAST(floor(rate) AS BIGINT) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END AS copies FROM rated)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies
FROM copied""",
    "op3_quality_rules": rf"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
windows AS (
  SELECT rid, i, list_slice(w, i, i + 4) AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM base WHERE len(w) >= 5)),
twice AS (SELECT rid, g FROM windows GROUP BY rid, g HAVING count(*) > 1),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n
  FROM windows JOIN twice USING (rid, g), (SELECT unnest(range(0, 5)) AS k) GROUP BY rid),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(length(regexp_replace(t, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper,
         CAST(length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS BIGINT) AS n_letters,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM base LEFT JOIN covered USING (rid)),
bits AS (SELECT *, CAST({_BITS} AS BIGINT) AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, failed_bits = 0 AS kept, failed_bits
FROM bits""",
    "op6_revisits": r"""
WITH split AS (
  SELECT page_id, coalesce(html, '') AS html,
         regexp_replace(regexp_replace(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', '') AS rest
  FROM pages),
keyed AS (
  SELECT page_id, html,
         regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), ':(80|443)$', ''), '^www\.', '')
           || regexp_replace(regexp_extract(rest, '^[^/?]*(/[^?]*)', 1), '/+$', '') AS place,
         list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
           lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS params
  FROM split),
pages2 AS (
  SELECT page_id, '"' || md5(html) || '"' AS etag, strlen(html) AS bytes,
         place || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS url_key
  FROM keyed),
records AS (
  SELECT 'response-' || page_id AS record_id, page_id AS date, TRUE AS is_full, url_key, etag, bytes FROM pages2
  UNION ALL
  SELECT 'revisit-' || page_id, page_id + 1000, FALSE, url_key, etag, 0 FROM pages2),
carried AS (
  SELECT *, last_value(CASE WHEN is_full THEN record_id END IGNORE NULLS) OVER (
      PARTITION BY url_key ORDER BY date, is_full DESC, record_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS original_id
  FROM records),
judged AS (
  SELECT c.record_id, c.url_key, c.original_id, c.date, c.etag, o.bytes AS stored_bytes,
         CASE WHEN o.record_id IS NULL THEN 'no_original' WHEN o.etag = c.etag THEN 'resolved'
              ELSE 'validator_mismatch' END AS outcome
  FROM carried c LEFT JOIN records o ON c.original_id = o.record_id WHERE NOT c.is_full)
SELECT record_id, url_key, original_id, outcome,
       CASE WHEN outcome = 'resolved'
            THEN 'content-length: ' || stored_bytes || '; content-type: text/html; date: ' || date || '; etag: ' || etag
            ELSE 'content-length: 0; date: ' || date || '; etag: ' || etag END AS headers
FROM judged""",
    "op10_exact_dedup": r"""
WITH norm AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
grouped AS (
  SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM norm GROUP BY t),
ranked AS (
  SELECT doc_id, t, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) AS rn FROM norm)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, rn = 1 AS kept, sha256(t) AS text_sha256
FROM ranked JOIN grouped USING (t)""",
    "op13_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
runs AS (
  SELECT lang, 1 AS words, unnest(ws) AS phrase FROM split
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM split
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))
  FROM split),
grams AS (SELECT lang, words, phrase, count(*) AS f FROM runs GROUP BY lang, words, phrase HAVING count(*) >= 10),
cands AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS ws FROM grams WHERE words >= 2),
sides AS (
  SELECT lang, words, phrase, a, 1 AS cut, ws[1] AS lp, ws[2] AS rp FROM cands WHERE words = 2
  UNION ALL
  SELECT lang, words, phrase, a, 1, ws[1], ws[2] || ' ' || ws[3] FROM cands WHERE words = 3
  UNION ALL
  SELECT lang, words, phrase, a, 2, ws[1] || ' ' || ws[2], ws[3] FROM cands WHERE words = 3),
cuts AS (
  SELECT c.lang, c.words, c.phrase, c.a, c.cut, l.f AS l, r.f AS r,
         CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM sides c JOIN grams l ON l.lang = c.lang AND l.phrase = c.lp
  JOIN grams r ON r.lang = c.lang AND r.phrase = c.rp),
lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM cuts),
parts AS (
  SELECT lang, ws[1] || ' ' || ws[2] AS phrase, a FROM cands WHERE words = 3
  UNION ALL SELECT lang, ws[2] || ' ' || ws[3], a FROM cands WHERE words = 3),
longer AS (SELECT lang, phrase, max(a) AS longer FROM parts GROUP BY lang, phrase),
kept AS (
  SELECT s.lang, s.phrase, s.a, s.l, s.r, s.score
  FROM lowest s LEFT JOIN longer o ON s.words = 2 AND o.lang = s.lang AND o.phrase = s.phrase
  WHERE s.nth = 1 AND (o.longer IS NULL OR 100 * o.longer < 50 * s.a)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM split GROUP BY lang)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}
