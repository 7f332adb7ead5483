"""Registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (bpe, decontaminate, html_text, lexical_search, line_dedup, packing, quality_rules, sharding,
               simhash_dedup, suffix_dedup, token_counts, url_filter, vector_codes)
from .common import table

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
COUNT_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PACK_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block",
             "net/fr/": "block"}


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its repeated lines removed: ``doc_id, n_lines, n_removed, text``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, counts=True).select("doc_id", "n_lines", "n_removed", "text")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    q = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), out="quality").select("doc_id", "quality.*")
    return q.select("doc_id", *(F.col(c).cast("long") for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), "base_failed", "kept")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or model verdict of every page's URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES, url_filter.train(spark)).select(
        "page_id", "host", "path", "rule", "score", "verdict")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated 200-byte strings."""
    return suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (3-word shingles, 2 bits)."""
    r = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return r.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item was found, as it is or re-parameterised."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                      one_to_one=False).drop("text_hash")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, BPE_RANKS, public_tokenizers.PATTERN)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards whose row counts are at most one apart."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return sharding.assign(docs, ["doc_id"], shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, from one encoding of the whole text."""
    return token_counts.section_tokens(table(spark, sf_dir, "documents"), COUNT_RANKS, public_tokenizers.PATTERN)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece's sequence of at most 4096 tokens and its place there."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), PACK_TOKENIZER, capacity=4096, end=1)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of 4 parts of every vector, their errors and the codebooks' digest."""
    rows, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return rows.select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error",
                       F.lit(vector_codes.books_sha256(books)).alias("codebooks_sha256"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_quality_rules, op3_url_filter, op4_html_text, op5_suffix_dedup, op6_simhash_dedup,
    op7_decontaminate, op8_bpe, op9_sharding, op10_token_counts, op11_packing,
    op12_vector_codes, op13_lexical_search)} | {"pipeline": corpus_pipeline.run}

# Base statistics and verdict in DuckDB: windows are compared as lists of words.
_LINE = """
  (n_sym >= 0.3 * w and n_sym > 1) or (n_mark >= 0.3 * w and n_mark > 1) or n_let < 0.6 * n_solid
  or (n_sep >= 0.25 * w and n_sep >= 2) or (w <= 12 and n_menu >= 2)
  or (w >= 3 and n_up > 0.7 * n_let) or regexp_matches(lower(line), '{boiler}')
"""
_SP = r"[ \t\n\v\f\r]+"
ORACLE_SQL = {"op2_quality_rules": rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
words AS (
  SELECT *, list_filter(regexp_split_to_array(text, '{_SP}'), lambda x: x <> '') AS ws FROM d),
win AS (
  SELECT r, i, list_slice(ws, i, i + 7) AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM words)),
rep AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, range(0, 8) t(k) GROUP BY r),
line AS (
  SELECT r, k, lines[k] AS line FROM
    (SELECT r, lines, unnest(range(1, len(lines) + 1)) AS k FROM
      (SELECT r, string_split(text, chr(10)) AS lines FROM d))),
feat AS (
  SELECT *, len(list_filter(regexp_split_to_array(line, '{_SP}'), lambda x: x <> '')) AS w,
    len(regexp_extract_all(line, '[#*$%&|<>]')) AS n_sym, len(regexp_extract_all(line, '[!?]{{2,}}')) AS n_mark,
    len(regexp_extract_all(line, '[|»›·•]')) AS n_sep, len(regexp_extract_all(line, '[^ \t\n\v\f\r]')) AS n_solid,
    len(regexp_extract_all(line, '[\p{{L}}\p{{M}}\p{{N}}]')) AS n_let,
    len(regexp_extract_all(line, '\p{{Lu}}')) AS n_up,
    len(regexp_extract_all(' ' || lower(line) || ' ', '[^\p{{L}}](?:{"|".join(quality_rules.MENU)})(?:$|[^\p{{L}}])')) AS n_menu
  FROM line),
judged AS (
  SELECT *, w > 0 AND ({_LINE.format(boiler="|".join(x.replace("(", r"\(").replace(")", r"\)") for x in quality_rules.BOILERPLATE))}) AS fails
  FROM feat),
per AS (
  SELECT r, sum(CASE WHEN w > 0 THEN 1 ELSE 0 END) - count(DISTINCT CASE WHEN w > 0 THEN line END) AS dup,
    coalesce(sum(CASE WHEN NOT fails THEN w END), 0) AS kept_words,
    coalesce(sum(CASE WHEN NOT fails THEN n_solid END), 0) AS kept_chars
  FROM judged GROUP BY r),
base AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, per.dup::BIGINT AS n_dup_lines,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words, kept_words, kept_chars
  FROM words JOIN per USING (r) LEFT JOIN cov USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  (NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND kept_words >= 20 AND kept_chars >= 0.7 * word_chars) AS kept
FROM base
"""}


def _vector_sql(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """Every distance of every round: plain k-means of the parts."""
    ctes = [f"""
v AS (SELECT row_number() OVER (ORDER BY vec_id, e) AS r, vec_id, label,
        list_transform(e, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
      FROM (SELECT vec_id, label, embedding AS e FROM embeddings)
      WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS (SELECT r, p, list_slice(e, p * (len(e) // {parts}) + 1, (p + 1) * (len(e) // {parts})) AS s
      FROM v, range(0, {parts}) t(p)),
c0 AS (SELECT p, r - 1 AS k, s AS c FROM x WHERE r <= {entries})"""]
    for i in range(rounds + 1):
        ctes.append(f"""
d{i} AS (SELECT r, x.p, k, list_sum(list_transform(list_zip(s, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
      FROM x JOIN c{i} ON x.p = c{i}.p),
a{i} AS (SELECT r, p, arg_min(k, d * {entries} + k) AS k, min(d) AS d FROM d{i} GROUP BY r, p)""")
        if i < rounds:
            ctes.append(f"""
u{i} AS (SELECT p, k, j, sum(s) AS t, count(*) AS n
      FROM (SELECT p, k, unnest(s) AS s, unnest(range(1, len(s) + 1)) AS j FROM x JOIN a{i} USING (r, p)) GROUP BY p, k, j),
n{i} AS (SELECT p, k, list(CAST((t - ((t % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c FROM u{i} GROUP BY p, k),
c{i + 1} AS (SELECT p, k, coalesce(n{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN n{i} USING (p, k))""")
    return "WITH " + ",".join(ctes) + f""",
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, k)) AS h FROM c{rounds}),
o AS (SELECT r, string_agg(lower(printf('%02x', k)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
      FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM o JOIN v USING (r), h"""


ORACLE_SQL["op12_vector_codes"] = _vector_sql()
_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
ORACLE_SQL["op13_lexical_search"] = f"""
WITH q AS (SELECT r, item_id, unnest(list_distinct({_TERMS})) AS t
           FROM (SELECT row_number() OVER () AS r, * FROM benchmark)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
total AS (SELECT count(*) AS n_docs, sum(len(ts)) AS n_terms FROM d WHERE len(ts) > 0),
tf AS (SELECT r AS dr, doc_id, n, t, count(*) AS tf
       FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), total),
s AS (SELECT q.r, item_id, dr, doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms)))) AS score
      FROM tf JOIN q USING (t) JOIN w USING (t), total GROUP BY q.r, item_id, dr, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id, dr) AS rank FROM s WHERE score > 0)
WHERE rank <= 50"""
