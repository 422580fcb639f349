"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rxcover.llm import exact_dedup as xd
from rxcover.llm import (decontam, langid, licenses, ngram_join, packing, periodic_runs, pii_crf, sentencepiece, site_style,
                         suffix_dedup, vector_codes, warc)
from rxcover.llm.common import read
from rxcover.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.warc_summary(spark, pages, scratch_path(spark, "llm", "warc", unique=True))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"), licenses.template_table(spark))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.summary(read(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xd.exact_dedup(spark, read(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style.extract_pages(read(spark, sf_dir, "pages"))


def op9_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.find_pii(read(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic_runs.periodic_runs(docs, rewrite=periodic_runs.planted, texts=False)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read(spark, sf_dir, "embeddings"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS k,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, k = 1 AS kept, text_sha256 FROM g
"""

OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS v
  FROM documents),
g AS (
  SELECT doc_id, unnest(CASE WHEN len(v) = 0 THEN []
                             WHEN len(v) < 4 THEN [array_to_string(v, ' ')]
                             ELSE list_distinct(list_transform(range(1, len(v) - 2), lambda i: array_to_string(v[i:i + 3], ' '))) END) AS s
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
  WHERE 100 * least(p.n, q.n) >= 85 * greatest(p.n, q.n)
  GROUP BY x.doc_id, y.doc_id, p.n, q.n
  HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, (SELECT min(b) FROM reach r WHERE r.a = d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id)
"""

QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_license_scan": op2_license_scan,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_decontamination": op4_decontamination,
    "op5_language_id": op5_language_id,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_ngram_join": op7_ngram_join,
    "op8_site_style": op8_site_style,
    "op9_pii_crf": op9_pii_crf,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_vector_codes": op12_vector_codes,
    "op13_packing": op13_packing,
}

ORACLE_SQL: dict[str, str] = {
    "op2_license_scan": licenses.SQL,
    "op6_exact_dedup": OP6_SQL,
    "op7_ngram_join": OP7_SQL,
    "op12_vector_codes": vector_codes.sql(),
}
