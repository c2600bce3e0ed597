"""Registered queries of the training-data operators: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, decontam, html_blocks, icws, importance, licenses, packing, ppm, quality, runs, syncmers, urls, warc
from tidewater.llm.common import held_out, load

RANKS = "byte_bpe_50k.tiktoken"
WORDS = "word_bpe_49k.json"


def op1_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases, notices and texts in every document."""
    return licenses.report(load(spark, sf_dir, "documents"))


def op2_language_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = load(spark, sf_dir, "documents")
    model = ppm.train(docs)
    return ppm.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return urls.report(load(spark, sf_dir, "pages"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the bytes decoded from them."""
    import public_tokenizers

    return bpe.report(load(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op5_minhash_icws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return icws.classes(load(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents leak."""
    return decontam.report(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op7_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written into archives and read back."""
    return warc.round_trip(load(spark, sf_dir, "pages"))


def op8_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_blocks.report(load(spark, sf_dir, "pages"))


def op9_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document against those of its edited text and of the next document."""
    return syncmers.report(load(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.report(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document."""
    return runs.report(load(spark, sf_dir, "documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids, packed into sequences."""
    import public_tokenizers

    return packing.report(load(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn for their likeness to the benchmark's texts."""
    return importance.report(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_templates, op2_language_ppm, op3_url_rules, op4_byte_bpe, op5_minhash_icws,
        op6_decontaminate, op7_warc_zstd, op8_html_blocks, op9_syncmers, op10_quality_rules,
        op11_periodic_runs, op12_packing, op13_importance,
    )
}

SQL = {"op1_license_templates": licenses.report_sql(), "op13_importance": importance.report_sql(), "op7_warc_zstd": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS n, sha256(coalesce(html, '')) AS digest FROM pages
), f AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first AND first IS NOT NULL THEN first END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest"""}
