"""The operators bound to the driver's tables, and the SQL that checks them where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import archives, collocations, decontam, langid, mainhtml, mixing, neardup, ngramlm, packing, secretscan, tokenalign, topk, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mainhtml.extract(_table(spark, sf_dir, "pages"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_by_source(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by all evidence, and documents by text and source: one of doc_id and page_id is set."""
    docs = _table(spark, sf_dir, "documents")
    pages = langid.identify_pages(_table(spark, sf_dir, "pages"), docs)
    texts = langid.identify_documents(docs)
    none = F.lit(None)
    return pages.select(none.cast("long").alias("doc_id"), "page_id", "lang", "posterior", "text_lang", "declared").unionByName(
        texts.select("doc_id", none.cast("long").alias("page_id"), "lang", "posterior", "text_lang", none.cast("string").alias("declared"))
    )


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_scores(_table(spark, sf_dir, "embeddings"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = archives.archive_pages(_table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.secret_spans(_table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramlm.score_texts(_table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenalign.align_documents(_table(spark, sf_dir, "documents"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), ids=False)


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_extraction, op2_minhash_near_dedup, op3_source_mixing, op4_language_id, op5_exact_top_k, op6_toxicity,
        op7_benchmark_decontamination, op8_arc_to_warc, op9_secret_scan, op10_lm_scoring, op11_phrase_collocations, op12_cross_tokenizer_alignment,
        op13_best_fit_packing,
    )
}
SQL: dict[str, str] = {
    "op3_source_mixing": mixing.MIX_SQL.format(docs="documents", columns="d.doc_id AS doc_id"),
    "op5_exact_top_k": topk.TOP_SQL,
    "op11_phrase_collocations": collocations.COLLOCATIONS_SQL,
}
