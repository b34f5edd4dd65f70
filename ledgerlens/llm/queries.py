"""The registered query of each operator, with production parameters over its whole table, and its DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, bpe, html, langid, lines, minhash, mixing, pii, quality, repeats, rules, spotsigs, tokenstore

TOKENIZER = "byte_bpe_multi_50k.tiktoken"
STORE_TOKENIZER, END_ID = "word_bpe_49k.json", 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    pages = _table(spark, sf_dir, "pages")
    return html.extract(pages, html.fit(pages)).withColumn("n_chars", F.length("text").cast("long"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    documents = _table(spark, sf_dir, "documents")
    return quality.score(documents, quality.fit(documents, _table(spark, sf_dir, "labels")))


def token_digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded bytes."""
    coded = bpe.round_trip(documents, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    return token_digests(_table(spark, sf_dir, "documents"))


def op4_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms of every document."""
    return pii.report(_table(spark, sf_dir, "documents"))


def op5_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document (three words, 0.85)."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id (of documents), page_id (of pages), host, declared, lang, confidence of every document and page.

    A document's host is its source; it declares nothing.
    """
    documents, pages = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pages")
    records = (pages.select(F.lit("page").alias("kind"), F.col("page_id").cast("long").alias("id"),
                            F.col("html").alias("content"), langid.host_of("url").alias("host"))
               .unionByName(documents.select(F.lit("document").alias("kind"), F.col("doc_id").cast("long").alias("id"),
                                             F.col("text").alias("content"), F.col("source").alias("host"))))
    found = langid.identify(records, *langid.learn(documents))
    return found.select(F.when(F.col("kind") == "document", F.col("id")).alias("doc_id"),
                        F.when(F.col("kind") == "page", F.col("id")).alias("page_id"),
                        "host", "declared", "lang", "confidence")


def op7_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document."""
    return spotsigs.neighbours(_table(spark, sf_dir, "documents"))


def op8_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of every document."""
    return rules.judge(_table(spark, sf_dir, "documents"), facts=True)


def op9_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    mix = mixing.mix(_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, removed, text of every document."""
    return lines.dedup_lines(_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_runs, the strongest run and digests of all runs and of the collapsed text of every document."""
    documents = _table(spark, sf_dir, "documents")
    found = repeats.find(documents.select("doc_id", repeats.planted(F.col("doc_id"), F.col("text")).alias("text")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = [F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")]
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *best,
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files."""
    return tokenstore.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path(STORE_TOKENIZER), END_ID)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts for each part (lang), order of the filters and step."""
    return audit.audit(audit.failures(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")))


QUERIES = {f.__name__: f for f in (
    op1_html_trees, op2_quality, op3_byte_bpe, op4_disclosure, op5_bbit_minhash, op6_language, op7_spotsigs,
    op8_rule_cascade, op9_pivotal_mix, op10_line_windows, op11_periodic_runs, op12_token_store, op13_filter_audit)}
ORACLE_SQL = {"op10_line_windows": lines.ORACLE.format(documents="documents"),
              "op13_filter_audit": audit.ORACLE.format(documents="documents", labels="labels")}
