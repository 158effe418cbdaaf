"""The registered queries of this subpackage and, where SQL can express them, their twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roleweave.llm import backoff, decontaminate, jaccard, licences, merkle, packing, pieces, quality, repair, secrets, suffixes, toxicity, urls
from roleweave.llm.oracle import ORACLE_SQL as ORACLE_SQL


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(secrets.secret_spans(table(spark, folder, "documents")))


def op2_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), urls.fit(urls.labelled_urls(spark)))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.scores(docs, toxicity.fit(docs, table(spark, folder, "labels")), keep=["doc_id"])


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.round_trips(table(spark, folder, "documents"), pieces.load())


def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("items")


def op6_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.groups(table(spark, folder, "documents"))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality.quality(table(spark, folder, "documents")).select(*columns)


def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return backoff.scores(table(spark, folder, "documents"))


def op9_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return licences.licences(table(spark, folder, "documents"))


def op10_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.removals(table(spark, folder, "documents")).drop("removed")


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.audits(table(spark, folder, "conversations"))


def op12_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), packing.load())


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.proofs(merkle.manifest(table(spark, folder, "documents")))


QUERIES = {
    "op1_secret_scans": op1_secret_scans,
    "op2_url_filters": op2_url_filters,
    "op3_toxicity": op3_toxicity,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_quality_rules": op7_quality_rules,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_license_scans": op9_license_scans,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_merkle_manifest": op13_merkle_manifest,
}
