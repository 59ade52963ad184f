"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, langid, licenses, manifest, mixing, near_dedup, ngram_join, pii, quality, repetition, token_store, url_rules, warc
from .common import table
from .oracles import ORACLES  # noqa: F401

#: Key of the pseudonyms in the registered query; a deployment passes its own.
PII_KEY = "gleaner-demo-key"

#: Vocabulary of the registered token query, by its name in the installed package.
VOCABULARY = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(VOCABULARY))


def op1_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), least_bytes=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(table(spark, sf_dir, "documents"), shingle=3, per_cent=85)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op6_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"), PII_KEY)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    weights = quality.fit(documents, table(spark, sf_dir, "labels"))
    return quality.judge(documents, weights).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages")).drop("own_rule")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return langid.predict(documents, langid.fit(documents))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.proofs(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.digests(repetition.repetitions(repetition.with_planted_runs(table(spark, sf_dir, "documents"))))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), shingle=4, per_cent=85)


QUERIES = {f.__name__: f for f in (
    op1_arc_to_warc, op2_mixing, op3_token_store, op4_near_dedup, op5_license_scan, op6_pii_pseudonyms, op7_quality,
    op8_decontamination, op9_url_rules, op10_language, op11_merkle_manifest, op12_periodic_runs,
    op13_ngram_join)}
