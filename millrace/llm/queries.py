"""The registered queries of the operators; their SQL is in `oracles`."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe_counts, curriculum, decontaminate, divergence, fm_index, langid, licenses, minhash
from millrace.llm import negatives, quality_rules, surrogates, weak_labels, wrappers
from millrace.llm.tables import documents
from millrace.session import table


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The vocabulary file: $MILLRACE_VOCABULARY, or that of the installed package."""
    import public_tokenizers

    return os.environ.get("MILLRACE_VOCABULARY") or public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.verdicts(quality_rules.ledger(documents(spark, folder)))


def rule_ablations(spark: SparkSession, folder: str) -> DataFrame:
    """What each rule of each policy does, from the bits of the ledger alone."""
    return quality_rules.ablations(quality_rules.ledger(documents(spark, folder)))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(spark, documents(spark, folder), table(spark, folder, "benchmark"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_counts.token_counts(documents(spark, folder), vocabulary())


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return weak_labels.scored(spark, documents(spark, folder), table(spark, folder, "labels"))


def op5_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    out = surrogates.with_surrogates(spark, documents(spark, folder))
    found = F.transform("mentions", lambda m: F.struct(m["what"].alias("kind"), m["made"].alias("surrogate")))
    return out.select(F.col("row.doc_id").alias("doc_id"), "text", F.size("mentions").alias("n_mentions"), found.alias("surrogates"))


def op6_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.components(spark, documents(spark, folder))


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = fm_index.without_repeats(spark, documents(spark, folder))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.held_out_predictions(spark, documents(spark, folder))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(spark, documents(spark, folder))


def op10_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return curriculum.mixed(spark, documents(spark, folder))


def op11_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.extracted(spark, table(spark, folder, "pages"))


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(spark, documents(spark, folder))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.hard_negatives(spark, table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_decontamination,
        op3_token_counts,
        op4_quality_classifier,
        op5_pii_surrogates,
        op6_minhash_dedup,
        op7_substring_dedup,
        op8_language_id,
        op9_license_scan,
        op10_source_mix,
        op11_html_extraction,
        op12_source_divergence,
        op13_hard_negatives,
        rule_ablations,
    )
}
