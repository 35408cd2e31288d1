"""From raw documents to a training order: five stages, each written and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import curriculum, decontaminate, minhash, quality_rules, surrogates
from millrace.llm.tables import documents, scratch, written
from millrace.session import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return quality_rules.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.deduplicated(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with surrogates for personal data."""
    return surrogates.replaced(spark, docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, as often as the mix takes them."""
    return curriculum.training_order(spark, docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("pii_surrogates", private_data),
    ("source_mix", source_mix),
]

#: SQL has no way to say the circulant signatures and the keyed surrogates; tests hold a small corpus
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; every stage's result is a table of its own."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        # What a stage wrote in between goes when its result is written, and so does the result before it.
        with scratch(spark) as made:
            docs = written(spark, stage(spark, docs, sf_dir), name)
            result = made.pop()
            made += [before] if before else []
        before = result
    return STAGES[-1][1](spark, docs, sf_dir)
