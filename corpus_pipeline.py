"""The corpus pipeline: stages over documents, each written as Parquet and reread by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sessiongrain.llm import common, decontamination, mixing, near_duplicates, quality, token_files

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie far from their language and source go."""
    return quality.drop_low_quality(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard 0.8 or more) stays, the one with the least doc_id."""
    return near_duplicates.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark table go."""
    return decontamination.drop_contaminated(docs, common.read_table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become what the mix takes of them: whole ones once a pass, and the words of the last pass."""
    return mixing.mix_documents(docs)


def token_binary_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids in bit-packed files, and each document's place, length and checksum read back from them."""
    import public_tokenizers

    return token_files.token_files(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_binary_output", token_binary_output),
]

#: Near-duplicate groups, robust estimates and edit distances are out of reach of SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
