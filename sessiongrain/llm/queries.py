"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sessiongrain.llm import chat_format, decontamination, divergence, licenses, line_runs, mixing, near_duplicates, prefix_trie, quality, repeats, secrets, token_counts, token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": near_duplicates.op1_simhash_near_dedup,
    "op7_token_binary_output": token_files.op7_token_binary_output,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_source_mixing": mixing.op9_source_mixing,
    "op10_secret_scan": secrets.op10_secret_scan,
    "op4_quality_rules": quality.op4_quality_rules,
    "op2_license_scan": licenses.op2_license_scan,
    "op6_line_run_dedup": line_runs.op6_line_run_dedup,
    "op3_repeated_substrings": repeats.op3_repeated_substrings,
    "op5_benchmark_decontamination": decontamination.op5_benchmark_decontamination,
    "op11_chat_format": chat_format.op11_chat_format,
    "op12_conversation_trie": prefix_trie.op12_conversation_trie,
    "op13_source_divergence": divergence.op13_source_divergence,
}

SQL: dict[str, str] = {"op2_license_scan": licenses._sql(), "op6_line_run_dedup": line_runs.SQL, "op11_chat_format": chat_format.SQL, "op12_conversation_trie": prefix_trie.SQL, "op13_source_divergence": divergence.SQL}
