"""Registries: ingestion fingerprints, datasets, batches, artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessiongrain.functions.scalars import digest_id

ID_PATTERN = r"^[A-Za-z0-9][A-Za-z0-9._-]{0,127}$"


def valid_id(value: Column) -> Column:
    return value.rlike(ID_PATTERN)


def batch_fingerprint(facts: DataFrame) -> DataFrame:
    """One row: the digest of the sorted names, sizes and hashes of a batch's files (as many rows as files)."""
    lines = F.array_sort(F.collect_list(F.concat_ws("\x1f", "path", F.col("length").cast("string"), "sha256")))
    return facts.agg(F.concat(F.lit("batch_"), F.left(F.sha2(F.array_join(lines, "\n"), 256), F.lit(24))).alias("fingerprint"), F.count("*").alias("n_files"))


def new_files(facts: DataFrame, registered: DataFrame) -> DataFrame:
    """Files whose content (size and hash) no earlier batch ingested."""
    return facts.join(registered.select("length", "sha256").distinct(), ["length", "sha256"], "left_anti")


def artifact_manifest(registered: DataFrame, facts: DataFrame) -> DataFrame:
    """Registered artifacts with what is there now: present, changed or missing."""
    now = facts.select("path", F.col("sha256").alias("__now"), F.col("length").alias("__length"))
    status = F.when(F.col("__now").isNull(), "missing").when(F.col("__now") == F.col("sha256"), "present").otherwise("changed")
    return registered.join(now, "path", "left").withColumn("status", status).withColumn("length", F.col("__length")).drop("__now", "__length")


def dataset_manifest(batches: DataFrame, dataset: str) -> DataFrame:
    """The batches of a dataset by time."""
    return batches.where(F.col("dataset_id") == dataset).orderBy("created_at", "batch_id")


def activate(catalog: DataFrame, entry: DataFrame) -> DataFrame:
    """catalog with the entry's run active for its batch and listed among the available ones."""
    e = entry.select("batch_id", F.col("run_id").alias("__run"))
    joined = catalog.join(e, "batch_id", "full_outer")
    runs = F.array_sort(F.array_distinct(F.concat(F.coalesce("available_runs", F.array().cast("array<string>")), F.when(F.col("__run").isNotNull(), F.array("__run")).otherwise(F.array().cast("array<string>")))))
    return joined.select("batch_id", F.coalesce("__run", "active_run").alias("active_run"), runs.alias("available_runs"))


def dataset_id(name: Column, files: Column) -> Column:
    slug = F.regexp_replace(F.regexp_replace(F.lower(name), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
    return F.concat_ws("-", F.nullif(F.left(slug, F.lit(40)), F.lit("")), F.substring(digest_id("x", files, length=8), 3, 8))
