"""Intermediate tables of one run of an operator, in the folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sessiongrain.sources.byte_lines import shared_folder


def cuts(spark: SparkSession, purpose: str) -> Callable[[DataFrame, str], DataFrame]:
    """A function (df, name) that writes df once and gives it reread, so that lost executors repeat nothing before it."""
    folder = f"{shared_folder(spark)}/sessiongrain/{purpose}-{uuid.uuid4().hex[:12]}"

    def cut(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    return cut
