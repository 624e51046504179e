"""Shared pieces of the training-data operators: scratch tables, session limits, row keys."""

from __future__ import annotations

import atexit
import gc
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: space and the controls 9 to 13.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a folder of this process under a
    local master; on a cluster, where executors would not see such a folder, an error."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="sessiongrain-")
        spark.conf.set("spark.checkpoint.dir", path)
        atexit.register(shutil.rmtree, path.removeprefix("file://"), ignore_errors=True)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/sessiongrain/{tag}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it again: lineage ends at files that every executor can read."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._sessiongrain_path = path
    return out


def discard(*frames: DataFrame | None) -> None:
    """Delete tables of cut() that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_sessiongrain_path", None)
        if path:
            jvm = df.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished steps now, not when the driver next collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches by rows and bytes, so that very long texts do not meet in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def word_count(text: Column) -> Column:
    """Number of words of a text, null: 0."""
    words = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_CLASS + "+"))
    return words.cast("long")


ROW = ["__sg_file", "__sg_row"]


def with_row_id(docs: DataFrame) -> DataFrame:
    """docs with two columns that identify a row, the same at every evaluation.

    Parquet tables name their rows themselves (file and index in it). Any other input, file tables of formats
    without an index among them, is numbered and written to the shared folder once.
    """
    hidden = docs._jdf.queryExecution().analyzed().metadataOutput()
    fields = [f for i in range(hidden.size()) if hidden.apply(i).name() == "_metadata" for f in hidden.apply(i).dataType().fieldNames()]
    if "row_index" in fields:
        return docs.select("*", F.xxhash64("_metadata.file_path").alias(ROW[0]), F.col("_metadata.row_index").alias(ROW[1]))
    return cut(docs.select("*", F.lit(0).cast("long").alias(ROW[0]), F.monotonically_increasing_id().alias(ROW[1])), "numbered")


def let(value: Column, body) -> Column:
    """body(value), with value computed once a row even where body uses it within lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)
