"""Products of a batch: source records, lineage, turns and traces, written together and committed at once."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessiongrain.functions.scalars import digest_id
from sessiongrain.sources import files

VERSION = "v2.0"
MANIFEST = "batch_manifest.json"
#: Events of one row of the turn product; longer turns go on in further parts.
MOST_EVENTS = 10_000


def source_ref(events: DataFrame, pointer: Column | None = None) -> DataFrame:
    """events with `source_ref` (source_record_id, json_pointer): where in which source record each event stands."""
    source = F.struct(digest_id("src", F.col("input_file"), F.col("record_index")).alias("source_record_id"), (F.lit("") if pointer is None else pointer).alias("json_pointer"))
    return events.withColumn("source_ref", source)


def source_product(rows: DataFrame, dataset_id: str, batch_id: str) -> DataFrame:
    """(file, record_index, record JSON) -> one row a source record, with the digest of its content."""
    return rows.select(
        F.lit(VERSION).alias("schema_version"), F.lit(dataset_id).alias("dataset_id"), F.lit(batch_id).alias("batch_id"), digest_id("src", F.col("file"), F.col("record_index")).alias("source_record_id"),
        F.col("file").alias("source_file"), "record_index", F.sha2("record", 256).alias("content_sha256"), "record",
    )


def lineage_product(events: DataFrame, dataset_id: str, batch_id: str) -> DataFrame:
    return events.select(F.lit(VERSION).alias("schema_version"), F.lit(dataset_id).alias("dataset_id"), F.lit(batch_id).alias("batch_id"), F.col("source_ref.source_record_id").alias("source_record_id"), "event_id", F.lit("normalized_from").alias("edge"), F.col("source_ref.json_pointer").alias("json_pointer"))


def _event() -> Column:
    return F.struct("event_id", "sequence", "type", "data", "source_ref")


def turn_product(events: DataFrame, dataset_id: str, batch_id: str, context: Mapping[str, Column] | None = None, most_events: int = MOST_EVENTS) -> DataFrame:
    """One row for each turn (and part of it) with its events in order, where they come from, and `context`: named aggregates of its events.

    turn_index counts the turns of a session by their first event. Events without a turn stand in the trace product.
    """
    keys = ["trace_id", "session_id", "turn_id"]
    assigned = events.where(F.col("turn_id").isNotNull())
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("sequence", "event_id"))
    parts = assigned.withColumn("part", F.floor((place - 1) / most_events).cast("int"))
    rows = parts.groupBy(*keys, "part").agg(F.array_sort(F.collect_list(F.struct("sequence", "event_id", _event().alias("e")))).alias("e"), F.array_sort(F.collect_set("source_ref.source_record_id")).alias("source_record_ids"))
    shape = {k: v.alias(k) for k, v in (context or {}).items()}
    whole = assigned.groupBy(*keys).agg(F.min("sequence").alias("first"), F.count("*").alias("n_events"), *shape.values())
    index = F.row_number().over(Window.partitionBy("trace_id", "session_id").orderBy("first", "turn_id")) - 1
    whole = whole.withColumn("turn_index", index)
    return rows.join(whole, keys).select(
        F.lit(VERSION).alias("schema_version"), F.lit(dataset_id).alias("dataset_id"), F.lit(batch_id).alias("batch_id"), *keys, "turn_index", "part", "n_events",
        F.struct(*shape).alias("execution_context") if shape else F.lit(None).cast("string").alias("execution_context"), F.col("e.e").alias("events"), F.struct("source_record_ids").alias("lineage"),
    )


def trace_product(events: DataFrame, turns: DataFrame, dataset_id: str, batch_id: str) -> DataFrame:
    """One row for each trace: its sessions, each with references to its turns in order and the events that no turn has."""
    keys = ["trace_id", "session_id"]
    refs = turns.where("part = 0").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("turn_index", "turn_id", "n_events"))).alias("turn_refs"))
    loose = events.where(F.col("turn_id").isNull()).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("sequence", "event_id", _event().alias("e")))).alias("loose"))
    empty = lambda c: F.coalesce(F.col(c), F.array())
    sessions = refs.join(loose, keys, "full").select(*keys, empty("turn_refs").alias("turn_refs"), empty("loose.e").alias("unassigned_events"))
    traces = sessions.groupBy("trace_id").agg(F.array_sort(F.collect_list(F.struct("session_id", "turn_refs", "unassigned_events"))).alias("sessions"))
    return traces.select(F.lit(VERSION).alias("schema_version"), F.lit(dataset_id).alias("dataset_id"), F.lit(batch_id).alias("batch_id"), "trace_id", "sessions")


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """The manifest of a committed batch, or None: a folder without one is no batch."""
    system, at = _files(spark, f"{path}/{MANIFEST}")
    return json.loads(spark.read.text(f"{path}/{MANIFEST}", wholetext=True).first()[0]) if system.exists(at) else None


def coverage_errors(spark: SparkSession, path: str, expected_events: int) -> list[str]:
    """What the written products of a batch leave out: every event is mapped to a source record, and is in one turn or in none."""
    read = lambda name: spark.read.json(f"{path}/{name}")
    mapped = read("lineage_edges").select("event_id").distinct().count()
    in_turns = read("unified_turns").select(F.coalesce(F.sum(F.size("events")), F.lit(0)).alias("n")).first()["n"]
    sessions = read("unified_traces").select(F.explode("sessions").alias("s"))
    loose = sessions.select(F.coalesce(F.sum(F.size("s.unassigned_events")), F.lit(0)).alias("n")).first()["n"]
    checks = [(mapped == expected_events, f"{mapped} of {expected_events} events are mapped to a source record"), (in_turns + loose == expected_events, f"turns and traces hold {in_turns + loose} of {expected_events} events")]
    return [said for good, said in checks if not good]


def materialise(spark: SparkSession, products: Mapping[str, DataFrame], path: str, manifest: Mapping[str, object], fingerprint: str, check: Callable[[str], list[str]] | None = None, shard_records: int | None = None) -> dict:
    """Write all products of a batch, check them, and make them visible at once; returns the manifest.

    Products go to a folder beside `path`; tasks commit their files there as Spark's writers do. A failed task, product or check
    deletes that folder and raises, and what stood at `path` stays. Else the manifest is written and the folder gets its name in one
    rename. A batch that is there already is never written again: with the same fingerprint its manifest is returned, with another it raises.
    """
    known = read_manifest(spark, path)
    if known is not None:
        if known["source_fingerprint"] != fingerprint:
            raise ValueError(f"an immutable batch with other sources stands at {path}")
        return known | {"deduplicated": True}
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex[:12]}"
    system, at = _files(spark, staging)
    try:
        counts = {}
        for name, df in products.items():
            files.write_json(df, f"{staging}/{name}", max_records=shard_records)
            counts[name] = spark.read.text(f"{staging}/{name}").count()
        if problems := (check(staging) if check else []):
            raise ValueError("; ".join(problems))
        whole = {**manifest, "source_fingerprint": fingerprint, "products": {k: {"version": VERSION, "record_count": n} for k, n in counts.items()}}
        out = system.create(spark._jvm.org.apache.hadoop.fs.Path(f"{staging}/{MANIFEST}"), False)
        out.write(bytearray(json.dumps(whole, ensure_ascii=False, sort_keys=True).encode()))
        out.close()
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        if system.exists(target) or not system.rename(at, target):
            raise ValueError(f"{path} was written meanwhile")
        return whole
    finally:
        if system.exists(at):
            system.delete(at, True)
