"""Sources and sinks: line-wise JSON with rejects, CSV, archives, shards, upserts and immutable records."""

from __future__ import annotations

import io
import json
import os
import tomllib
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessiongrain.sources import byte_lines

MEMBER = "raw_trace_events.jsonl"


def read_json_lines(spark: SparkSession, path: str | list[str], recursive: bool = True) -> DataFrame:
    """(file, value, record): one row for each non-blank line; record is null where the line is no JSON object.

    Only newlines end a line, so other separators inside strings survive; a byte order mark is dropped.
    """
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", "*.json*").text(path)
    value = F.regexp_replace(F.regexp_replace("value", "^\uFEFF", ""), "\r$", "")
    rows = lines.select(F.col("_metadata.file_path").alias("file"), value.alias("value")).where(F.trim("value") != "")
    parsed = F.try_parse_json("value")
    return rows.withColumn("record", F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed))


def split_rejects(rows: DataFrame, limit: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects with a reason and the redacted start of the line)."""
    from sessiongrain.functions.scalars import redact

    bad = rows.where(F.col("record").isNull()).select("file", F.lit("not_a_json_object").alias("reason"), F.substring(redact(F.col("value")), 1, limit).alias("text"))
    return rows.where(F.col("record").isNotNull()), bad


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value) of the non-blank lines, with line numbers from 1 in each file; blank lines count. Files are read in ranges of bytes."""
    lines = byte_lines.read_byte_lines(spark, path)
    ranges = lines.groupBy("file", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("file", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return lines.where(F.trim("value") != "").join(ranges, ["file", "range"]).select("file", (F.col("before") + F.col("place") + 1).alias("line"), "value")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(file, member, crc32, size, line, value) for the one event member of every ZIP archive; others raise."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(bytes(content))) as archive:
                    members = [m for m in archive.infolist() if m.filename.rsplit("/", 1)[-1] == MEMBER]
                    if len(members) != 1:
                        raise ValueError(f"{name}: {len(members)} members named {MEMBER}")
                    crc, size = f"{members[0].CRC:08x}", members[0].file_size
                    with archive.open(members[0]) as handle:
                        block = []
                        for i, raw in enumerate(io.TextIOWrapper(handle, "utf-8-sig", newline="\n"), 1):
                            if raw.strip():
                                block.append((name, members[0].filename, crc, size, i, raw.rstrip("\r\n")))
                            if len(block) == 10_000:
                                yield pd.DataFrame(block, columns=["file", "member", "crc32", "size", "line", "value"])
                                block = []
                        yield pd.DataFrame(block, columns=["file", "member", "crc32", "size", "line", "value"])

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content").mapInPandas(lines, "file string, member string, crc32 string, size long, line long, value string")


def file_facts(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256, crc32) of every file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"), F.lpad(F.lower(F.hex(F.crc32("content"))), 8, "0").alias("crc32"))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with header, all strings; a byte order mark before the first name is dropped."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return df.toDF(*[c.lstrip("\uFEFF") for c in df.columns])


def fill_hierarchy(rows: DataFrame, parent: str, order: str) -> DataFrame:
    """Blank parents take the last one above them. A taxonomy is one small file in file order."""
    return rows.withColumn(parent, F.last(F.nullif(F.trim(parent), F.lit("")), ignorenulls=True).over(Window.orderBy(order)))


def id_list(lines: DataFrame, key: str = "trace_id") -> DataFrame:
    """Lines that are a bare id or an object with the id -> distinct ids."""
    return lines.where(F.trim("value") != "").select(F.coalesce(F.get_json_object("value", f"$.{key}"), F.trim("value")).alias(key)).distinct()


def select_known(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows of the wanted ids; an id that no row has is an error, raised at execution."""
    missing = wanted.join(rows.select(key).distinct(), key, "left_anti").agg(F.count("*").alias("missing"))
    checked = wanted.crossJoin(F.broadcast(missing)).where(F.when(F.col("missing") == 0, True).otherwise(F.raise_error(F.lit(f"unknown {key}")).cast("boolean")))
    return rows.join(checked.select(key), key, "left_semi")


def write_json(df: DataFrame, path: str, mode: str = "errorifexists", gzip: bool = False, max_records: int | None = None, by: list[str] | None = None) -> None:
    """JSON lines through the committer, so readers see all or nothing; shards are bounded by max_records."""
    writer = df.write.mode(mode).option("compression", "gzip" if gzip else "none")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    (writer.partitionBy(*by) if by else writer).json(path)


def write_sharded(df: DataFrame, path: str, shard_bytes: int, order: list[str]) -> None:
    """JSON shards of about shard_bytes: lines get shards by running size within hashed ranges of the order."""
    lines = df.select(F.to_json(F.struct(*df.columns)).alias("value"), *order)
    total = lines.agg(F.coalesce(F.sum(F.octet_length("value") + 1), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-int(total) // shard_bytes))
    lines.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("value").write.text(path)


def append_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both; columns that one lacks are null."""
    return old.unionByName(new, allowMissingColumns=True)


def upsert(base: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """delta's rows, and those of base whose key delta lacks. Null keys are keys."""
    same = None
    d = delta.select(*[F.col(k).alias(f"__d_{k}") for k in keys]).distinct()
    for k in keys:
        one = base[k].eqNullSafe(d[f"__d_{k}"])
        same = one if same is None else same & one
    return base.join(d, same, "left_anti").unionByName(delta, allowMissingColumns=True)


def add_immutable(base: DataFrame, new: DataFrame, key: str, ignore: tuple[str, ...] = ("registered_at",)) -> DataFrame:
    """base and the records that it lacks; a record with a known key must be equal but for `ignore`, else it raises."""
    content = [c for c in base.columns if c not in ignore]
    known = base.select(F.col(key), F.sha2(F.to_json(F.struct(*content)), 256).alias("__known"))
    fresh = new.join(known, key, "left").withColumn("__own", F.sha2(F.to_json(F.struct(*content)), 256))
    ok = F.when(F.col("__known").isNull(), True).when(F.col("__known") == F.col("__own"), False).otherwise(F.raise_error(F.concat(F.lit("conflicting record "), F.col(key).cast("string"))).cast("boolean"))
    return base.unionByName(fresh.where(ok).drop("__known", "__own"))


def registry_table(records: DataFrame) -> DataFrame:
    """Columns in order of their names, nested values as JSON."""
    nested = {f.name for f in records.schema.fields if f.dataType.typeName() in ("struct", "array", "map")}
    return records.select(*[F.to_json(c).alias(c) if c in nested else F.col(c) for c in sorted(records.columns)])


def markdown_table(rows: DataFrame, order: list[Column], most: int = 1000) -> str:
    """A Markdown table of a report of at most `most` rows; more are an error, never left out."""
    head = rows.columns
    held = rows.orderBy(*order).limit(most + 1).collect()
    if len(held) > most:
        raise ValueError(f"more than {most} rows: aggregate the report, or name a larger bound")
    cells = [[str("" if v is None else v).replace("|", "\\|").replace("\n", " ") for v in r] for r in held]
    return "\n".join("| " + " | ".join(r) + " |" for r in [head, ["---"] * len(head), *cells])


def append_durably(path: str, values: list[dict]) -> None:
    """Append JSON lines to a local log and force them to disk before returning: for a few approvals made by hand on the driver."""
    with open(path, "a", encoding="utf-8") as out:
        out.writelines(json_document(v) + "\n" for v in values)
        out.flush()
        os.fsync(out.fileno())


def read_settings(text: str, known: dict[str, str]) -> dict[str, str]:
    """KEY=VALUE lines (export, comments and quotes understood) added to `known`, whose own values win."""
    found: dict[str, str] = {}
    for line in text.splitlines():
        key, sign, value = line.strip().removeprefix("export ").partition("=")
        if sign and key.strip() and not key.startswith("#"):
            value = value.strip()
            found.setdefault(key.strip(), value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"" else value)
    return found | known


def provider_settings(text: str, name: str, required: tuple[str, ...] = ("base_url", "model")) -> dict:
    """The block [providers.name] of a TOML document; a missing block or key is an error."""
    block = tomllib.loads(text).get("providers", {}).get(name)
    if block is None or (missing := [k for k in required if k not in block]):
        raise ValueError(f"provider {name}: " + ("no such block" if block is None else f"without {', '.join(missing)}"))
    return block


def result_path(spark: SparkSession, root: str, batch: str, run: str, named: str | None = None) -> str:
    """The result file of a run: the named path if it exists, absolute or below root, else the only match of the run's folder; several are an error."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    there = lambda p: (at := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(at)
    for path in ([named, f"{root}/{named}"] if named else []):
        if there(path):
            return path
    top = jvm.org.apache.hadoop.fs.Path(f"{root}/{batch}/*{run}*/*.jsonl")
    found = [s.getPath().toString() for s in top.getFileSystem(conf).globStatus(top) or []]
    if len(found) != 1:
        raise ValueError(f"{len(found)} result files for {batch}/{run}")
    return found[0]


def crc32_hex(data: bytes) -> str:
    return f"{zlib.crc32(data):08x}"


def json_document(value: object) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
