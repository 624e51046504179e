"""Lines of raw files by byte range: a data source whose partitions are ranges, an index of true offsets, and reads by seek."""

from __future__ import annotations

import json
import re
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.window import Window

RANGE_BYTES = 32 << 20
BLOCK = 1 << 20
BATCH_LINES = 5_000
BOM = b"\xef\xbb\xbf"
#: Lines of one file at most this far apart are fetched by one read.
GAP = 4096
LINE_SCHEMA = "file string, size long, range long, place long, offset long, length long, value string"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir; a local master without one gets a folder of its own."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="sessiongrain-lines-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def _opened(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a URI (file, hdfs, s3, ...), and the path within it; plain paths are local."""
    return arrow_fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path)) if ":" in path.split("/")[0] else (arrow_fs.LocalFileSystem(), path)


def _text(raw: bytes, offset: int) -> str:
    """A line's text: without a byte order mark at the start of its file, and without the return before its newline."""
    raw = raw[len(BOM) :] if offset == 0 and raw.startswith(BOM) else raw
    return (raw[:-1] if raw.endswith(b"\r") else raw).decode("utf-8", "replace")


@dataclass
class ByteRange(InputPartition):
    file: str
    size: int
    range: int
    start: int
    end: int


class ByteLines(DataSource):
    """format("byte_lines"): one row for each line, blank ones too, of all files below `path`; a file is read as ranges of `rangeBytes`.

    A line belongs to the range in which it starts, whichever range it ends in. offset and length are bytes of
    the file, without the newline, with a byte order mark and a return, which value lacks; place counts the range's lines.
    Options `files` (JSON list), `from` and `to` (offsets) leave out files and ranges before anything is opened. They are options and
    not pushed filters, as Spark 4.1 keeps a data frame's reader, so that one query's filters would hold for its next as well.
    """

    @classmethod
    def name(cls) -> str:
        return "byte_lines"

    def schema(self) -> str:
        return LINE_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        get = self.options.get
        files = json.loads(get("files", "null"))
        return ByteLineReader(self.options["path"], int(get("rangeBytes", RANGE_BYTES)), get("suffix", ""), files, int(get("from", 0)), int(get("to")) if get("to") else None)


class ByteLineReader(DataSourceReader):
    def __init__(self, path: str, range_bytes: int, suffix: str, files: list[str] | None, least: int, most: int | None):
        self.path, self.range_bytes, self.suffix, self.files, self.least, self.most = path, range_bytes, suffix, files, least, most

    def partitions(self) -> list[ByteRange]:
        system, root = _opened(self.path)
        info = system.get_file_info(root)
        found = [info] if info.is_file else system.get_file_info(arrow_fs.FileSelector(root, recursive=True))
        scheme = self.path[: self.path.index(root)] if root in self.path else ""
        out = []
        for f in sorted((x for x in found if x.is_file and x.size and x.path.endswith(self.suffix) and not x.base_name.startswith(("_", "."))), key=lambda x: x.path):
            name = scheme + f.path
            if self.files is not None and name not in self.files:
                continue
            for k, start in enumerate(range(0, f.size, self.range_bytes)):
                end = min(start + self.range_bytes, f.size)
                if end > self.least and (self.most is None or start <= self.most):
                    out.append(ByteRange(name, f.size, k, start, end))
        return out or [ByteRange("", 0, 0, 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.size:
            return
        rows: list[tuple[int, bytes]] = []
        place = 0
        for line in _lines(partition):
            rows.append(line)
            if len(rows) == BATCH_LINES:
                yield _batch(partition, place, rows)
                place, rows = place + len(rows), []
        if rows:
            yield _batch(partition, place, rows)


def _lines(part: ByteRange) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of the lines that start within the range; a block is held at a time, and a line that goes on beyond it."""
    system, path = _opened(part.file)
    with system.open_input_file(path) as stream:
        at = part.start
        if at:  # the line that the byte before belongs to is another range's
            stream.seek(at - 1)
            at -= 1
        skipping, held = bool(part.start), []  # parts of a line that goes on in the next block
        while block := stream.read(BLOCK):
            first, *others = block.split(b"\n")
            held.append(first)
            for following in others:
                line, held = b"".join(held), [following]
                if not skipping:
                    yield at, line
                skipping = False
                at += len(line) + 1
                if at >= part.end:
                    return
            if skipping:  # another range reads this line
                at, held = at + sum(map(len, held)), []
        if any(held) and not skipping:
            yield at, b"".join(held)


def _batch(part: ByteRange, place: int, rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    n = len(rows)
    columns = [pa.array([part.file] * n), pa.array([part.size] * n, pa.int64()), pa.array([part.range] * n, pa.int64()), pa.array(range(place, place + n), pa.int64())]
    columns += [pa.array([o for o, _ in rows], pa.int64()), pa.array([len(b) for _, b in rows], pa.int64()), pa.array([_text(b, o) for o, b in rows], pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["file", "size", "range", "place", "offset", "length", "value"])


def read_byte_lines(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, suffix: str = "", files: list[str] | None = None, least: int = 0, most: int | None = None) -> DataFrame:
    """See ByteLines. With files, least and most, only lines of these files that start at offsets from least to most, and only their ranges are read."""
    spark.dataSource.register(ByteLines)
    reader = spark.read.format("byte_lines").option("path", path).option("rangeBytes", range_bytes).option("suffix", suffix)
    lines = reader.option("files", json.dumps(files)).option("from", least).option("to", "" if most is None else most).load()
    return lines.where((F.col("offset") >= least) & (F.lit(True) if most is None else F.col("offset") <= most))


def write_index(lines: DataFrame, path: str, **keys: Column) -> None:
    """Write the index of lines to `path`: where each line stands, whether it is blank, and `keys` computed from its `value`."""
    lines.select("file", "size", "range", "place", "offset", "length", (F.trim("value") == "").alias("blank"), *[c.alias(k) for k, c in keys.items()]).write.parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index without blank lines, with `physical_line` (from 1, blank lines count) and `record_index` (from 0, they don't).

    A line's number is its place in its range and the lines of the file's ranges before, of which there is one row each.
    """
    index = spark.read.parquet(path)
    ranges = index.groupBy("file", "range").agg(F.count("*").alias("lines"), F.count_if(~F.col("blank")).alias("records"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("file", "range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("lines", "records")])
    inside = Window.partitionBy("file", "range").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    counted = index.withColumn("records", F.coalesce(F.sum((~F.col("blank")).cast("long")).over(inside), F.lit(0)))
    out = counted.where(~F.col("blank")).join(ranges, ["file", "range"])
    out = out.withColumns({"physical_line": F.col("lines_before") + F.col("place") + 1, "record_index": F.col("records_before") + F.col("records")})
    return out.drop("blank", "records", "lines_before", "records_before")


def scattered_traces(index: DataFrame, trace: str) -> DataFrame:
    """(file, trace) of traces whose lines do not stand together in their file: episodes of them cannot be one read."""
    spans = index.groupBy("file", trace).agg((F.max("record_index") - F.min("record_index") + 1).alias("span"), F.count("*").alias("n"))
    return spans.where("span > n").select("file", trace)


def episode_lines(index: DataFrame, episodes: DataFrame, trace: str, position: str, real_user: str) -> DataFrame:
    """Index rows of each episode, [start, end] of its trace, and of the first real user turn behind it (is_ahead)."""
    both = episodes.join(index, trace)
    within = both.where(F.col(position).between(F.col("start"), F.col("end"))).withColumn("is_ahead", F.lit(False))
    behind = both.where((F.col(position) > F.col("end")) & F.col(real_user))
    first = behind.groupBy(*episodes.columns).agg(F.min_by(F.struct(*index.drop(trace).columns), position).alias("x"))
    return within.unionByName(first.select(*episodes.columns, "x.*").withColumn("is_ahead", F.lit(True)))


def fetch_lines(wanted: DataFrame) -> DataFrame:
    """wanted (file, size, offset, length, ...) with `value`, read by seek, and `bytes_read`: what the read cost, at its first line.

    Rows are put in order of file and offset, so a task opens a file once, and lines that stand near each other are one
    read. A file that has another size than the index says raises.
    """
    kinds = {f.name: f.dataType.simpleString() for f in wanted.schema.fields}
    schema = ", ".join(f"`{k}` {v}" for k, v in kinds.items()) + ", value string, bytes_read long"
    file, size, offset, length = (list(kinds).index(c) for c in ("file", "size", "offset", "length"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, stream = None, None
        for batch in batches:
            files, sizes, offsets, lengths = (batch.column(i).to_pylist() for i in (file, size, offset, length))
            values, costs, k = [], [], 0
            while k < len(files):
                if files[k] != name:
                    if stream is not None:
                        stream.close()
                    name, (system, path) = files[k], _opened(files[k])
                    stream = system.open_input_file(path)
                    if stream.size() != sizes[k]:
                        raise ValueError(f"{name} has changed since it was indexed")
                last, end = k, offsets[k] + lengths[k]
                while last + 1 < len(files) and files[last + 1] == name and offsets[last + 1] <= end + GAP and end - offsets[k] < BLOCK:
                    last += 1
                    end = max(end, offsets[last] + lengths[last])
                stream.seek(offsets[k])
                raw = stream.read(end - offsets[k])
                values += [_text(raw[offsets[i] - offsets[k] : offsets[i] - offsets[k] + lengths[i]], offsets[i]) for i in range(k, last + 1)]
                costs += [len(raw)] + [0] * (last - k)
                k = last + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.string()), pa.array(costs, pa.int64())], [*kinds, "value", "bytes_read"])
        if stream is not None:
            stream.close()

    return wanted.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, schema)
