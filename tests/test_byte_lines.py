"""Byte offsets, ranges and reads by seek against the files themselves."""

import os
import random

import pytest
from pyspark.sql import functions as F

from sessiongrain.sources import byte_lines as bl
from sessiongrain.sources import files


@pytest.fixture
def folder(tmp_path):
    rnd = random.Random(2)
    made = {
        "a.jsonl": b'\xef\xbb\xbf{"a":1}\n\n{"a":2}\r\n  \n{"a":3}',
        "b.jsonl": b"".join(("x" * rnd.randint(0, 40) + rnd.choice(["\n", "\r\n", "\n\n", " é😀\n"])).encode() for _ in range(300)),
        "sub/c.jsonl": b"\n\n\n",
        "long.jsonl": b"y" * 5000 + b"\n" + b"z" * 3000 + b"\nend\n",
        "empty.jsonl": b"",
    }
    os.makedirs(tmp_path / "sub")
    for name, raw in made.items():
        (tmp_path / name).write_bytes(raw)
    return tmp_path, made


def brute(raw):
    """(offset, length, text) of every line."""
    out, at = [], 0
    for line in raw.split(b"\n")[: -1 if raw.endswith(b"\n") or not raw else None]:
        out.append((at, len(line), (line[3:] if at == 0 and line.startswith(b"\xef\xbb\xbf") else line).decode().removesuffix("\r")))
        at += len(line) + 1
    return out


@pytest.mark.parametrize("range_bytes", [1, 300, 1 << 20])
def test_offsets_and_numbers_are_true(spark, folder, tmp_path_factory, range_bytes):
    path, made = folder
    if range_bytes == 1:
        made = {"a.jsonl": made["a.jsonl"]}
        path = path / "a.jsonl"
    lines = bl.read_byte_lines(spark, str(path), range_bytes)
    got = sorted((r.file.removeprefix(f"{folder[0]}/"), r.offset, r.length, r.value) for r in lines.collect())
    assert got == sorted((n, *x) for n, raw in made.items() for x in brute(raw))
    at = str(tmp_path_factory.mktemp("index") / "x")
    bl.write_index(lines, at, first=F.substring("value", 1, 1))
    want = []
    for n, raw in made.items():
        full = [(i + 1, o, t) for i, (o, _, t) in enumerate(brute(raw)) if t.strip(" ")]
        want += [(n, line, k, o, t[:1]) for k, (line, o, t) in enumerate(full)]
    index = bl.read_index(spark, at)
    assert sorted((r.file.removeprefix(f"{folder[0]}/"), r.physical_line, r.record_index, r.offset, r.first) for r in index.collect()) == sorted(want)


def test_only_asked_ranges_are_read(spark, folder, tmp_path_factory):
    path, made = folder
    lines = bl.read_byte_lines(spark, str(path), 1000)
    b = f"{path}/b.jsonl"
    few = bl.read_byte_lines(spark, str(path), 64, files=[b], least=200, most=259)
    assert few.rdd.getNumPartitions() == 2
    assert sorted(r.offset for r in few.collect()) == [o for o, _, _ in brute(made["b.jsonl"]) if 200 <= o <= 259]
    assert bl.read_byte_lines(spark, str(path), 64, files=[b]).rdd.getNumPartitions() == -(-len(made["b.jsonl"]) // 64)
    assert bl.read_byte_lines(spark, str(path), files=[]).count() == 0
    at = str(tmp_path_factory.mktemp("index") / "x")
    bl.write_index(lines, at)
    index = bl.read_index(spark, at).drop("range", "place")
    wanted = index.where((F.col("file") == f"{path}/long.jsonl") & (F.col("offset") > 0) | (F.col("file") == f"{path}/a.jsonl"))
    rows = bl.fetch_lines(wanted).collect()
    assert sorted(r.value for r in rows) == sorted(["z" * 3000, "end", '{"a":1}', '{"a":2}', '{"a":3}'])
    assert sum(r.bytes_read for r in rows) == 3004 + len(made["a.jsonl"])
    (path / "a.jsonl").write_bytes(b"changed")
    with pytest.raises(Exception, match="changed since"):
        bl.fetch_lines(wanted).collect()


def test_episodes_take_the_next_real_user_turn(spark):
    index = spark.createDataFrame([("t", k, k in (0, 4, 6), k * 10) for k in range(8)] + [("u", 0, True, 0)], "trace string, pos int, real boolean, offset long")
    episodes = spark.createDataFrame([("t", 1, 2), ("t", 5, 9), ("u", 0, 0)], "trace string, start int, end int")
    got = sorted(tuple(r) for r in bl.episode_lines(index, episodes, "trace", "pos", "real").select("trace", "start", "pos", "is_ahead").collect())
    assert got == [("t", 1, 1, False), ("t", 1, 2, False), ("t", 1, 4, True), ("t", 5, 5, False), ("t", 5, 6, False), ("t", 5, 7, False), ("u", 0, 0, False)]


def test_scattered_traces(spark):
    index = spark.createDataFrame([("f", "a", 0), ("f", "a", 1), ("f", "b", 2), ("f", "a", 3)], "file string, trace string, record_index long")
    assert [tuple(r) for r in bl.scattered_traces(index, "trace").collect()] == [("f", "a")]


def test_numbered_lines_of_ranges(spark, folder):
    path, made = folder
    got = sorted((os.path.basename(r.file), r.line, r.value) for r in files.read_numbered_lines(spark, str(path)).collect())
    assert got == sorted((os.path.basename(n), i + 1, t) for n, raw in made.items() for i, (_, _, t) in enumerate(brute(raw)) if t.strip())
