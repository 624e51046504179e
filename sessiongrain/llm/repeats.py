"""Repeated substrings by prefix-free parsing: phrases, their dictionary, and suffixes of those that share a core."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessiongrain.llm.common import ROW, bounded_batches, cut, discard, read_table, release, with_row_id
from sessiongrain.llm.near_duplicates import text_buffers
from sessiongrain.llm.passages import shared_passages
from sessiongrain.llm.phrases import BASE, GRAM, SPAN, TABLE, digests, hasher, phrases, pieces

LENGTH = 400
#: Passages of over 50 words that another text holds are reported beside what is removed.
PASSAGE_WORDS = 51
#: Cores that more dictionary phrases share than this are resolved by shuffles of blocks and single windows.
LOCAL_PHRASES = 512
#: Window places of one block where a crowded core is resolved.
BLOCK = 16


def parse(rows: DataFrame, length: int, span: int, core: int) -> DataFrame:
    """(ROW columns, text) -> the parse, one row per phrase: ROW columns, a, b, t (places of its text), core, phrase.

    core and phrase are hashes of the bytes at the trigger, which all of the phrase's windows hold, and of
    the whole phrase; together they name the phrase with 128 bits.
    """
    bounded_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(2))
            for first, last in pieces(offsets):
                part, at = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
                text, a, b, t = phrases(part, at, length, span)
                base = at[text]
                keys = [batch.column(i).take(pa.array(text + first)) for i in (0, 1)]
                whole = [digests(part, x, y, seed).view(np.int64) for x, y, seed in ((t, t + core, 1), (a, b + length, 2))]
                yield pa.RecordBatch.from_arrays([*keys, *[pa.array((x - base).astype(np.int32)) for x in (a, b, t)], *map(pa.array, whole)], [*ROW, "a", "b", "t", "core", "phrase"])

    return rows.select(*ROW, "text").mapInArrow(run, f"{ROW[0]} long, {ROW[1]} long, a int, b int, t int, core long, phrase long")


def _window_hashes(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    return hasher(TABLE[data])(starts, starts + length)


def _windows(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, start within it) of every window of the phrases data[offsets[i] : offsets[i + 1])."""
    count = np.diff(offsets) - length + 1
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)


def _runs(owner: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted windows joined where starts follow each other: (owner, from, to)."""
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)])) if len(owner) else np.zeros(0, np.int64)
    last = np.concatenate([new[1:], [len(owner)]]).astype(np.int64) - 1 if len(new) else new
    return owner[new], start[new], start[last] + length


_SPAN_SCHEMA = f"{ROW[0]} long, {ROW[1]} long, from int, to int"


def _span_batch(batch: pa.RecordBatch, owner: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    a = batch.column(2).to_numpy()[owner]
    keys = [batch.column(i).take(pa.array(owner)) for i in (0, 1)]
    return pa.RecordBatch.from_arrays([*keys, pa.array((a + begin).astype(np.int32)), pa.array((a + end).astype(np.int32))], [*ROW, "from", "to"])


def _local(length: int):
    """Repeated windows among the dictionary phrases of each core, from rows sorted by core.

    The suffixes of a core's phrases are ordered by (place from the trigger, digest of their first `length`
    bytes): equal neighbours have a common prefix of `length` or more.
    """

    def solve(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_buffers(batch.column(5).cast(pa.large_binary()))
        owner, start = _windows(data, offsets, length)
        digest = _window_hashes(data, offsets[owner] + start, length)
        core = batch.column(4).to_numpy()[owner]
        place = (batch.column(3).to_numpy() - batch.column(2).to_numpy())[owner] - start
        order = np.lexsort((digest, place, core))
        same = (core[order[1:]] == core[order[:-1]]) & (place[order[1:]] == place[order[:-1]]) & (digest[order[1:]] == digest[order[:-1]])
        hit = np.zeros(len(order), bool)
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
        return _span_batch(batch, *_runs(owner[hit], start[hit], length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def joined() -> pa.RecordBatch:
            return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        for batch in batches:
            at = 0
            core = batch.column(4).to_numpy()
            # Whole groups of cores in portions of some thousand phrases: only the last core of a batch may go on.
            while len(core) - at > 2048:
                stop = at + 2048 + int(np.searchsorted(core[at + 2048 :] != core[at + 2047], True))
                if stop >= len(core):
                    break
                held.append(batch.slice(at, stop - at))
                yield solve(joined())
                held, at = [], stop
            rest = batch.slice(at)
            if held and rest.num_rows and held[-1].column(4)[-1] != rest.column(4)[0]:
                yield solve(joined())
                held = []
            held.append(rest)
            if sum(x.num_rows for x in held) > 4096:
                last = joined()
                core = last.column(4).to_numpy()
                stop = int(np.searchsorted(core == core[-1], True))
                if stop:
                    yield solve(last.slice(0, stop))
                held = [last.slice(stop)]
        if held and sum(x.num_rows for x in held):
            yield solve(joined())

    return run


def _blocks(length: int):
    """Phrases cut into blocks of BLOCK window places, counted from the trigger: ROW columns, a, from, to, core, block, inner, outer.

    inner hashes the bytes that every window of the whole block holds, outer those of the windows that the
    phrase has there, with their places: windows of one block can be equal only where inner is, and all are
    where outer is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 2048):
                batch = whole.slice(k, 2048)
                data, offsets = text_buffers(batch.column(5).cast(pa.large_binary()))
                a = batch.column(2).to_numpy().astype(np.int64)
                high = batch.column(3).to_numpy() - a  # the place of the first window
                low = high - (np.diff(offsets) - length)  # and of the last one
                count = high // BLOCK - low // BLOCK + 1
                owner = np.repeat(np.arange(len(a)), count)
                block = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + (low // BLOCK)[owner]
                first, last = np.minimum(high[owner], block * BLOCK + BLOCK - 1), np.maximum(low[owner], block * BLOCK)
                trigger = offsets[:-1][owner] + high[owner]
                inner = digests(data, trigger - block * BLOCK, trigger - block * BLOCK + length - BLOCK + 1, 3)
                outer = digests(data, trigger - first, trigger - last + length, 4)
                with np.errstate(over="ignore"):
                    outer ^= (first * BLOCK + last % BLOCK).astype(np.uint64) * np.uint64(BASE)
                at = a[owner] + high[owner]
                keys = [batch.column(i).take(pa.array(owner)) for i in (0, 1, 2, 4)]
                yield pa.RecordBatch.from_arrays(
                    [*keys[:3], pa.array((at - first).astype(np.int32)), pa.array((at - last + length).astype(np.int32)), keys[3], pa.array(block.astype(np.int32)), pa.array(inner.view(np.int64)), pa.array(outer.view(np.int64))],
                    [*ROW, "a", "from", "to", "core", "block", "inner", "outer"],
                )

    return run


def _single(length: int):
    """The windows of parts of phrases as rows: ROW columns, start, core, place, digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 2048):
                batch = whole.slice(k, 2048)
                data, offsets = text_buffers(batch.column(5).cast(pa.large_binary()))
                owner, start = _windows(data, offsets, length)
                digest = _window_hashes(data, offsets[owner] + start, length).view(np.int64)
                a = batch.column(2).to_numpy()[owner]
                place = batch.column(3).to_numpy()[owner] - a - start
                keys = [batch.column(i).take(pa.array(owner)) for i in (0, 1, 4)]
                yield pa.RecordBatch.from_arrays([keys[0], keys[1], pa.array((a + start).astype(np.int32)), keys[2], pa.array(place.astype(np.int32)), pa.array(digest)], [*ROW, "start", "core", "place", "digest"])

    return run


def _crowded(phrases_: DataFrame, length: int) -> DataFrame:
    """Repeated windows of phrases (ROW columns, a, t, core, bytes) whose cores have too many for one task: (ROW columns, from, to).

    First by blocks of places: rows that share inner and outer are settled as a whole, those whose inner occurs
    once hold no repeat. Only blocks that share inner and differ in outer, one copy of each, go on as single
    windows. Groups are counts and minima, so a core of any size is spread over tasks.
    """
    dealt = phrases_.repartition(*ROW, "a")
    blocks = cut(dealt.mapInArrow(_blocks(length), f"{ROW[0]} long, {ROW[1]} long, a int, from int, to int, core long, block int, inner long, outer long"), "blocks")
    group = ["core", "block", "inner"]
    classes = cut(blocks.groupBy(*group, "outer").agg(F.count("*").alias("copies"), F.min(F.struct(*ROW, "a", "from", "to")).alias("one")), "classes")
    settled = blocks.join(classes.where("copies > 1").select(*group, "outer"), [*group, "outer"]).select(*ROW, "from", "to")
    several = classes.groupBy(*group).agg(F.count("*").alias("n")).where("n > 1").select(*group)
    open_ = classes.join(several, group).select("one.*")
    asked = open_.groupBy(*ROW, "a").agg(F.collect_list(F.struct("from", "to")).alias("parts"))  # one phrase's blocks
    parts = phrases_.join(asked, [*ROW, "a"]).select("*", F.explode("parts").alias("p"))
    parts = parts.select(*ROW, F.col("p.from").alias("a"), "t", "core", F.substring(F.col("bytes"), F.col("p.from") - F.col("a") + 1, F.col("p.to") - F.col("p.from")).alias("bytes"))
    single = parts.mapInArrow(_single(length), f"{ROW[0]} long, {ROW[1]} long, start int, core long, place int, digest long")
    single = cut(single, "windows")
    twice = single.groupBy("core", "place", "digest").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    far = single.join(twice, ["core", "place", "digest"]).select(*ROW, F.col("start").alias("from"), (F.col("start") + length).alias("to"))
    return settled.unionByName(far)


def repeated_spans(rows: DataFrame, length: int = LENGTH, local: int = LOCAL_PHRASES, span: int | None = None) -> DataFrame:
    """(ROW columns, text) -> (ROW columns, from, to): byte ranges whose windows of `length` bytes all occur elsewhere too.

    1. Parse: hash triggers cut every text into phrases; a window's first trigger, and the core behind it, are the
       same in every copy, so a repeated window lies in phrases that share their core.
    2. Dictionary: distinct phrases of repeated cores, with their frequencies. All windows of a phrase that
       occurs twice are repeated (the parse alone decides them).
    3. Suffixes: where a core has several phrases, one copy of each is fetched, and the suffixes that start
       in them are ordered by core, place and first `length` bytes; equal neighbours are repeated. Small cores
       are sorted in one task with many others; cores with more than `local` phrases, of any size, go through
       shuffles of blocks of windows, and of single windows where blocks leave it open, with partial counts.
    """
    if length < 2 * BLOCK:
        raise ValueError(f"strings of at least {2 * BLOCK} bytes")
    span = span or min(SPAN, length * 3 // 5)
    core = length - span
    parsed = cut(parse(rows, length, span, core), "parse")
    # Counts are tables of their own: their joins have plain exchanges, which AQE splits where a core is hot.
    counts = cut(parsed.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core"), "cores")
    shared = cut(parsed.join(counts, "core"), "shared")
    discard(parsed, counts)
    release(rows.sparkSession)
    one = F.min(F.struct(*ROW, "a", "b", "t")).alias("one")
    dictionary = cut(shared.groupBy("core", "phrase").agg(F.count("*").alias("copies"), one), "dictionary")
    often = dictionary.where("copies > 1").select("core", "phrase")
    spans = shared.join(often, ["core", "phrase"]).select(*ROW, F.col("a").alias("from"), (F.col("b") + length).alias("to"))
    spans = cut(spans, "spans")
    several = cut(dictionary.groupBy("core").agg(F.count("*").alias("phrases")).where("phrases > 1"), "several")
    wanted = dictionary.join(several, "core").select("one.*", "core", (F.col("phrases") <= local).alias("few"), (F.col("copies") == 1).alias("open"))
    wanted = cut(wanted, "wanted")
    discard(shared, dictionary, several)
    release(rows.sparkSession)
    asked = wanted.groupBy(*ROW).agg(F.collect_list(F.struct("a", "b", "t", "core", "few")).alias("asked"))  # a text's own phrases

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for f, r, text, phrases_ in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2, 3)], strict=True):
                raw = text.encode()
                out += [(f, r, p["a"], p["t"], p["core"], raw[p["a"] : p["b"] + length], p["few"]) for p in phrases_]
                if len(out) > 4000:
                    yield _fetched(out)
                    out = []
            if out:
                yield _fetched(out)

    fetched = rows.select(*ROW, "text").join(asked.hint("shuffle_hash"), ROW).mapInArrow(fetch, f"{ROW[0]} long, {ROW[1]} long, a int, t int, core long, bytes binary, few boolean")
    fetched = cut(fetched, "phrases")
    release(rows.sparkSession)
    near = fetched.where("few").drop("few").repartition("core").sortWithinPartitions("core").mapInArrow(_local(length), _SPAN_SCHEMA)
    far = _crowded(fetched.where("not few").drop("few"), length)
    return spans.unionByName(near).unionByName(far)


def _fetched(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], [*ROW, "a", "t", "core", "bytes", "few"])


def _merged(owner: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of each owner joined where they meet: (owner, from, to), in order."""
    order = np.lexsort((begin, owner))
    high = owner[order] << 32  # an owner's places are above all of those before it
    begin, end = high | begin[order], np.maximum.accumulate(high | end[order])
    new = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]])) if len(begin) else np.zeros(0, np.int64)
    last = np.concatenate([new[1:], [len(begin)]])[: len(new)] - 1
    low = (1 << 32) - 1
    return begin[new] >> 32, begin[new] & low, end[last] & low


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", local: int = LOCAL_PHRASES, span: int | None = None, passage_words: int | None = None) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (array of from, to, in bytes), kept (binary), n_passages, n_passage_words.

    Every byte covered by a `length`-byte string that also starts elsewhere in the corpus, the same text
    included, is removed; overlapping copies count, matches never cross texts, and strings are judged on the
    input. Null texts are empty; texts shorter than `length` stay; a text's equal copy removes both; null
    and repeated ids are carried; empty in, empty out. n_passages and n_passage_words count the maximal runs of words, and
    their words, that `passage_words` successive words of another row cover (null without that setting); a passage
    can be shorter than `length` bytes, and what only this row repeats is none. They do not change what is removed.
    """
    bounded_batches(docs.sparkSession, 500)
    rows = with_row_id(docs).select(*ROW, F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spans = cut(repeated_spans(rows, length, local, span), "covered").withColumn("words", F.lit(False))
    release(docs.sparkSession)
    if passage_words is not None:
        spans = spans.unionByName(cut(shared_passages(rows, passage_words), "passages").withColumn("words", F.lit(True)))
        release(docs.sparkSession)
    mine = spans.groupBy(*ROW).agg(F.collect_list(F.struct("from", "to", "words")).alias("spans"))  # a text's own spans
    both = rows.join(mine.hint("shuffle_hash"), ROW, "left").select("doc_id", "text", "spans")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            data, offsets = text_buffers(batch.column(1))
            found = batch.column(2)
            owner, flat = np.repeat(np.arange(n), pc.fill_null(pc.list_value_length(found), 0).to_numpy()), found.flatten()
            begin, end, word = [flat.field(i).to_numpy(zero_copy_only=False) for i in range(3)]
            begin, end = begin.astype(np.int64), end.astype(np.int64)
            (at, a, b), passages = [_merged(owner[word == k], begin[word == k], end[word == k]) for k in (False, True)]
            sums = lambda at, x: np.bincount(at, x, n).astype(np.int64)
            first, runs, kept = np.searchsorted(at, np.arange(n + 1)), np.stack([a, b], 1), []
            for k in range(n):
                raw = data[offsets[k] : offsets[k + 1]].tobytes()
                edges = [0, *runs[first[k] : first[k + 1]].reshape(-1).tolist(), len(raw)]
                kept.append(b"".join(raw[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)))
            counts = [pa.nulls(n, pa.int64())] * 2 if passage_words is None else [pa.array(sums(passages[0], x)) for x in (None, passages[2] - passages[1])]
            spans_ = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (a, b)], ["from", "to"]))
            digest = pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(sums(at, b - a)), pa.array(sums(at, None)), digest, spans_, pa.array(kept, pa.binary()), *counts], names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept", "n_passages", "n_passage_words"]
    kind = docs.schema[id_col].dataType.simpleString()
    return both.mapInArrow(finish, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<from: int, to: int>>, kept binary, n_passages long, n_passage_words long")


def op3_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(read_table(spark, sf_dir, "documents"), passage_words=PASSAGE_WORDS)
    kept = F.octet_length("kept").cast("long")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", kept.alias("n_kept"), (F.col("n_removed") > 0).alias("removed"), "spans", "n_passages", "n_passage_words")


assert GRAM <= LENGTH - SPAN
