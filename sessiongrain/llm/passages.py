"""Passages that texts share, by words: the parse, dictionary and suffixes of repeated strings over word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessiongrain.llm.common import ROW, bounded_batches, cut, discard, release
from sessiongrain.llm.near_duplicates import text_buffers
from sessiongrain.llm.phrases import BASE, hasher, least_of, phrases_at, pieces, word_hashes

_KEYS = f"{ROW[0]} long, {ROW[1]} long"


def _parse(words: int, span: int):
    """(ROW columns, text) -> one row per phrase: ROW columns, a, b, t (places of words), core, phrase (hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(2))
            for first, last in pieces(offsets):
                value, at = word_hashes(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                with np.errstate(over="ignore"):
                    pairs = value[:-1] * np.uint64(BASE) + value[1:]
                text, a, b, t = phrases_at(least_of(pairs, span), at, words)
                base, digest = at[text], hasher(value)
                keys = [batch.column(i).take(pa.array(text + first)) for i in (0, 1)]
                whole = [digest(x, y).view(np.int64) for x, y in ((t, t + words - span), (a, b + words))]
                yield pa.RecordBatch.from_arrays([*keys, *[pa.array((x - base).astype(np.int32)) for x in (a, b, t)], *map(pa.array, whole)], [*ROW, "a", "b", "t", "core", "phrase"])

    return run


def _windows(words: int):
    """(text, asked) -> the windows of the asked phrases: core, phrase, place before the trigger, digest, lo, hi."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(0))
            asked, ends = batch.column(1).flatten(), np.concatenate([[0], np.cumsum(batch.column(1).value_lengths().to_numpy())])
            a, b, t, *more = [asked.field(i).to_numpy() for i in range(7)]
            owner = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            for first, last in pieces(offsets):
                value, at = word_hashes(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                digest = hasher(value)
                for k in range(ends[first], ends[last], 4096):
                    mine = np.arange(k, min(k + 4096, ends[last]))
                    count = b[mine] - a[mine] + 1
                    of = np.repeat(mine, count)
                    start = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + a[of]
                    at_ = start + at[owner[of] - first]
                    core, phrase, lo, hi = [x[of] for x in more]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (core, phrase, (t[of] - start).astype(np.int32), digest(at_, at_ + words).view(np.int64), lo, hi)], ["core", "phrase", "place", "digest", "lo", "hi"])

    return run


def shared_passages(rows: DataFrame, words: int, span: int | None = None) -> DataFrame:
    """(ROW columns, text) -> (ROW columns, from, to): ranges of words whose windows of `words` words all occur in another row too.

    Words are [^\\x20\\x09-\\x0D]+, so white space between them may differ. The steps are those of repeats.repeated_spans:
    the least pair of words among `span` places is a trigger, phrases of cores that two rows hold make up the
    dictionary, phrases that two rows hold are settled whole, and of cores with other phrases one copy each is
    fetched, whose windows are compared. Each carries the least and greatest of its rows: unequal ones mean two rows.
    Counts are minima and maxima, so no core, phrase or window binds its rows to one task. Equality is that of 64-bit
    hashes of words and windows within one 64-bit hash of the core.
    """
    span = span or max(1, words * 4 // 5)
    if not 0 < span < words:
        raise ValueError("passages of two words at least, with triggers among fewer places")
    bounded_batches(rows.sparkSession, 500)
    who, two = F.xxhash64(*ROW), [F.min("who").alias("lo"), F.max("who").alias("hi")]
    parsed = rows.select(*ROW, "text").mapInArrow(_parse(words, span), f"{_KEYS}, a int, b int, t int, core long, phrase long")
    parsed = cut(parsed, "word_parse")
    cores = cut(parsed.select("core", who.alias("who")).groupBy("core").agg(*two).where("lo < hi").select("core"), "word_cores")
    shared = cut(parsed.join(cores, "core"), "word_shared")
    discard(parsed, cores)
    release(rows.sparkSession)
    dictionary = shared.withColumn("who", who).groupBy("core", "phrase").agg(*two, F.min(F.struct(*ROW, "a", "b", "t")).alias("one"))
    dictionary = cut(dictionary, "word_dictionary")
    settled = shared.join(dictionary.where("lo < hi").select("core", "phrase"), ["core", "phrase"]).select(*ROW, F.col("a").alias("from"), (F.col("b") + words).alias("to"))
    settled = cut(settled, "word_settled")
    several = cut(dictionary.groupBy("core").agg(F.count("*").alias("n"), F.bool_or(F.col("lo") == F.col("hi")).alias("open")).where("n > 1 and open").select("core"), "word_several")
    wanted = dictionary.join(several, "core").select("one.*", "core", "phrase", "lo", "hi")
    asked = wanted.groupBy(*ROW).agg(F.collect_list(F.struct("a", "b", "t", "core", "phrase", "lo", "hi")).alias("asked"))  # a text's own phrases
    fetched = rows.select(*ROW, "text").join(asked.hint("shuffle_hash"), ROW).select("text", "asked")
    windows = cut(fetched.mapInArrow(_windows(words), "core long, phrase long, place int, digest long, lo long, hi long"), "word_windows")
    discard(dictionary, several)
    release(rows.sparkSession)
    twice = cut(windows.groupBy("core", "digest").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi").select("core", "digest"), "word_twice")
    found = windows.where("lo = hi").join(twice, ["core", "digest"]).groupBy("core", "phrase").agg(F.collect_list("place").alias("places"))  # of one phrase: span at most
    found = cut(found, "word_found")
    discard(windows, twice)
    rest = shared.join(found, ["core", "phrase"]).select(*ROW, "t", F.explode("places").alias("place"))
    rest = rest.select(*ROW, (F.col("t") - F.col("place")).alias("from")).select("*", (F.col("from") + words).alias("to"))
    return settled.unionByName(rest)
