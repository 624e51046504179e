"""SimHash near-duplicates through pivot distance tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessiongrain.llm.common import ROW, bounded_batches, cut, discard, read_table, with_row_id
from sessiongrain.llm.components import connected_components

#: Strings of more bytes are hashed one by one by the xxhash library: in step with others, one long word would hold up all.
LONE_BYTES = 2048
# XXH64's constants (fixed values of the public algorithm).
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

#: Three blocks of bits: fingerprints that differ in two bits at most agree in one of them.
BLOCKS = ((0, 21), (21, 21), (42, 22))
MAX_BITS = 2
#: Cells of the pivot table up to this many fingerprints are compared pair by pair.
PAIR_CELL = 24
N_REFERENCES = 12

#: The pipeline's stage: words of a shingle, least Jaccard similarity of a link, and bits beyond which no pair is verified
#: (at the least similarity fingerprints differ in about 10 bits, with a deviation of 3).
SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 24
#: Bands of minhashes: at the least similarity 1 - (1 - 0.8**5)**20 = 0.9996 of pairs share one.
BANDS = 20
BAND_ROWS = 5
#: Nodes of a large cell that all others are compared with first, and that its strays are compared with next.
HUB_ROUNDS = (1, 8)
#: Parts of the hash space in which shingles are counted: two sets share at most the sum of the lesser counts.
BUCKETS = 128


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * P2, 31) * P1


def xxh64(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of buf[start:end] for all pairs at once."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    words = np.ascontiguousarray(np.ndarray((len(buf) + 1,), "<u8", padded, 0, (1,)))  # the 8 bytes from each offset on
    length = (ends - starts).astype(np.int64)
    pos = starts.astype(np.int64).copy()
    lone = np.flatnonzero(length > LONE_BYTES)
    alone = [xxhash.xxh64_intdigest(buf[a:b].tobytes(), seed) for a, b in zip(pos[lone], pos[lone] + length[lone], strict=True)]
    length[lone] = 0
    with np.errstate(over="ignore"):
        s = np.uint64(seed)
        h = np.full(len(starts), s + P5, np.uint64)
        if len(long := np.flatnonzero(length >= 32)):
            acc = [np.full(len(long), x, np.uint64) for x in (s + P1 + P2, s + P2, s, s - P1)]
            at, stripes = pos[long], length[long] // 32
            for k in range(int(stripes.max())):
                on = np.flatnonzero(stripes > k)
                for j in range(4):
                    acc[j][on] = _round(acc[j][on], words[at[on] + 32 * k + 8 * j])
            mixed = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
            for a in acc:
                mixed = (mixed ^ _round(np.zeros_like(a), a)) * P1 + P4
            h[long] = mixed
            pos[long] += 32 * stripes
        h += length.astype(np.uint64)
        rest = length % 32
        for k in range(3):
            if not len(on := np.flatnonzero(rest >= 8 * (k + 1))):
                break
            h[on] = _rotl(h[on] ^ _round(np.zeros(len(on), np.uint64), words[pos[on]]), 27) * P1 + P4
            pos[on] += 8
        if len(on := np.flatnonzero(rest & 4)):
            h[on] = _rotl(h[on] ^ ((words[pos[on]] & np.uint64(0xFFFFFFFF)) * P1), 23) * P2 + P3
            pos[on] += 4
        for k in range(3):
            if not len(on := np.flatnonzero((rest & 3) > k)):
                break
            h[on] = _rotl(h[on] ^ ((words[pos[on]] & np.uint64(0xFF)) * P5), 11) * P1
            pos[on] += 1
        h ^= h >> np.uint64(33)
        h *= P2
        h ^= h >> np.uint64(29)
        h *= P3
        h ^= h >> np.uint64(32)
    h[lone] = np.array(alone, np.uint64)
    return h


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER[_SPACE] = 32


def _shingles(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """(bytes, begins and ends in them of all shingles, shingles of each text); None where no text has a word."""
    n = len(offsets) - 1
    if n == 0 or len(data) == 0:
        return None
    space = _SPACE[data]
    first = np.zeros(len(data) + 1, bool)  # where a text begins
    first[offsets] = True
    before = np.ones(len(data), bool)  # no word goes on here
    before[1:] = space[:-1]
    before |= first[:-1]
    starts = np.flatnonzero(~space & before)
    if not len(starts):
        return None
    after = np.ones(len(data), bool)
    after[:-1] = space[1:]
    after |= first[1:]
    lengths = np.flatnonzero(~space & after) + 1 - starts
    keep = ~space | ~before  # the words, and the first white space after each
    flat = _LOWER[data[keep]]
    starts = (np.cumsum(keep) - 1)[starts]
    ends = starts + lengths
    doc_first = np.concatenate([np.zeros(1, np.int64), np.cumsum(~space & before)])[offsets]  # each text's first word
    words = np.diff(doc_first)
    count = np.where(words == 0, 0, np.maximum(words - shingle + 1, 1))
    doc_of = np.repeat(np.arange(n), count)
    begin = np.arange(len(doc_of)) - (np.cumsum(count) - count)[doc_of] + doc_first[doc_of]
    end = begin + np.minimum(words[doc_of], shingle) - 1
    return flat, starts[begin], ends[end], count


def simhash(data: np.ndarray, offsets: np.ndarray, shingle: int = 3, seed: int = 42, chunk: int = 1 << 18) -> np.ndarray:
    """Fingerprints of the texts data[offsets[i]:offsets[i + 1]] (UTF-8), whole, as unsigned 64-bit integers."""
    return _simhash(*_hashes(data, offsets, shingle, seed, chunk), chunk)


def _hashes(data: np.ndarray, offsets: np.ndarray, shingle: int, seed: int = 42, chunk: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the shingles of all texts, text after text; shingles of each text)."""
    found = _shingles(data, offsets, shingle)
    if found is None:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    flat, begin, end, count = found
    out = np.empty(len(begin), np.uint64)
    for a in range(0, len(begin), chunk):
        b = min(a + chunk, len(begin))
        lo, hi = int(begin[a]), int(end[b - 1])
        out[a:b] = xxh64(flat[lo:hi], begin[a:b] - lo, end[a:b] - lo, seed)
    return out, count


def _simhash(hashes: np.ndarray, count: np.ndarray, chunk: int = 1 << 18) -> np.ndarray:
    full = np.flatnonzero(count)
    base = np.concatenate([np.zeros(1, np.int64), np.cumsum(count)])
    ones = np.zeros((len(count), 64), np.int64)
    for a in range(0, len(hashes), chunk):
        b = min(a + chunk, len(hashes))
        bits = np.unpackbits(hashes[a:b].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        here = full[np.searchsorted(base[full], a, "right") - 1 : np.searchsorted(base[full], b, "left")]
        ones[here] += np.add.reduceat(bits, np.maximum(base[here] - a, 0), axis=0, dtype=np.int32)
    over = 2 * ones > count[:, None]
    return np.packbits(over, axis=1, bitorder="little").view("<u8").reshape(-1)


def _mix64(state: int) -> int:
    """SplitMix64's output for a state."""
    full = (1 << 64) - 1
    z = ((state ^ (state >> 30)) * 0xBF58476D1CE4E5B9) & full
    z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & full
    return z ^ (z >> 31)


def minhashes(hashes: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """(texts, n) least values of the shingles under n hash functions, 32 bits each; texts without words have zeros."""
    out = np.zeros((len(count), n), np.uint32)
    full = np.flatnonzero(count)
    if len(full):
        at = (np.cumsum(count) - count)[full]
        for k in range(n):
            x, a = np.uint64(_mix64(2 * k + 1)), np.uint64(_mix64(2 * k + 2) | 1)
            values = ((hashes ^ x) * a) >> np.uint64(32)
            out[full, k] = np.minimum.reduceat(values.astype(np.uint32), at)
    return out


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes and the offsets of a string column; nulls are empty."""
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = column.cast(pa.large_binary() if binary else pa.large_string()).fill_null(b"" if binary else "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) with fp a signed 64-bit integer, for every row. Null and blank texts have fingerprint zero."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = simhash(*text_buffers(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.astype("<u8").view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def references(n: int = N_REFERENCES) -> list[int]:
    """Reference fingerprints: SplitMix64 from state 1, 2, ..."""
    out, state, full = [], 1, (1 << 64) - 1
    for _ in range(n):
        state = (state + 0x9E3779B97F4A7C15) & full
        out.append(_mix64(state))
    return out


def _mask(block: tuple[int, int]) -> int:
    return ((1 << block[1]) - 1) << block[0]


def _distance(fp: Column, to: int) -> Column:
    return F.bit_count(fp.bitwiseXOR(F.lit(_signed(to))))


def pivot_distances(fp: Column) -> list[Column]:
    """Distances to every pivot: each reference, and each reference with one block of bits turned over."""
    return [_distance(fp, r ^ m) for r in references() for m in (0, *map(_mask, BLOCKS))]


def cell_key(fp: Column, block: tuple[int, int]) -> Column:
    """The distances to the references within one block, five bits each, from two whole distances each.

    d(x, r) - d(x, r with the block turned over) = 2 * (distance within the block) - (bits of the block).
    """
    key = F.lit(0).cast("long")
    for j, r in enumerate(references()):
        inside = (_distance(fp, r) - _distance(fp, r ^ _mask(block)) + F.lit(block[1])).cast("long")
        key = key.bitwiseOR(F.shiftleft(F.shiftright(inside, 1), 5 * j))
    return key


def pivot_table(distinct: DataFrame) -> DataFrame:
    """distinct (with fp) and `pivots`: the distances of each fingerprint to every pivot, computed once."""
    return distinct.withColumn("pivots", F.array(*pivot_distances(F.col("fp"))).cast("array<tinyint>"))


def _within(a: str, b: str, bits: int = MAX_BITS) -> Column:
    """Structs a and b (fp, pivots): discarded by the largest difference of a coordinate of the table, else by the bits themselves."""
    most = F.array_max(F.zip_with(f"{a}.pivots", f"{b}.pivots", lambda x, y: F.abs(x - y)))
    return (most <= bits) & (F.bit_count(F.col(f"{a}.fp").bitwiseXOR(F.col(f"{b}.fp"))) <= bits)


def linked(distinct: DataFrame) -> DataFrame:
    """(fp) -> edges (a, b) whose components are those of all links at MAX_BITS or fewer differing bits.

    Every fingerprint enters one cell for each block of bits: its distances to the references within that
    block. A link leaves at least one block untouched, and there both ends have the same cell. Small cells
    are compared pair by pair: pivot filter, then bits. In larger cells (any size) each fingerprint names the
    44 or fewer values at most one bit away outside the block; two fingerprints link exactly if they share
    such a value, so a value's least fingerprint is joined to the others that name it (44 at most).
    """
    fp = F.col("fp")
    blocks = [F.struct(F.lit(i).alias("block"), cell_key(fp, b).alias("cell")) for i, b in enumerate(BLOCKS)]
    cells = pivot_table(distinct.select("fp")).select(F.struct("fp", "pivots").alias("x"), F.explode(F.array(*blocks)).alias("c")).select("x", "c.block", "c.cell")
    sizes = cells.groupBy("block", "cell").agg(F.count("*").alias("n")).where("n > 1")
    shared = cut(cells.join(sizes, ["block", "cell"]), "cells")
    small = shared.where(F.col("n") <= PAIR_CELL).drop("n")
    pairs = small.join(small.withColumnRenamed("x", "y"), ["block", "cell"]).where("x.fp < y.fp").where(_within("x", "y")).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    flips = F.lit(None)
    for i, b in enumerate(BLOCKS):
        outside = [F.lit(0).cast("long"), *[F.lit(_signed(1 << k)) for k in range(64) if not _mask(b) >> k & 1]]
        flips = F.when(F.col("block") == i, F.array(*outside)).otherwise(flips)
    near = shared.where(F.col("n") > PAIR_CELL).select("x.fp", "block", F.explode(flips).alias("flip")).select("block", fp.bitwiseXOR(F.col("flip")).alias("value"), "fp")
    stars = near.groupBy("block", "value").agg(F.collect_list("fp").alias("all")).where(F.size("all") > 1).select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a < b").distinct()
    pivots = shared.where(F.col("n") > PAIR_CELL).select("x").distinct()
    met = stars.join(pivots.select(F.col("x.fp").alias("a"), "x"), "a").join(pivots.select(F.col("x.fp").alias("b"), F.col("x").alias("y")), "b")
    return pairs.unionByName(met.where(_within("x", "y")).select("a", "b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fp (long), root (long, one per class), component_id.

    component_id is the least doc_id reachable over links of two or fewer differing bits, itself included.
    Null ids are carried and never chosen unless a class has no other; repeated rows keep one row each;
    null, empty and blank texts share fingerprint zero and link like any other. Empty in, empty out.
    """
    prints = cut(fingerprints(docs, id_col, text_col), "prints")
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = connected_components(linked(distinct.select("fp")))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    # Only classes of two or more fingerprints need the least id of the class.
    shared = rooted.join(roots.select("root").distinct(), "root", "left_semi").groupBy("root").agg(F.min("least").alias("class_least"))
    classes = cut(rooted.join(shared, "root", "left").select("fp", "root", F.coalesce("class_least", "least").alias("component_id")), "classes")
    return prints.join(classes, "fp").select("doc_id", "fp", "root", "component_id")


def sketches(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(ROW columns, doc_id, digest, node, n, fp, mins) for every row of a table with ROW columns.

    digest: hash of the text; node: digest of the set of shingles, zero for null and blank texts; n: its size; mins: BANDS * BAND_ROWS minhashes.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, count = _hashes(*text_buffers(batch.column(4)), shingle)
            fp, mins = _simhash(hashes, count), minhashes(hashes, count, BANDS * BAND_ROWS)
            sets = [np.unique(h) for h in np.split(hashes, np.cumsum(count)[:-1])]
            flat = np.frombuffer(b"".join(x.astype("<u8").tobytes() for x in sets), np.uint8)
            ends = np.cumsum([8 * len(x) for x in sets])
            n = np.array([len(x) for x in sets], np.int64)
            node = np.where(n == 0, np.uint64(0), xxh64(flat, ends - 8 * n, ends))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * mins.shape[1]), pa.array(mins.view(np.int32).reshape(-1)))
            columns = [*batch.columns[:4], pa.array(node.view(np.int64)), pa.array(n), pa.array(fp.view(np.int64)), lists]
            yield pa.RecordBatch.from_arrays(columns, [*ROW, "doc_id", "digest", "node", "n", "fp", "mins"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{ROW[0]} long, {ROW[1]} long, doc_id {kind}, digest long, node long, n long, fp long, mins array<int>"
    return docs.select(*ROW, F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def _shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles, buckets) of a table with node and text: the sets of shingle hashes, and how many of them lie in each part of the hash space."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, count = _hashes(*text_buffers(batch.column(1)), shingle)
            sets = [np.unique(h) for h in np.split(hashes, np.cumsum(count)[:-1])]
            parts = [np.bincount((h >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64), minlength=BUCKETS).astype(np.int32) for h in sets]
            columns = [batch.column(0), pa.array([h.view(np.int64) for h in sets], pa.list_(pa.int64())), pa.array(parts, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["node", "shingles", "buckets"])

    return docs.select("node", "text").mapInArrow(run, "node long, shingles array<long>, buckets array<int>")


def similar_roots(numbered: DataFrame, nodes: DataFrame, shingle: int, similarity: float, bits: int, text_col: str = "text") -> DataFrame:
    """(node, root) of the nodes linked to others: sets of shingles with a Jaccard similarity of `similarity` or more.

    numbered: the texts with ROW columns; nodes: (node, n, fp, pivots, mins, and ROW columns of a row with the text).
    Candidates share a cell: equal minhashes in one of BANDS bands. Cells up to PAIR_CELL are compared pair by pair. In larger
    ones all nodes are first compared with one node (hub), then those of several classes with a few hubs: nodes in one
    class need no further comparison. What is left are strays, the nodes outside a cell's largest class; they
    are compared with all of the cell (see _stray_links), so every pair that shares a cell and is in
    two classes has been decided, at any size. Candidates of pairs and hubs must have sizes that allow the similarity and
    pass the pivot table at `bits` bits; all are verified on the whole sets, which are built once.
    """
    band = [F.xxhash64(F.lit(k), *[F.get("mins", k * BAND_ROWS + j) for j in range(BAND_ROWS)]) for k in range(BANDS)]
    facts = nodes.select("node", F.struct("node", "n", "fp", "pivots").alias("x"))
    rows = nodes.where("n > 0").select("node", F.posexplode(F.array(*band)).alias("band", "cell"))
    roots = sets = None
    for n_hubs in HUB_ROUNDS:
        named = _named(rows, roots)
        hubs = [F.min_by(F.struct("node", "root"), F.xxhash64(F.lit(k), "cell", "node")) for k in range(n_hubs)]
        open_ = named.groupBy("cell").agg(F.count("*").alias("size"), F.min("root").alias("lo"), F.max("root").alias("hi"), F.array(*hubs).alias("hubs"))
        shared = cut(named.join(open_.where("lo < hi").drop("lo", "hi"), "cell"), "bands")
        crowded = F.col("size") > PAIR_CELL
        stars = shared.where(crowded).select("node", F.explode(F.filter("hubs", lambda h: h["root"] != F.col("root"))).alias("hub"))
        both = stars.select("node", F.col("hub.node").alias("to")).distinct().join(facts, "node").join(facts.select(F.col("node").alias("to"), F.col("x").alias("y")), "to").select("x", "y")
        if sets is None:
            left = shared.where(~crowded).select("cell", "node").join(facts, "node").drop("node")
            both = both.unionByName(left.join(left.select("cell", F.col("x").alias("y")), "cell").where("x.node < y.node").select("x", "y"))
        both = both.where(F.least("x.n", "y.n") >= similarity * F.greatest("x.n", "y.n")).where(_within("x", "y", bits))
        found = cut(both.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct(), "candidates")
        if sets is None:
            wanted = found.select(F.explode(F.array("a", "b")).alias("node")).unionByName(shared.where(crowded).select("node")).distinct()
            texts = numbered.select(*ROW, F.col(text_col).alias("text")).join(nodes.join(wanted, "node", "left_semi").select(*ROW, "node"), ROW)
            sets = cut(_shingle_sets(texts, shingle), "shingles")
        here = _verified(found, sets, similarity)
        roots = connected_components(here) if roots is None else _merged_roots(roots, here)
        rest = cut(shared.where(crowded).select("node", "band", "cell"), "crowded")
        discard(found, shared)
        rows = rest
        if rest.isEmpty():
            discard(rest, sets)
            return roots
    bands = nodes.select("node", F.array(*band).alias("bands"))
    roots = _merged_roots(roots, _verified(_stray_links(rest, roots, sets, bands, similarity), sets, similarity))
    discard(rest, sets)
    return roots


def _named(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return rows.withColumn("root", F.col("node"))
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _stray_links(rest: DataFrame, roots: DataFrame, sets: DataFrame, bands: DataFrame, similarity: float) -> DataFrame:
    """(a, b) candidates of cells with several classes: each node outside the cell's largest class against all nodes of other classes.

    A pair is looked at in the first band that it shares and leaves the join only if it can be similar: two sets share at
    most the sum of the lesser bucket counts, so no link is lost. Skewed cells are split by the join.
    """
    named = _named(rest, roots)
    tally = named.groupBy("cell", "root").agg(F.count("*").alias("m")).groupBy("cell").agg(F.max_by("root", F.struct("m", "root")).alias("main"), F.count("*").alias("k"))
    facts = sets.select("node", F.size("shingles").alias("n"), "buckets").join(bands, "node")
    members = cut(named.join(tally.where("k > 1"), "cell").join(facts, "node"), "strays")
    x = members.where("root <> main").select("cell", *[F.col(c).alias(f"x_{c}") for c in ("node", "root", "n", "buckets", "bands", "band")])
    y = members.select("cell", *[F.col(c).alias(f"y_{c}") for c in ("node", "root", "n", "buckets", "bands", "main")])
    once = (F.col("y_root") == F.col("y_main")) | (F.col("x_node") < F.col("y_node"))
    sizes = F.least("x_n", "y_n") >= similarity * F.greatest("x_n", "y_n")
    first = F.array_position(F.zip_with("x_bands", "y_bands", lambda p, q: p == q), True) == F.col("x_band") + 1
    most = F.aggregate(F.zip_with("x_buckets", "y_buckets", lambda p, q: F.least(p, q)), F.lit(0), lambda total, c: total + c)
    can = most >= similarity * (F.col("x_n") + F.col("y_n") - most)
    pairs = x.join(y, (x["cell"] == y["cell"]) & (F.col("x_root") != F.col("y_root")) & once & sizes & first & can)
    return cut(pairs.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct(), "stray_pairs")


def _verified(found: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar."""
    met = found.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("s")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("t")), "b")
    common = F.size(F.array_intersect("s", "t"))
    return cut(met.where(common / (F.size("s") + F.size("t") - common) >= similarity).select("a", "b"), "links")


def _merged_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """roots (node, root) with the classes that the new links (a, b) join."""
    if links.isEmpty():
        return roots
    known = roots.select(F.col("node").alias("a"), "root")
    between = links.join(known, "a", "left").select(F.coalesce("root", "a").alias("x"), F.col("b").alias("a")).join(known, "a", "left").select(F.col("x").alias("a"), F.coalesce("root", "a").alias("b"))
    moved = connected_components(between)
    old = roots.join(moved.select(F.col("node").alias("root"), F.col("root").alias("end")), "root", "left").select("node", F.coalesce("end", "root").alias("root"))
    out = cut(old.unionByName(moved.join(roots, "node", "left_anti")), "roots")
    discard(roots, moved)
    return out


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, bits: int = RADIUS) -> DataFrame:
    """docs with one row of each class: the one with the least id, nulls last, then by a digest of the text, and then the first
    in (file, row). Columns unchanged.

    Classes are those of links between texts whose sets of `shingle`-word shingles have a Jaccard similarity of `similarity` or
    more (see similar_roots). Null, empty and blank texts are one class; texts shorter than a shingle are one shingle.
    Rows are told apart by their place, so null and repeated ids are only an order. Empty in, empty out.
    """
    numbered = with_row_id(docs)
    rows = cut(sketches(numbered, shingle, id_col, text_col), "sketches")
    nodes = pivot_table(rows.groupBy("node").agg(F.min_by(F.struct("n", "fp", "mins", *ROW), F.struct(*ROW)).alias("x")).select("node", "x.*"))
    nodes = cut(nodes, "nodes")
    roots = similar_roots(numbered, nodes, shingle, similarity, bits, text_col)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest", *ROW)
    classes = rows.select("node", place.alias("place")).join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("place").alias("place"))
    kept = cut(classes.select(*[F.col(f"place.{c}").alias(c) for c in ROW]), "kept")
    discard(rows, nodes, roots)
    return numbered.join(kept, ROW, "left_semi").select(*docs.columns)


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

