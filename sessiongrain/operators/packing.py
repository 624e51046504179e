"""Greedy packing as a scan of step functions: blocks of items are walked apart, only their functions meet."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessiongrain.sources.cuts import cuts

PROMPT_CHARS = 50_000
BLOCK_ROWS = 65_536
FAN = 128
_OPEN = np.iinfo(np.int64).max
_STEPS = "ups array<long>, held array<long>, bins array<long>, zero_held long, zero_bins long"


class Steps(NamedTuple):
    """What a run of items makes of the size held in the open bin before it: (size held after it, bins begun in it).

    Piece i holds for sizes up to ups[i]. A piece that begins no bin adds its `held` to the size, others set it.
    A size of zero has its own values, as an item never begins a bin where nothing is held.
    """

    ups: np.ndarray
    held: np.ndarray
    bins: np.ndarray
    zero_held: int
    zero_bins: int

    def at(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        piece = np.searchsorted(self.ups, sizes)
        bins = np.where(sizes == 0, self.zero_bins, self.bins[piece])
        held = np.where(self.bins[piece] == 0, sizes + self.held[piece], self.held[piece])
        return np.where(sizes == 0, self.zero_held, held), bins

    def then(self, other: Steps) -> Steps:
        """This run followed by the other one."""
        held, more = other.at(self.held)
        bins = self.bins + more
        ups = self.ups
        if self.bins[0] == 0:  # what passes through meets the other run's pieces, moved by what it has gained
            gain, last = int(self.held[0]), int(self.ups[0])
            ends = np.minimum(np.where(other.ups == _OPEN, _OPEN, other.ups - gain), last)
            inside = (ends >= 1) & np.append(True, ends[:-1] < last)
            passed = np.where(other.bins == 0, other.held + gain, other.held)
            ups, held, bins = (np.concatenate([a[inside], b[1:]]) for a, b in ((ends, ups), (passed, held), (other.bins, bins)))
        zero_held, zero_bins = other.at(np.array([self.zero_held]))
        return merged(ups, held, bins, int(zero_held[0]), self.zero_bins + int(zero_bins[0]))


def merged(ups: np.ndarray, held: np.ndarray, bins: np.ndarray, zero_held: int, zero_bins: int) -> Steps:
    """Neighbouring pieces with the same values are one."""
    last = np.append((held[1:] != held[:-1]) | (bins[1:] != bins[:-1]), True)
    return Steps(ups[last], held[last], bins[last], zero_held, zero_bins)


def successors(sizes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(running sizes, for each item the item that begins the next bin if this one begins one; the number of items where none does)."""
    n = len(sizes)
    total = np.cumsum(sizes)
    solid = np.where(sizes > 0, np.arange(n), n)
    first = np.minimum.accumulate(solid[::-1])[::-1] if n else solid
    return total, np.maximum(np.searchsorted(total, total - sizes + limit, side="right"), np.minimum(first + 1, n))


def steps_of(sizes: np.ndarray, limit: int) -> Steps:
    """The function of a run of one item or more."""
    total, after = successors(sizes, limit)
    n, whole = len(sizes), int(total[-1])
    bins, held = np.ones(n, np.int64), whole - (total - sizes)
    for i in range(n - 1, -1, -1):
        if after[i] < n:
            bins[i], held[i] = bins[after[i]] + 1, held[after[i]]
    begins = int(after[0])  # with nothing held the first item joins whatever bin is open
    zero = (int(held[begins]), int(bins[begins])) if begins < n else (whole, 0)
    # The first item that does not fit is i for sizes over limit - total[i] and up to limit - total[i - 1].
    ups = np.append(limit - total[::-1], _OPEN)
    held, bins = np.append(whole, held[::-1]), np.append(0, bins[::-1])
    here = (ups >= 1) & np.append(True, ups[1:] > ups[:-1])
    return merged(ups[here], held[here], bins[here], *zero)


def _walk(sizes: np.ndarray, limit: int, held: int, bin_: int) -> np.ndarray:
    """The bin of each item, from what is held before them."""
    total, after = successors(sizes, limit)
    n = len(sizes)
    at = int(np.searchsorted(total, limit - held, side="right")) if held else int(after[0])
    starts = np.zeros(n, np.int64)
    while at < n:
        starts[at] = 1
        at = int(after[at])
    return bin_ + np.cumsum(starts)


def _segments(names: pa.ChunkedArray) -> list[tuple[int, int]]:
    """Places at which the runs of one key begin and end."""
    codes = names.combine_chunks().dictionary_encode()
    codes = (codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy()
    cuts = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(codes)]
    return list(zip(cuts, cuts[1:], strict=False))


def _read(row: dict) -> Steps:
    return Steps(*(np.array(row[c], np.int64) for c in ("ups", "held", "bins")), row["zero_held"], row["zero_bins"])


def _table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema)


_NODE = pa.schema([("name", pa.string()), ("seq", pa.int64()), *((c, pa.list_(pa.int64())) for c in ("ups", "held", "bins")), ("zero_held", pa.int64()), ("zero_bins", pa.int64())])
_ENTRY = pa.schema([("name", pa.string()), ("seq", pa.int64()), ("entry_held", pa.int64()), ("entry_bin", pa.int64())])


def _composed(nodes: pa.Table) -> pa.Table:
    """The nodes of one parent as one function."""
    rows = nodes.sort_by("seq").to_pylist()
    out = _read(rows[0])
    for r in rows[1:]:
        out = out.then(_read(r))
    return _table([{"name": rows[0]["name"], "seq": rows[0]["parent"], **out._asdict()}], _NODE)


def _entered(nodes: pa.Table, entries: pa.Table) -> pa.Table:
    """What each node of one parent is entered with; a parent without a row is the first one."""
    rows = nodes.sort_by("seq").to_pylist()
    given = entries.to_pylist()
    held, bin_ = (given[0]["entry_held"], given[0]["entry_bin"]) if given else (0, 0)
    out = []
    for r in rows:
        out.append({"name": r["name"], "seq": r["seq"], "entry_held": held, "entry_bin": bin_})
        after, more = _read(r).at(np.array([held]))
        held, bin_ = int(after[0]), bin_ + int(more[0])
    return _table(out, _ENTRY)


def pack(rows: DataFrame, key: str, order: str, size: str, limit: int = PROMPT_CHARS, block_rows: int = BLOCK_ROWS, fan: int = FAN) -> DataFrame:
    """rows with `bin`: items in order, a new bin where the running size would exceed the limit; a larger item has one of its own.

    Where a bin ends depends on all items before it, but a block of items is a step function of the one
    number that is held before it. Range partitions (sizes only, no texts) are cut in blocks; each block gives the functions
    of the keys that go beyond it; functions of one key are composed `fan` at a time, level by level, and the
    numbers that blocks are entered with come back down the same levels. So no task walks a key, however many items it has.
    Null keys are one key, null sizes count as zero, negative ones raise; rows that share key and order are
    walked as they stand after sorting by size. An empty table gives none.
    """
    spark = rows.sparkSession
    kept = cuts(spark, "packing")
    number = F.coalesce(F.col(size).cast("long"), F.lit(0))
    checked = F.when(number >= 0, number).otherwise(F.raise_error(F.lit("negative size")).cast("long"))
    named = rows.withColumn("__name", F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")))
    sizes = named.groupBy("__name", order, checked.alias("n")).agg(F.count("*").alias("copies"))
    placed = sizes.select(F.col("__name").alias("name"), F.col(order).alias("__order"), "n", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    placed = placed.repartitionByRange("name", "__order", "n", "copy").sortWithinPartitions("name", "__order", "n", "copy").withColumn("place", F.monotonically_increasing_id())
    block = F.expr(f"shiftleft(shiftright(place, 33), 33) + (place & {(1 << 33) - 1}) div {block_rows}")
    items = kept(placed.withColumn("block", block), "items")

    def functions(block_items: pa.Table) -> pa.Table:
        held = block_items.sort_by("place")
        n = held["n"].to_numpy()
        out = []
        segments = _segments(held["name"])
        for i in sorted({0, len(segments) - 1}):  # the others begin and end here
            a, b = segments[i]
            out.append({"name": held["name"][a].as_py(), "seq": held["block"][a].as_py(), **steps_of(n[a:b], limit)._asdict()})
        return _table(out, _NODE)

    nodes = kept(items.groupBy("block").applyInArrow(functions, f"name string, seq long, {_STEPS}"), "functions")
    by_name = Window.partitionBy("name")
    spread = nodes.select("name", "seq").withColumns({"at": F.row_number().over(by_name.orderBy("seq")) - 1, "of": F.count("*").over(by_name)}).where("of > 1")
    numbered = nodes.join(spread.select("name", "seq", "at"), ["name", "seq"])
    levels = [kept(numbered.select("name", F.col("seq").alias("block"), F.col("at").cast("long").alias("seq"), "ups", "held", "bins", "zero_held", "zero_bins"), "level-0")]
    while not levels[-1].where(F.col("seq") >= fan).isEmpty():
        grouped = levels[-1].withColumn("parent", F.floor(F.col("seq") / fan)).groupBy("name", "parent")
        levels.append(kept(grouped.applyInArrow(_composed, f"name string, seq long, {_STEPS}"), f"level-{len(levels)}"))
    entry = "name string, seq long, entry_held long, entry_bin long"
    entries = spark.createDataFrame([], entry)
    for level in reversed(levels):
        children = level.withColumn("parent", F.floor(F.col("seq") / fan))
        above = entries.withColumnRenamed("seq", "parent")
        entries = children.groupBy("name", "parent").cogroup(above.groupBy("name", "parent")).applyInArrow(_entered, entry)
    entered = levels[0].select("name", "seq", "block").join(entries, ["name", "seq"]).drop("seq")

    def bins(block_items: pa.Table, known: pa.Table) -> pa.Table:
        held = block_items.sort_by("place")
        n = held["n"].to_numpy()
        start = {r["name"]: (r["entry_held"], r["entry_bin"]) for r in known.to_pylist()}
        out = np.zeros(len(n), np.int64)
        for a, b in _segments(held["name"]):
            out[a:b] = _walk(n[a:b], limit, *start.get(held["name"][a].as_py(), (0, 0)))
        return held.select(["name", "__order", "n", "copy"]).append_column("bin", pa.array(out, pa.int32()))

    kind = items.schema["__order"].dataType.simpleString()
    packed = items.groupBy("block").cogroup(entered.groupBy("block")).applyInArrow(bins, f"name string, __order {kind}, n long, copy int, bin int")
    same = Window.partitionBy("__name", order, "__n").orderBy(F.lit(1))
    left = named.withColumn("__n", checked).withColumn("__copy", F.row_number().over(same))
    met = left.join(packed, (left["__name"] == packed["name"]) & left[order].eqNullSafe(packed["__order"]) & (left["__n"] == packed["n"]) & (left["__copy"] == packed["copy"]))
    return met.select(*[left[c] for c in rows.columns], packed["bin"])
