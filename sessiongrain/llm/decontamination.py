"""Benchmark decontamination: pigeonhole pieces of test items found exactly, verified by bit-parallel edit distance."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sessiongrain.llm.common import ROW, bounded_batches, cut, read_table, with_row_id
from sessiongrain.llm.near_duplicates import text_buffers

#: Edits allowed for each byte of a normalised item. Pieces are then about 16 bytes, long enough to be rare.
ERROR_SHARE = 0.06
#: Items shorter than this, normalised, allow no edit and must stand between word bounds: a part of them, or of a word, is no evidence.
EXACT_BYTES = 32
#: Normalised bytes of items that one pass over the documents looks for; more items take more passes.
BLOCK_BYTES = 2 << 20

#: What stands between words: everything but letters, their marks and digits.
NO_WORD = r"[^\p{L}\p{M}\p{N}]+"


def fold(text: Column) -> Column:
    """Lower case, and every run of other characters than letters, marks and digits, in any script, one space, none at either end. Null: empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NO_WORD, " "))


def budget(size: int) -> int:
    """Edits allowed for an item of so many bytes."""
    return int(size * ERROR_SHARE) if size >= EXACT_BYTES else 0


def pieces(item: bytes) -> list[tuple[int, bytes]]:
    """budget + 1 pieces (place, bytes): an occurrence within the budget leaves one of them untouched."""
    n = budget(len(item)) + 1
    edges = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def best_match(item: bytes, text: bytes) -> tuple[int, int]:
    """(least edit distance of item to a substring of text, end of the first such substring): Myers' bit vectors."""
    size = len(item)
    full, high = (1 << size) - 1, 1 << (size - 1)
    where: dict[int, int] = defaultdict(int)
    for i, c in enumerate(item):
        where[c] |= 1 << i
    up, down, score, best, end = full, 0, size, size, 0
    for j, c in enumerate(text, 1):
        eq = where.get(c, 0)
        vertical = eq | down
        across = (((eq & up) + up) ^ up) | eq
        rise = down | ~(across | up) & full
        fall = up & across
        if rise & high:
            score += 1
        elif fall & high:
            score -= 1
        rise, fall = rise << 1 & full, fall << 1 & full
        up = fall | ~(vertical | rise) & full
        down = rise & vertical
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """Finds the items of one block in normalised texts."""

    def __init__(self, items: list[tuple[int | None, bytes]]):
        import ahocorasick

        self.items = items
        owners: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, item) in enumerate(items):
            for at, piece in pieces(item):
                owners[piece.decode("latin-1")].append((k, at))
        self.automaton = ahocorasick.Automaton()
        for piece, held in owners.items():
            self.automaton.add_word(piece, (len(piece), held))
        self.automaton.make_automaton()

    def find(self, text: bytes) -> list[tuple[int, int, int, int]]:
        """(item, distance, end, places) for each item within its budget; places: separate candidate windows that hold it."""
        starts: dict[int, set[int]] = defaultdict(set)
        for end, (size, held) in self.automaton.iter(text.decode("latin-1")):
            for k, at in held:
                starts[k].add(end + 1 - size - at)
        found = []
        for k, at in starts.items():
            item = self.items[k][1]
            room, best, places, covered = budget(len(item)), None, 0, None
            ordered = sorted(at)
            i = 0
            while i < len(ordered):
                j = i
                while j + 1 < len(ordered) and ordered[j + 1] - ordered[j] <= 2 * room:
                    j += 1
                low, high = max(0, ordered[i] - room), ordered[j] + len(item) + room
                if len(item) < EXACT_BYTES:  # the whole item is the piece that was found
                    bounded = text[low - 1 : low] in (b"", b" ") and text[high : high + 1] in (b"", b" ")
                    distance, end = (0 if bounded else room + 1), len(item)
                else:
                    distance, end = best_match(item, text[low:high])
                if distance <= room:
                    places += 1
                    if best is None or distance < best:
                        best, covered = distance, low + end
                i = j + 1
            if best is not None:
                found.append((k, best, covered, places))
        return found


_MATCHERS: dict[int, Matcher] = {}


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int | None, bytes]]]:
    """The test items, folded, in blocks of bounded size; equal items once for each id. Items without a letter or digit are left out."""
    block: list[tuple[int | None, bytes]] = []
    held = 0
    for row in benchmark.select(F.col(id_col).alias("i"), fold(F.col(text_col)).alias("t")).where(F.length("t") > 0).orderBy("i", "t").toLocalIterator():
        item = row["t"].encode()
        if block and held + len(item) > block_bytes:
            yield block
            block, held = [], 0
        block.append((row["i"], item))
        held += len(item)
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per (document, test item in it): ROW columns, doc_id, item_id, distance, n_places.

    Item and text are compared as folded bytes (see fold); an item is in a text if some part of the text is within budget(item)
    edits of the whole item; short items, which have no budget, must be there between word bounds. Each item is split into
    budget + 1 pieces, texts are scanned once for all pieces, and each window around a hit is verified; nothing is
    capped. Items go in blocks of bounded bytes (one pass over the documents each), so what an executor holds
    does not grow with the benchmark. Null texts and null items match nothing; null and repeated ids are
    carried; empty tables give an empty result.
    """
    bounded_batches(docs.sparkSession)
    rows = with_row_id(docs).select(*ROW, F.col(id_col).alias("doc_id"), fold(F.col(text_col)).alias("text"))
    kind, item_kind = (t.schema[c].dataType.simpleString() for t, c in ((docs, id_col), (benchmark, item_col)))
    schema = f"{ROW[0]} long, {ROW[1]} long, doc_id {kind}, item_id {item_kind}, distance int, n_places int"
    arrow_kind = to_arrow_type(benchmark.schema[item_col].dataType)
    result = None
    for block in item_blocks(benchmark, item_col, item_text, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)  # at most block_bytes

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            key = shared.value and hash(tuple(shared.value))
            if key not in _MATCHERS:
                _MATCHERS.clear()
                _MATCHERS[key] = Matcher(shared.value)
            matcher = _MATCHERS[key]
            for batch in batches:
                data, offsets = text_buffers(batch.column(3))
                raw = data.tobytes()
                hits = [(i, *hit) for i in range(batch.num_rows) for hit in matcher.find(raw[offsets[i] : offsets[i + 1]])]
                if hits:
                    at = pa.array([h[0] for h in hits])
                    columns = [[matcher.items[h[1]][0] for h in hits], [h[2] for h in hits], [h[4] for h in hits]]
                    kinds = (arrow_kind, pa.int32(), pa.int32())
                    yield pa.RecordBatch.from_arrays([*[batch.column(k).take(at) for k in range(3)], *map(pa.array, columns, kinds)], [*ROW, "doc_id", "item_id", "distance", "n_places"])

        found = rows.mapInArrow(run, schema)
        result = found if result is None else result.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if result is None else result


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that hold a test item. Columns unchanged.

    Rows are told apart by their place: null and repeated ids only ride along, equal rows go or stay together; null and empty
    texts stay; an empty benchmark removes nothing; columns named like those of the result are kept; empty in, empty out.
    """
    found = cut(contaminated(docs, benchmark).select(*ROW).distinct(), "contaminated")
    return with_row_id(docs).join(found, ROW, "left_anti").select(*docs.columns)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "distance", "n_places")
