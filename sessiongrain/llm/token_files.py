"""Token ids in fixed-width bit-packed files with block offsets.

A file: the header (magic, bits per id, ids per block, documents, ids, blocks), the documents' ids with a
null flag each, their first positions, the blocks' byte offsets, and the blocks. Every block starts at a byte, so
any block, and with it any position, is read on its own and unpacked by numpy as a whole.
"""

from __future__ import annotations

import io
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessiongrain.llm.common import bounded_batches, cut, read_table, scratch_path

MAGIC = b"SGTB0001"
HEADER = struct.Struct("<8sIIQQQ")
BLOCK_IDS = 4096
#: A file is closed once it holds so many ids; one text is never split over files.
FILE_IDS = 4 << 20
END_ID = 2
CACHE_ENTRIES = 400_000


def bits_for(vocabulary: int) -> int:
    """Fewest bits that hold the ids 0 to vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """ids in `bits` bits each, least bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(planes.reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype("<u4")
    planes = np.zeros((count, 32), np.uint8)
    planes[:, :bits] = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    return np.packbits(planes, axis=1, bitorder="little").view("<u4").reshape(-1)


def write_file(out, doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, bits: int, block: int = BLOCK_IDS) -> None:
    blocks = [pack(ids[i : i + block], bits) for i in range(0, len(ids), block)]
    out.write(HEADER.pack(MAGIC, bits, block, len(doc_ids), len(ids), len(blocks)))
    out.write(np.array([x or 0 for x in doc_ids], "<i8").tobytes())
    out.write(np.array([x is None for x in doc_ids], np.uint8).tobytes())
    out.write(np.concatenate([[0], np.cumsum(lengths)]).astype("<u8").tobytes())
    out.write(np.concatenate([[0], np.cumsum([len(x) for x in blocks])]).astype("<u8").tobytes())
    out.write(b"".join(blocks))


class TokenFile:
    """Random access to one file: document table, and ids of any range by the blocks that hold it."""

    def __init__(self, handle):
        self.handle = handle
        magic, self.bits, self.block, self.n_docs, self.n_ids, n_blocks = HEADER.unpack(handle.read(HEADER.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.doc_ids = np.frombuffer(handle.read(8 * self.n_docs), "<i8")
        self.null_ids = np.frombuffer(handle.read(self.n_docs), np.uint8).astype(bool)
        self.first = np.frombuffer(handle.read(8 * (self.n_docs + 1)), "<u8").astype(np.int64)
        self.offsets = np.frombuffer(handle.read(8 * (n_blocks + 1)), "<u8").astype(np.int64)
        self.base = HEADER.size + 17 * self.n_docs + 8 + 8 * (n_blocks + 1)

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.zeros(0, "<u4")
        a, b = start // self.block, -(-stop // self.block)
        self.handle.seek(self.base + int(self.offsets[a]))
        data = self.handle.read(int(self.offsets[b] - self.offsets[a]))
        parts = [unpack(data[int(self.offsets[k] - self.offsets[a]) : int(self.offsets[k + 1] - self.offsets[a])], self.bits, min(self.block, self.n_ids - k * self.block)) for k in range(a, b)]
        return np.concatenate(parts)[start - a * self.block : stop - a * self.block]


_TAIL = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"


class WordEncoder:
    """Ids of a `tokenizers` file's texts, each distinct white-space word encoded once.

    The file's normaliser and pre-tokenizer never look across white space, so a text's ids are its words'
    ids in order. Plain words (letters, then perhaps punctuation) go to the model directly; any other goes
    through the whole tokenizer.
    """

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.vocabulary = self.tokenizer.get_vocab_size(True)
        self.kind = "<u2" if self.vocabulary <= 1 << 16 else "<u4"
        self.entries = entries
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the byte-level alphabet: these stand for themselves
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}
        encode = self._encode

        class Words(dict):
            def __missing__(self, word: str) -> bytes:
                if len(self) >= entries:
                    self.clear()
                self[word] = out = encode(word)
                return out

        self.words = Words()

    def _encode(self, word: str) -> bytes:
        core = word if word.isalpha() else word.rstrip(_TAIL)
        if not core.isalpha() or "Σ" in core or "İ" in core:
            return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, self.kind).tobytes()
        parts = [core.lower() if core.isascii() else unicodedata.normalize("NFC", core).lower().encode().decode("latin-1").translate(self.letters)]
        if len(core) < len(word):
            parts.append(word[len(core) :])
        return np.array([t.id for p in parts for t in self.model.tokenize(p)], self.kind).tobytes()

    def __call__(self, text: str) -> bytes:
        if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:  # white space to str.split() alone
            words = [w for x in text.split(" ") for w in x.replace("\t", "\n").split("\n")]
        else:
            words = text.split()
        return b"".join(map(self.words.__getitem__, words))


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, append end_id, and write the ids to files under `path` in ascending order of doc_id.

    Returns one row per file: file, part, piece, n_docs, n_ids, start (ids in all files before it). Files are
    written under a temporary name and moved, so a task that runs again replaces its own files by equal ones.
    Null ids come first; equal ids are ordered by their texts; a null text is empty and gives end_id alone.
    """
    bounded_batches(docs.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(path)
        store.create_dir(top, recursive=True)
        context = TaskContext.get()
        part, encode, rows = context.partitionId(), _encoder(tokenizer), []
        end = np.array([end_id], encode.kind).tobytes()
        bits = bits_for(max(encode.vocabulary, end_id + 1))
        doc_ids: list[int | None] = []
        texts: list[bytes] = []
        held = 0

        def close() -> None:
            nonlocal doc_ids, texts, held
            name = f"{top}/part-{part:06d}-{len(rows):06d}.sgtb"
            size = np.dtype(encode.kind).itemsize
            with store.open_output_stream(f"{name}.{context.taskAttemptId()}") as out:
                write_file(out, doc_ids, [len(t) // size for t in texts], np.frombuffer(b"".join(texts), encode.kind), bits)
            store.move(f"{name}.{context.taskAttemptId()}", name)
            rows.append((name, part, len(rows), len(doc_ids), held))
            doc_ids, texts, held = [], [], 0

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                doc_ids.append(doc_id)
                texts.append(encode(text or "") + end)
                held += len(texts[-1]) // len(end)
                if held >= FILE_IDS:
                    close()
        if doc_ids:
            close()
        if rows:
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["file", "part", "piece", "n_docs", "n_ids"])

    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    files = cut(rows.repartitionByRange(order[0]).sortWithinPartitions(*order).mapInArrow(write, "file string, part int, piece int, n_docs long, n_ids long"), "token-files")
    before = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)  # one row per file of millions of ids
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(files: DataFrame, path: str) -> DataFrame:
    """The documents of the files of write_token_files(): doc_id, start, n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(path)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(row["file"]) as handle:
                    held = TokenFile(handle)
                    out = []
                    for a in range(0, held.n_docs, 2048):
                        b = min(a + 2048, held.n_docs)
                        ids = held.ids(int(held.first[a]), int(held.first[b]))
                        at = held.first[a : b + 1] - held.first[a]
                        out += [zlib.crc32(ids[at[i] : at[i + 1]]) for i in range(b - a)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(held.doc_ids, pa.int64(), mask=held.null_ids), pa.array(held.first[:-1] + row["start"]), pa.array(np.diff(held.first)), pa.array(out, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    spread = files.select("file", "start").repartition(F.col("file"))
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write docs as token files in the shared folder and read every document's digest back.

    One row per input row: doc_id, start, n_tokens, ids_crc32. Empty in, empty out (no files).
    """
    path = scratch_path(docs.sparkSession, "sgtb")
    return read_token_files(write_token_files(docs, path, tokenizer, end_id, id_col, text_col), path)


def op7_token_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_files(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def round_trip(ids: np.ndarray, bits: int, block: int = BLOCK_IDS) -> np.ndarray:
    """ids written to a file in memory and read again."""
    out = io.BytesIO()
    write_file(out, [0], [len(ids)], ids, bits, block)
    out.seek(0)
    return TokenFile(out).ids(0, len(ids))
