"""Token counts from the piece counts of distinct pre-tokens."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessiongrain.llm.common import bounded_batches, read_table

#: Distinct pre-tokens that a worker keeps at a time; beyond it the table starts anew, which costs time only.
TABLE_ENTRIES = 400_000
TOKEN_LIMIT = 4096

_RUNS = re.compile(" +[^ ]*|[^ ]+")


class PieceCounter:
    """Tokens per text of a sentencepiece model, each distinct pre-token encoded once.

    A text gets the model's leading space, its lines end at newlines, and a pre-token is a run of spaces
    with the word behind it. That is exact where no piece holds a newline or a space after another
    character (asked of the vocabulary once); other models, and texts with a literal U+2581, count whole texts.
    """

    def __init__(self, path: str, entries: int = TABLE_ENTRIES):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        probe = len(self.model.encode("\n")), len(self.model.encode("\na")), len(self.model.encode("a"))
        self.separable = probe[0] == 2 and probe[1] >= 3 and not any("\n" in p or re.search("[^▁]▁", p) for p in pieces)
        self.entries = entries
        self.counts: dict[str, int] = {}

    def _learn(self, new: list[str]) -> None:
        # " word": the model adds the space itself. "word" at a line's start: behind a newline, less that space and the newline.
        # A lone space is what stands before a newline at a text's start; an empty text gets no space at all.
        spaced = [x for x in new if x[0] == " " and x != " "]
        plain = [x for x in new if x[0] != " "]
        self.counts.update(zip(spaced, map(len, self.model.encode([x[1:] for x in spaced], num_threads=1)), strict=True))
        self.counts[" "] = len(self.model.encode("\n")) - 1
        self.counts.update(zip(plain, (len(x) - 2 for x in self.model.encode(["\n" + x for x in plain], num_threads=1)), strict=True))

    @staticmethod
    def frequencies(text: str) -> tuple[Counter, int]:
        """The text's pre-tokens with their frequencies, and its newlines."""
        lines = (" " + text).split("\n")
        found: Counter = Counter()
        for line in lines:
            if "  " in line or line[-1:] == " ":
                found.update(_RUNS.findall(line))
            elif line:
                words = line.split(" ")
                if words[0]:
                    found[words[0]] += 1
                found.update([" " + w for w in words[1:]])
        return found, len(lines) - 1

    def count(self, texts: list[str]) -> list[int]:
        if not self.separable:
            return [len(x) for x in self.model.encode(texts, num_threads=1)]
        out = []
        # The model writes a space as U+2581, so in a text that holds this character itself spaces do not part pre-tokens.
        odd = [i for i, t in enumerate(texts) if "\u2581" in t]
        whole = dict(zip(odd, map(len, self.model.encode([texts[i] for i in odd], num_threads=1)), strict=True))
        texts = [t if i not in whole else "" for i, t in enumerate(texts)]
        for a in range(0, len(texts), 100):
            rows = [self.frequencies(t) if t else (Counter(), 0) for t in texts[a : a + 100]]
            known = self.counts
            distinct = {w for found, _ in rows for w in found}
            new = [w for w in distinct if w not in known]
            if len(known) + len(new) > self.entries:
                known.clear()
                new = list(distinct)
            if new:
                self._learn(new)
            out += [sum([n * known[w] for w, n in found.items()]) + ends for found, ends in rows]
        return [whole.get(i, n) for i, n in enumerate(out)]


_COUNTERS: dict[str, PieceCounter] = {}


def token_counts(docs: DataFrame, tokenizer: str, limit: int = TOKEN_LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit.

    Pieces are counted once per distinct pre-token, joined by key to each document's pre-token frequencies
    and summed; ids are never kept. The join is local to a worker (a bounded hash table that outlives
    partitions), so texts and pre-tokens are not shuffled. Null texts count as empty: 0 bytes, 0 tokens.
    Very long texts are whole; ids may be null or repeat; other columns are ignored; empty in, empty out.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _COUNTERS:
            _COUNTERS[tokenizer] = PieceCounter(tokenizer)
        for batch in batches:
            n = _COUNTERS[tokenizer].count([x or "" for x in batch.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
