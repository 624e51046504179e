"""Mixing sources to target weights: token blocks, multinomial draws per output shard, slots by index permutation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessiongrain.llm.common import ROW, cut, read_table, with_row_id, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
BLOCK_WORDS = 512
#: Slots of one output shard.
SHARD_SLOTS = 4096
#: Rounds of the pseudorandom permutations.
ROUNDS = 32
#: Slots that one row stands for until they are dealt over tasks.
CHUNK = 1024
#: Rows that one bucket of the distributed prefix sums holds on average, until there are MOST_BUCKETS a source.
BUCKET_ROWS = 256
MOST_BUCKETS = 1 << 16
SEED = 7


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """(source, size) rows -> source, source_size, target; one row a source.

    Sources by code point, null last, take the weights in turn. Targets share `share` of all sizes by weight
    and stop at `most` times the source's size, what is over being shared again by weight. In order of
    cap / weight the stopped sources are a prefix, so one pass over that order finds the final level.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # one row a source
    w = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).cast("double")
    ranked = by_source.select("source", "source_size", w.alias("w"), (F.col("source_size") * float(most)).alias("cap"))
    order = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    stopped_before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight_from = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    level = ranked.withColumn("level", (F.sum("source_size").over(everything) * share - stopped_before) / weight_from)
    open_ = F.col("level") < F.col("cap") / F.col("w")
    final = F.max(F.when(open_, F.col("level"))).over(everything)
    return level.select("source", "source_size", F.when(open_, final * F.col("w")).otherwise(F.col("cap")).alias("target"))


def _positions(rows: DataFrame, amount: str, order: list, keys: list[str], buckets: int, into: str) -> DataFrame:
    """rows with the sum of `amount` over all rows of the same source before them, in order of (bucket, order).

    Sums within a bucket come from a window over that bucket, those of whole buckets from a small table, so
    a source of any size is spread over many tasks.
    """
    bucketed = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(SEED), *keys), F.lit(buckets)))
    whole = bucketed.groupBy("source", "bucket").agg(F.sum(amount).alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = whole.select(F.col("source").alias("s"), F.col("bucket").alias("t"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = bucketed.withColumn("inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    joined = placed.join(offsets, placed["source"].eqNullSafe(offsets["s"]) & (placed["bucket"] == offsets["t"]))
    return joined.withColumn(into, F.col("offset") + F.col("inside")).drop("s", "t", "offset", "inside", "bucket")


def permuted(index: Column, n: Column, *key: Column, inverse: bool = False) -> Column:
    """The image of index under a keyed pseudorandom permutation of 0 .. n - 1, for any n.

    Swap-or-not shuffle: every round pairs x with (k - x) mod n and a hash of the pair decides whether they change places.
    A round is its own inverse, so the same rounds backwards give the inverse permutation.
    """

    def step(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(F.lit(SEED), *key, r), n) - x, n)
        return F.when(F.xxhash64(F.lit(SEED + 1), *key, r, F.greatest(x, other)) > 0, other).otherwise(x)

    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1)) if not inverse else F.sequence(F.lit(ROUNDS - 1), F.lit(0))
    return F.aggregate(rounds, index.cast("long"), step)


def slot_plan(targets: DataFrame, block_words: int) -> DataFrame:
    """targets with, for each source: blocks, last_length (words of its last block), passes (whole ones), rest (words of the last
    pass), slots, short_at (where the last pass has the last block), first (slots of the sources before) and all_slots.

    The last pass has a slot more than its words need, as one of its blocks may be short.
    """
    size = F.col("source_size")
    rows = targets.where("source_size > 0").withColumn("words", F.round("target").cast("long"))
    rows = rows.withColumn("passes", F.floor(F.col("words") / size).cast("long")).withColumn("rest", F.col("words") - F.col("passes") * size)
    rows = rows.withColumn("blocks", F.ceil(size / block_words).cast("long")).withColumn("last_length", size - (F.col("blocks") - 1) * block_words)
    more = F.when(F.col("rest") > 0, F.least("blocks", F.ceil(F.col("rest") / block_words).cast("long") + 1)).otherwise(0)
    rows = rows.withColumn("slots", F.col("passes") * F.col("blocks") + more)
    rows = rows.withColumn("short_at", permuted(F.col("blocks") - 1, F.col("blocks"), F.col("source"), F.col("passes"), inverse=True))
    before = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)  # one row a source
    return rows.withColumn("first", F.coalesce(F.sum("slots").over(before), F.lit(0))).withColumn("all_slots", F.sum("slots").over(Window.partitionBy()))


def draw_slots(plan: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(source, slot, shard, place, pass, block, words): every slot of the mix.

    A pseudorandom permutation of all slots deals them to output shards of shard_slots places. A shard's source counts
    are thus a multinomial draw with the targets as weights, given that the shards' counts add up to the
    targets (the multivariate hypergeometric law), so no target is missed by chance. Within a source the slots
    run through its blocks, pass by pass, each pass in the order of a permutation of its own.
    """
    chunks = plan.where("slots > 0").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / CHUNK))))
    inside = F.sequence(F.col("chunk") * CHUNK, F.least((F.col("chunk") + 1) * CHUNK, F.col("slots")) - 1)
    # A number of partitions of its own: the few rows of chunks would else be put together into one task.
    spread = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = chunks.repartition(spread, "source", "chunk").withColumn("slot", F.explode(inside))
    slots = slots.withColumn("pass", F.floor(F.col("slot") / F.col("blocks"))).withColumn("index", F.pmod("slot", "blocks"))
    slots = slots.withColumn("block", permuted(F.col("index"), F.col("blocks"), F.col("source"), F.col("pass")))
    slots = slots.withColumn("at", permuted(F.col("first") + F.col("slot"), F.col("all_slots"), F.lit("shards")))
    length = F.when(F.col("block") == F.col("blocks") - 1, F.col("last_length")).otherwise(block_words)
    before = F.col("index") * block_words - F.when(F.col("short_at") < F.col("index"), block_words - F.col("last_length")).otherwise(0)
    words = F.when(F.col("pass") < F.col("passes"), length).otherwise(F.greatest(F.lit(0), F.least(length, F.col("rest") - before)))
    return slots.select("source", "slot", F.floor(F.col("at") / shard_slots).alias("shard"), F.pmod("at", F.lit(shard_slots)).alias("place"), "pass", (F.col("pass") < F.col("passes")).alias("whole"), "block", words.alias("words"))


def shard_counts(slots: DataFrame) -> DataFrame:
    """(shard, source, slots, words): the draw of each output shard."""
    return slots.groupBy("shard", "source").agg(F.count("*").alias("slots"), F.sum("words").alias("words"))


def mix(sizes: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ROW columns, k1, k2, source, size) -> pieces, slots, targets.

    Each source's words stand in one stream, in the order of the rows' content keys k1 and k2, cut into blocks of block_words.
    Slots (see draw_slots) name blocks; joined by block index they give back documents. Rows with equal keys
    are equal, so nothing depends on files or partitions.

    pieces: ROW columns, source, passes (whole ones), from, words: the words [from, from + words) of the
    document that the last pass takes, and the least shard that holds the piece.
    """
    n = sizes.count()
    buckets = max(1, min(n // BUCKET_ROWS, MOST_BUCKETS))
    targets = cut(source_targets(sizes), "targets")
    placed = _positions(sizes, "size", [F.col("k1"), F.col("k2"), *map(F.col, ROW)], ["k1"], buckets, "start").where("size > 0")
    last = F.col("start") + F.col("size") - 1
    pieces = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block_words), F.floor(last / block_words))))
    begin = F.greatest(F.col("start"), F.col("block") * block_words)
    pieces = pieces.select(
        *ROW, "source", "block", (begin - F.col("start")).alias("from"), (begin - F.col("block") * block_words).alias("at"),
        (F.least(last + 1, (F.col("block") + 1) * block_words) - begin).alias("length"),
    )
    slots = cut(draw_slots(slot_plan(targets, block_words), block_words, shard_slots), "slots")
    drawn = slots.where("words > 0").groupBy(F.col("source").alias("s"), F.col("block").alias("b")).agg(
        F.count_if("whole").alias("passes"), F.coalesce(F.sum(F.when(~F.col("whole"), F.col("words"))), F.lit(0)).alias("drawn"), F.min("shard").alias("shard")
    )
    taken = pieces.join(drawn, pieces["source"].eqNullSafe(drawn["s"]) & (pieces["block"] == drawn["b"]))
    words = F.greatest(F.lit(0), F.least("length", F.col("drawn") - F.col("at")))
    return taken.select(*ROW, "source", "passes", "from", "length", words.alias("words"), "shard"), slots, targets


def document_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(ROW columns, doc_id, source, k1, k2, size) of every row; k1 and k2 are 128 bits of its id and text. Without a source column all rows are of the source null."""
    source = F.col(source_col) if source_col in docs.columns else F.lit(None).cast("string")
    keys = [F.xxhash64(F.lit(k), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(id_col).isNull(), text_col).alias(f"k{k}") for k in (1, 2)]
    return cut(with_row_id(docs).select(*ROW, F.col(id_col).alias("doc_id"), source.alias("source"), *keys, word_count(F.col(text_col)).alias("size")), "sizes")


def mixed_sizes(docs: DataFrame, block_words: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, first_shard (the least shard with words of it, or null).

    Null texts have size 0 and are never taken; a null source is a source of its own, last in order; null
    and repeated ids are carried (rows are told apart by their place in the file). A source of size 0 has
    target 0. Empty in, empty out. Equal rows in any files, order and partitions give the same result; of
    rows that agree in id and text, which one gets which share is open.
    """
    sizes = document_sizes(docs, id_col, text_col, source_col)
    pieces, _, targets = mix(sizes, block_words)
    taken = pieces.groupBy(*ROW).agg(F.sum(F.col("words") + F.col("passes") * F.col("length")).alias("taken"), F.min("shard").alias("first_shard"))
    goals = targets.withColumnRenamed("source", "of")
    rows = sizes.join(goals, sizes["source"].eqNullSafe(goals["of"])).join(taken, ROW, "left")
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_shard")


def mix_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix as documents, with the columns of docs: whole texts once for each pass, then the words of the last pass.

    A text taken whole stays as it is, to the byte; parts are its words joined by spaces; a newline stands
    between passes and parts. Documents of which nothing is taken go, those with null, empty and blank texts among them. n_chars, where
    there is one, follows. Ids and sources may be null or repeat; other columns are kept, also under names used here; empty in, empty out.
    """
    sizes = document_sizes(docs, id_col, text_col, source_col)
    pieces, _, _ = mix(sizes, block_words)
    spans = F.array_sort(F.collect_list(F.when(F.col("words") > 0, F.struct("from", "words"))))  # a text's own blocks
    plan = pieces.groupBy(*ROW).agg(F.max("passes").alias("__sg_passes"), spans.alias("__sg_spans"), F.sum("words").alias("__sg_part"))
    plan = plan.where("__sg_passes > 0 or __sg_part > 0").join(sizes.select(*ROW, F.col("size").alias("__sg_size")), ROW)
    text = F.col(text_col)
    words = F.split(F.regexp_replace(text, r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+")
    parts = F.transform("__sg_spans", lambda s: F.array_join(F.slice(F.col("__sg_words"), (s["from"] + 1).cast("int"), s["words"].cast("int")), " "))
    whole = F.array_repeat(text, F.col("__sg_passes").cast("int"))
    last = F.when(F.col("__sg_part") == F.col("__sg_size"), F.array(text)).otherwise(parts)
    joined = with_row_id(docs).join(plan, ROW).withColumn("__sg_words", F.when(F.col("__sg_part").between(1, F.col("__sg_size") - 1), words))
    out = joined.withColumn(text_col, F.array_join(F.concat(whole, F.coalesce(last, F.array().cast("array<string>"))), "\n"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_sizes(read_table(spark, sf_dir, "documents"))
