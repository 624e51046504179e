"""Conversation prefix trie by partition refinement."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessiongrain.llm.common import cut, discard, read_table, word_count

#: Digest of an empty list of members.
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def conversation_turns(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, pos, key, words): turns numbered from 1 in order of turn (nulls first), then role and text.

    key is the SHA-256 of role and text, words the number of words in the text; null roles and texts are empty. Rows
    without a conversation id are left out. Texts themselves go no further than this step.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    order = Window.partitionBy("conv").orderBy(F.col("at").asc_nulls_first(), "role", "text_key")
    # Equal turns with equal role are ordered by their texts, of which the digest is not enough.
    slim = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("at"), role.alias("role"), text.alias("text_key"), key.alias("key"), word_count(text).alias("words"))
    return slim.select("conv", F.row_number().over(order).alias("pos"), "key", "words")


def rebuilt_turns(own: DataFrame, block: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """own turns -> (turns, convs): the first h turns of the conversation conv - conv % block, then the own turns after the first h.

    h is crc32(decimal conv) % heads. turns: (conv, pos, key, words). convs: (conv), every one, also those left without a turn.
    """
    lengths = own.groupBy("conv").agg(F.max("pos").alias("n"))
    convs = lengths.select("conv", "n", (F.col("conv") - F.col("conv") % block).alias("base"), (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).cast("int").alias("h"))
    first = own.where(F.col("pos") < heads).select(F.col("conv").alias("base"), "pos", "key", "words")
    head = convs.where("h > 0").join(first, "base").where("pos <= h").select("conv", "pos", "key", "words")
    taken = convs.join(lengths.select(F.col("conv").alias("base"), F.col("n").alias("base_n")), "base", "left")
    taken = taken.select("conv", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken"))
    tail = own.join(taken, "conv").where("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "key", "words")
    return head.unionByName(tail), convs.select("conv")


def collapsed(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, reps): conversations with equal turns become one, their least id.

    members: (rep, conv). reps: (rep, n, len), n the conversations it stands for. Sequences are told apart by their
    length and 128 bits over all (place, turn) pairs, which partial aggregation adds up, so no conversation is gathered in a row.
    """
    print_ = [F.bit_xor(F.xxhash64(F.lit(k), "pos", "key")).alias(f"x{k}") for k in (1, 2)]
    whole = convs.join(turns.groupBy("conv").agg(*print_, F.count("*").alias("len")), "conv", "left").na.fill(0, ["x1", "x2", "len"])
    whole = cut(whole, "sequences")
    same = ["x1", "x2", "len"]
    classes = cut(whole.groupBy(*same).agg(F.min("conv").alias("rep"), F.count("*").alias("n")), "copies")
    return cut(whole.join(classes.drop("n"), same).select("rep", "conv"), "members"), classes.select("rep", "n", "len")


def member_digests(members: DataFrame) -> DataFrame:
    """(rep, ends): SHA-256, in hex, of each rep's conversation ids, ascending and joined by commas.

    Ids run through the digest in order as they come, in bounded memory; a rep has one task, as a digest has no parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rep, state = None, None
        for batch in batches:
            reps, convs = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            starts = np.concatenate([[0], np.flatnonzero(np.diff(reps)) + 1, [len(reps)]]) if len(reps) else []
            done: list[tuple[int, str]] = []
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                part = ",".join(map(str, convs[a:b])).encode()
                if rep == reps[a]:
                    state.update(b"," + part)
                    continue
                if rep is not None:
                    done.append((rep, state.hexdigest()))
                rep, state = int(reps[a]), hashlib.sha256(part)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.int64()), pa.array([x for _, x in done], pa.string())], ["rep", "ends"])
        if rep is not None:
            yield pa.RecordBatch.from_arrays([pa.array([rep], pa.int64()), pa.array([state.hexdigest()], pa.string())], ["rep", "ends"])

    return members.repartition("rep").sortWithinPartitions("rep", "conv").mapInArrow(run, "rep long, ends string")


def refined(turns: DataFrame, reps: DataFrame) -> list[DataFrame]:
    """Chains of the trie, a table for each round of splits: (conv, lo, hi, up, n, ended).

    All reps start in one class. In each round every active class (two reps or more) is split at the next turn at
    which its reps differ or one of them ends: reps with equal turns there form the classes of the next
    round. Turns that split no class are passed over together, so rounds grow with the splits along one
    path and not with its turns. A class of one rep is retired, and its tail is one chain. A chain is
    the nodes lo .. hi (depths) of a class: conv is its least member, n its conversations, up the
    least member of the node above lo, ended the rep that ends at hi, if any.
    """
    everyone = reps.agg(F.min("rep").alias("conv"), F.sum("n").alias("all"), F.count("*").alias("k")).where("k > 0")
    now = cut(reps.crossJoin(F.broadcast(everyone)).select("rep", F.col("n").alias("own"), "len", "conv", F.lit(0).alias("lo"), F.lit(None).cast("long").alias("up"), F.col("all").alias("n"), "k"), "classes")
    remaining, levels = turns.select(F.col("conv").alias("rep"), "pos", "key"), []
    while not now.isEmpty():
        chain = ["conv", "lo", "up", "n"]
        single = now.where("k = 1").select(*chain, F.col("len").cast("int").alias("hi"), F.col("rep").alias("ended"))
        active = now.where("k > 1").select("rep", "own", "len", *chain, "k")
        # The turns of active conversations behind their class's depth; one row without a turn for those that end there.
        following = active.join(remaining.select("rep", "pos", "key"), "rep", "left").where("pos > lo or pos is null or (pos = lo and len = lo)")
        following = cut(following.withColumns({c: F.when(F.col("pos") > F.col("lo"), F.col(c)) for c in ("key", "pos")}), "remaining")
        if levels:
            discard(remaining)
        remaining = following
        seen = remaining.where("pos is not null").groupBy("conv", "lo", "pos", "k").agg(F.min("key").alias("least"), F.max("key").alias("most"), F.count("*").alias("there"))
        splits = cut(seen.where("least <> most or there < k").groupBy("conv", "lo").agg(F.min("pos").alias("split")), "splits")
        parts = remaining.join(splits, ["conv", "lo"])
        # A rep that ends right before the split has no turn there; every other rep has one.
        ended = parts.where("len = split - 1").groupBy("conv", "lo").agg(F.min("rep").alias("ended"))
        shared = active.select(*chain).distinct().join(splits, ["conv", "lo"]).join(ended, ["conv", "lo"], "left")
        levels.append(cut(single.unionByName(shared.select(*chain, (F.col("split") - 1).cast("int").alias("hi"), "ended")), "chains"))
        parts = parts.where("pos = split").select("rep", "own", "len", F.col("conv").alias("was"), F.col("lo").alias("was_lo"), "split", "key")
        keys = ["was", "was_lo", "key"]
        classes = parts.groupBy(*keys).agg(F.min("rep").alias("conv"), F.sum("own").alias("n"), F.count("*").alias("k"))
        after = parts.join(classes, keys).select("rep", "own", "len", "conv", F.col("split").cast("int").alias("lo"), F.col("was").alias("up"), "n", "k")
        after = cut(after, "classes")
        discard(now, splits)
        now = after
    return levels


def folded(levels: list[DataFrame], sums: DataFrame) -> list[DataFrame]:
    """The chains with `children` (of their last node), `leaves` and `below` (tokens saved under the last node), from the last round back.

    sums: (conv, pos, words, until): the words of each turn, and of all turns up to it.
    """
    ends = sums.select("conv", F.col("pos").alias("hi"), F.col("until").alias("at_hi"))
    starts = sums.select("conv", F.col("pos").alias("lo"), (F.col("until") - F.col("words")).alias("before_lo"))
    out: list[DataFrame] = []
    for level in reversed(levels):
        here = level.join(ends, ["conv", "hi"], "left").join(starts, ["conv", "lo"], "left").na.fill(0, ["at_hi", "before_lo"])
        if out:
            saved = (F.col("n") - 1) * (F.col("at_hi") - F.col("before_lo")) + F.col("below")
            up = out[-1].groupBy(F.col("up").alias("conv"), (F.col("lo") - 1).alias("hi")).agg(F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum(saved).alias("below"))
            here = here.join(up, ["conv", "hi"], "left")
        else:
            here = here.withColumns({c: F.lit(None).cast("long") for c in ("children", "leaves", "below")})
        out.append(cut(here.withColumn("leaves", F.coalesce("leaves", F.lit(1).cast("long"))).na.fill(0, ["children", "below"]), "folded"))
    return out[::-1]


def prefix_trie(rows: DataFrame, rebuild: bool = False, **columns: str) -> DataFrame:
    """One row per node: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A node is a distinct sequence of the first turns of a conversation (role and text); its members are the
    conversations that start with it, the root's all of them. saved_tokens: the words that need not be
    computed again when each node's members share it, summed over its subtree. ends_sha256: of the members
    without another turn. rebuild: conversations are mixed first (see rebuilt_turns).
    Null turns come first, equal turns are ordered by role and text; null roles and texts are empty; rows without a
    conversation id are left out; repeated rows are turns of their own; other columns are not read. Empty in, empty out.
    """
    own = cut(conversation_turns(rows, **columns), "turns")
    turns, convs = rebuilt_turns(own) if rebuild else (own, own.select("conv").distinct())
    turns = cut(turns, "rebuilt")
    members, reps = collapsed(turns, convs)
    known = cut(turns.join(reps.select(F.col("rep").alias("conv")), "conv", "left_semi"), "distinct_turns")
    through = Window.partitionBy("conv").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    sums = cut(known.select("conv", "pos", "words", F.sum("words").over(through).alias("until")), "sums")
    levels = refined(known, reps)
    chains = folded(levels, sums)
    if not chains:
        return rows.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    every = chains[0]
    for chain in chains[1:]:
        every = every.unionByName(chain)
    top = every.where("lo = 0").select("conv", F.lit(0).alias("pos"), F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("until"))
    nodes = every.join(sums.unionByName(top), "conv").where("pos between lo and hi")
    last = F.col("pos") == F.col("hi")
    nodes = nodes.select(
        F.col("conv").alias("conv_id"), F.col("pos").cast("long").alias("depth"), F.when(F.col("pos") == F.col("lo"), F.col("up")).otherwise(F.col("conv")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(last, F.col("children")).otherwise(1).alias("n_children"), F.col("leaves").alias("n_leaves"),
        ((F.col("n") - 1) * (F.col("at_hi") - F.col("until") + F.col("words")) + F.col("below")).alias("saved_tokens"), F.when(last, F.col("ended")).alias("rep"),
    )
    return nodes.join(member_digests(members), "rep", "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_MEMBERS))).drop("rep", "ends")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"), rebuild=True)


def _crc32(text: str) -> str:
    """SQL: CRC-32 of an ASCII string, bit by bit."""
    bits = f"flatten(list_transform(list_transform(string_split({text}, ''), lambda x: ascii(x)), lambda x: [x, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"xor(4294967295, list_reduce(list_transform({bits}, lambda x: x::BIGINT), lambda c, x: {step}, 4294967295::BIGINT))"


SQL = f"""
WITH own AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM conversations),
     heads AS (SELECT DISTINCT c, c - c % 20 AS base, {_crc32("c::VARCHAR")} % 4 AS h FROM own),
     all_turns AS (SELECT h.c, o.pos AS place, o.role, o.text FROM heads h JOIN own o ON o.c = h.base AND o.pos <= h.h
                   UNION ALL SELECT h.c, 1000000000 + o.pos, o.role, o.text FROM heads h JOIN own o ON o.c = h.c AND o.pos > h.h),
     t AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY place) AS pos, sha256(length(role) || ':' || role || text) AS k,
                  len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM all_turns),
     s AS (SELECT c, coalesce(list(k ORDER BY pos) FILTER (pos IS NOT NULL), []) AS ks, coalesce(list(words ORDER BY pos) FILTER (pos IS NOT NULL), []) AS ws
           FROM heads LEFT JOIN t USING (c) GROUP BY c),
     m AS (SELECT c, ks, d, ks[1:d] AS prefix, CASE WHEN d = 0 THEN 0 ELSE ws[d] END AS words FROM (SELECT *, unnest(range(len(ks) + 1)) AS d FROM s)),
     n AS (SELECT prefix, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
                  coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(ks) = d), '') AS ends FROM m GROUP BY prefix, d),
     kids AS (SELECT prefix[1:d - 1] AS prefix, count(*) AS k FROM n WHERE d > 0 GROUP BY 1),
     f AS (SELECT n.*, coalesce(k, 0) AS k FROM n LEFT JOIN kids USING (prefix)),
     paths AS (SELECT prefix AS below, prefix[1:a] AS prefix, k, saved FROM (SELECT *, unnest(range(d + 1)) AS a FROM f)),
     sub AS (SELECT prefix, count(*) FILTER (k = 0) AS n_leaves, sum(saved) AS saved_tokens FROM paths GROUP BY prefix)
SELECT f.conv_id, f.d AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.k AS n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM f JOIN sub USING (prefix) LEFT JOIN f p ON f.d > 0 AND p.prefix = f.prefix[1:f.d - 1]
"""
