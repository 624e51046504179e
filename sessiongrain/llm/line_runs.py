"""Line dedup: suffix order of line-ID sequences by distributed prefix doubling; repeated runs, later copies deleted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessiongrain.llm.common import ROW, WORD_CLASS, cut, discard, let, read_table, with_row_id

#: Fewest lines of a run.
RUN_LINES = 2
#: Fewest words of a run: repeated blank or trivial lines stay.
RUN_WORDS = 5
#: Words from which a single line is a run of its own.
LINE_WORDS = 50
#: Buckets of the two-level prefix sums within one class of equal prefixes.
BUCKETS = 1024
#: A class with more than this part of all rows is dealt over SALTS tasks; there are fewer than 1 / HOT_PART such classes.
HOT_PART = 1 / 256
SALTS = 64


def document_lines(rows: DataFrame, line_words: int = LINE_WORDS) -> DataFrame:
    """(ROW columns, doc_id, text) -> (ROW columns, doc_id, pos, h1, h2, long): a line's ID is 128 bits of hash.

    long says whether the line has line_words words or more.
    """
    lines = rows.select(*ROW, "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    # A line of n words has at least 2 n - 1 characters, so most lines need no count.
    enough = (F.length("line") >= 2 * line_words - 1) & (F.regexp_count("line", F.lit(WORD_CLASS + "+")) >= line_words)
    return lines.select(*ROW, "doc_id", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), enough.alias("long"))


def _smaller(pairs: DataFrame, keys: list[str], order: list[str], bucket: Column) -> DataFrame:
    """pairs (keys, order, n) with `below`: the sum of n over the rows of the same keys that come before in order.

    bucket follows the order, so sums of whole buckets and sums within one make up the whole; no window
    holds more than one bucket of a class.
    """
    cut_up = pairs.withColumn("bucket", bucket)
    sums = cut_up.groupBy(*keys, "bucket").agg(F.sum("n").alias("whole"))
    over = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("offset", F.coalesce(F.sum("whole").over(over), F.lit(0))).drop("whole")
    inside = Window.partitionBy(*keys, "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = cut_up.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return placed.join(sums, [*keys, "bucket"]).withColumn("below", F.col("offset") + F.col("inside")).drop("bucket", "offset", "inside")


def with_classes(rows: DataFrame, classes: DataFrame, keys: list[str], total: int) -> DataFrame:
    """rows joined to their class (keys, n, ...); n counts the class's rows and total all rows, so fewer than
    1 / HOT_PART classes are hot. Only their keys are broadcast; their rows are dealt over SALTS tasks."""
    hot = F.col("n") > F.lit(total * HOT_PART)
    named = F.broadcast(classes.where(hot).select(*keys, F.lit(True).alias("hot")))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64(*ROW, "pos"), F.lit(SALTS)).cast("int")).otherwise(0)
    dealt = rows.join(named, keys, "left").withColumn("salt", salt).drop("hot")
    copies = F.explode(F.sequence(F.lit(0), F.when(hot, SALTS - 1).otherwise(0)))
    return dealt.join(classes.withColumn("salt", copies).drop("n"), [*keys, "salt"]).drop("salt")


def line_ranks(lines: DataFrame) -> DataFrame:
    """(ROW columns, doc_id, pos, h1, h2, long) -> (ROW columns, doc_id, pos, long, rank) of the lines that occur twice or more."""
    found = cut(lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").withColumn("all", F.lit(0)), "lines")
    total = found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Hash values are spread evenly, so their upper bits cut the order into even buckets.
    first = _smaller(found, ["all"], ["h1", "h2"], F.shiftright("h1", 54)).select("h1", "h2", "n", F.col("below").alias("rank"))
    ranks = cut(with_classes(lines, first, ["h1", "h2"], total).select(*ROW, "doc_id", "pos", "long", "rank"), "ranks")
    discard(found)
    return ranks


def suffix_ranks(lines: DataFrame, depth: int) -> DataFrame:
    """Ranks of lines -> (ROW columns, doc_id, pos, rank) of the suffixes whose first `depth` lines all repeat.

    rank is the place of a suffix's first `depth` lines in the order of all suffixes, equal for equal ones:
    the suffix array cut off at that depth, whose classes of equal rank are the intervals with a longest
    common prefix of `depth` or more. Lines that occur once cannot lie in a repeated run and went before. Each
    round joins the rank `step` lines on, and a suffix moves up by the suffixes of its class with a smaller
    one there; the last round overlaps where depth is no power of two. Suffixes that end before go.
    """
    now, have = lines, 1
    while have < depth:
        step = min(have, depth - have)
        ahead = now.select(*ROW, (F.col("pos") - step).alias("pos"), F.col("rank").alias("next"))
        paired = now.select(*ROW, "doc_id", "pos", "rank").join(ahead, [*ROW, "pos"])
        classes = paired.groupBy("rank", "next").agg(F.count("*").alias("n"))
        total = now.count()
        size = F.greatest(F.lit(1), F.floor(F.lit(total) / BUCKETS))
        moved = _smaller(classes, ["rank"], ["next"], F.floor(F.col("next") / size)).where("n > 1").select("rank", "next", "n", (F.col("rank") + F.col("below")).alias("to"))
        following = cut(with_classes(paired, moved, ["rank", "next"], total).select(*ROW, "doc_id", "pos", F.col("to").alias("rank")), "ranks")
        if now is not lines:
            discard(now)
        now, have = following, have + step
    return now


def later_copies(ranks: DataFrame, length: int) -> DataFrame:
    """(ROW columns, pos, to): the suffixes with one of the same rank before them by (doc_id, row, pos)."""
    place = F.struct("doc_id", *ROW, "pos")
    classes = ranks.groupBy("rank").agg(F.min(place).alias("earliest"), F.count("*").alias("n"))
    later = with_classes(ranks, classes, ["rank"], ranks.count()).where(~place.eqNullSafe(F.col("earliest")))
    return later.select(*ROW, "pos", (F.col("pos") + length).alias("to"))


def repeated_runs(lines: DataFrame, run_lines: int = RUN_LINES) -> DataFrame:
    """(ROW columns, from, to): the maximal runs of lines, [from, to), that are later copies.

    Runs consist of run_lines lines or more, or of single long ones. Those that touch or overlap are one.
    """
    first = line_ranks(lines)
    copies = later_copies(suffix_ranks(first, run_lines), run_lines).unionByName(later_copies(first.where("long"), 1))
    before = Window.partitionBy(*ROW).orderBy("pos", "to").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.col("pos") > F.max("to").over(before), F.lit(True)).cast("int")
    own = Window.partitionBy(*ROW).orderBy("pos", "to").rowsBetween(Window.unboundedPreceding, 0)
    runs = copies.withColumn("begins", begins).withColumn("run", F.sum("begins").over(own))
    return runs.groupBy(*ROW, "run").agg(F.min("pos").alias("from"), F.max("to").alias("to")).drop("run")


def deduplicated(docs: DataFrame, run_lines: int = RUN_LINES, id_col: str = "doc_id", text_col: str = "text", run_words: int = RUN_WORDS, line_words: int = LINE_WORDS) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_removed, n_runs, runs (array of from, to), kept_text.

    Lines are what stands between newlines, blank ones included. Runs of run_lines lines or more, and single
    lines of line_words words or more, that occur earlier, in (doc_id, row, line) order, in any document or the
    same one, are removed; the first copy stays. So do runs with fewer than run_words words in all, blank ones
    among them. Null texts have no lines and give an empty kept_text; the empty text has one empty line. Null
    ids come first; documents with one id are told apart by their rows; empty in, empty out.
    """
    rows = with_row_id(docs).select(*ROW, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    runs = repeated_runs(document_lines(rows, line_words), run_lines)
    mine = runs.groupBy(*ROW).agg(F.array_sort(F.collect_list(F.struct("from", "to"))).alias("found"))  # a text's own runs
    lines = F.coalesce(F.split("text", "\n"), F.array().cast("array<string>"))
    none = F.array().cast("array<struct<from:int,to:int>>")
    run_text = lambda x, r: F.array_join(F.slice(x, r["from"] + 1, r["to"] - r["from"]), "\n")
    worth = let(lines, lambda x: F.filter("found", lambda r: F.regexp_count(run_text(x, r), F.lit(WORD_CLASS + "+")) >= run_words))
    both = rows.join(mine, ROW, "left").withColumn("runs", F.when(F.col("found").isNull(), none).otherwise(worth))
    kept = let(lines, lambda x: F.filter(x, lambda _, i: ~F.exists("runs", lambda r: (i >= r["from"]) & (i < r["to"]))))
    removed = F.aggregate("runs", F.lit(0), lambda a, r: a + r["to"] - r["from"])
    text = F.when(F.size("runs") == 0, F.coalesce("text", F.lit(""))).otherwise(F.array_join(kept, "\n"))
    return both.select("doc_id", F.size(lines).cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"), F.size("runs").cast("long").alias("n_runs"), "runs", text.alias("kept_text"))


def op6_line_run_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deduplicated(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (
  SELECT doc_id, line, pos, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents
  )
), w AS (
  SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS following, lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS more FROM l
), s AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY line, following ORDER BY doc_id, pos) AS copy FROM w WHERE more IS NOT NULL
  ) WHERE copy > 1
), o AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS copy FROM l WHERE words >= 50
  ) WHERE copy > 1
), marked AS (
  SELECT doc_id, pos + k AS pos FROM s, (VALUES (0), (1)) AS v(k) UNION SELECT doc_id, pos FROM o
), placed AS (
  SELECT m.doc_id, m.pos, m.pos - row_number() OVER (PARTITION BY m.doc_id ORDER BY m.pos) AS run, l.words
  FROM marked AS m JOIN l ON l.doc_id = m.doc_id AND l.pos = m.pos
), gone AS (
  SELECT doc_id, pos, run FROM (SELECT *, sum(words) OVER (PARTITION BY doc_id, run) AS held FROM placed) WHERE held >= 5
), k AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed, count(DISTINCT g.run) AS n_runs, string_agg(line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL) AS kept
  FROM l LEFT JOIN gone AS g ON g.doc_id = l.doc_id AND g.pos = l.pos GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed, coalesce(k.n_runs, 0) AS n_runs, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents AS d LEFT JOIN k ON k.doc_id = d.doc_id
"""
