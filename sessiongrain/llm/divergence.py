"""Source divergence audit: how the sources of a language differ in their terms, by joint count histograms."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessiongrain.llm.common import bounded_batches, cut, discard, read_table

#: A language keeps the terms of this many of its documents or more.
LEAST_DOCS = 30
#: Added to every count, and the whole that probabilities are given in.
PRIOR = 5
WHOLE = 1_000_000_000
#: Terms reported for a group.
TOP_TERMS = 50
#: (language, source, term) entries that a task holds before it hands them on.
TABLE_ENTRIES = 200_000

#: Bytes to terms and separators: ASCII letters in lower case, bytes of other code points as they are, the rest a space.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", entries: int = TABLE_ENTRIES) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of every term and the documents that hold it, in parts to be added up.

    A term is a run of ASCII letters and other than ASCII characters, A-Z in lower case; whole texts are
    read. Each task adds its documents up in tables of about `entries` terms, so what is shuffled is less than the words.
    """
    bounded_batches(docs.sparkSession)
    names = ["lang", "source", "term", "n", "docs"]

    def emitted(tables: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (count, seen) in tables.items():
            terms = list(count)
            columns = [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(list(count.values()), pa.int64()), pa.array([seen[t] for t in terms], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = text.translate(_TERM_BYTES).split()
                count, seen = tables.setdefault((lang, source), (Counter(), Counter()))
                before = len(count)
                count.update(words)
                seen.update(set(words))
                held += len(count) - before
                if held >= entries:
                    yield from emitted(tables)
                    tables, held = {}, 0
        yield from emitted(tables)

    texts = docs.select(_group(lang_col, "lang"), _group(source_col, "source"), F.coalesce(text_col, F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _group(column: str, name: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("")).alias(name)


def probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(WHOLE * (count + PRIOR) / (total + PRIOR * terms)), exact for counts of any table."""
    scaled = (count + PRIOR).cast("decimal(19,0)") * F.lit(WHOLE).cast("decimal(10,0)")
    return 1 + F.call_function("div", scaled, (total + PRIOR * terms).cast("decimal(19,0)"))


def kept_counts(docs: DataFrame, least_docs: int = LEAST_DOCS, **columns: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """docs -> groups, terms, counts, all three written tables.

    groups: (g, lang, source, total, terms, lang_total): every (lang, source) that occurs, with the occurrences of kept terms
    there, the number of the language's kept terms and their occurrences in the language. terms: (t, lang, term, lang_count).
    counts: (t, g, n), for n above zero. g and t are numbers within the run.
    """
    by_source = term_counts(docs, **columns).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_source = cut(by_source, "terms_by_source")
    kept = by_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_count")).where(F.col("docs") >= least_docs)
    terms = cut(kept.select(F.monotonically_increasing_id().alias("t"), "lang", "term", "lang_count"), "kept_terms")
    langs = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_count").alias("lang_total"))
    found = cut(by_source.join(terms.select("t", "lang", "term"), ["lang", "term"]).select("t", "lang", "source", "n"), "kept_by_source")
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    named = docs.select(_group(columns.get("lang_col", "lang"), "lang"), _group(columns.get("source_col", "source"), "source")).distinct()
    filled = named.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    groups = cut(filled.select(F.monotonically_increasing_id().alias("g"), "lang", "source", "total", "terms", "lang_total"), "groups")
    counts = cut(found.join(groups.select("g", "lang", "source"), ["lang", "source"]).select("t", "g", "n"), "counts")
    discard(by_source, found)
    return groups, terms, counts


def joint_histograms(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """(a, b, count_a, count_b, cells): for each two groups a < b of a language, how many of its kept terms have these counts there.

    Terms that both groups have are tallied at once by (count, count): a term's rows meet only each other,
    at most one row a source, and the tally is partially aggregated in the task that makes it. Cells with
    a zero are implied: of the terms that a has n times (its own histogram), those that b has too are
    taken away, and what neither has is what is left of the language's terms. Cells add up to that number.
    """
    left, right = counts.select("t", F.col("g").alias("a"), F.col("n").alias("count_a")), counts.select("t", F.col("g").alias("b"), F.col("n").alias("count_b"))
    keys = ["a", "b", "count_a", "count_b"]
    both = cut(left.join(right, "t").where("a < b").groupBy(*keys).agg(F.count("*").alias("cells")), "joint")
    none = F.lit(0).cast("long")
    corrected = both.groupBy("a", "b", "count_a").agg(F.sum("cells").alias("m")).select("a", "b", "count_a", none.alias("count_b"), (-F.col("m")).alias("cells"))
    corrected = corrected.unionByName(both.groupBy("a", "b", "count_b").agg(F.sum("cells").alias("m")).select("a", "b", none.alias("count_a"), "count_b", (-F.col("m")).alias("cells")))
    shared = both.groupBy("a", "b").agg(F.sum("cells").alias("m")).select("a", "b", none.alias("count_a"), none.alias("count_b"), F.col("m").alias("cells"))
    own = cut(counts.groupBy("g", "n").agg(F.count("*").alias("h")), "histograms")
    have = own.groupBy("g").agg(F.sum("h").alias("have"))
    sized = groups.join(have, "g", "left").select("g", "lang", "terms", F.coalesce("have", F.lit(0)).alias("have"))
    pairs = sized.select(F.col("g").alias("a"), "lang", "terms", F.col("have").alias("have_a")).join(sized.select(F.col("g").alias("b"), "lang", F.col("have").alias("have_b")), "lang").where("a < b")
    pairs = cut(pairs.select("a", "b", (F.col("terms") - F.col("have_a") - F.col("have_b")).alias("rest")), "group_pairs")
    alone = pairs.join(own.select(F.col("g").alias("a"), F.col("n").alias("count_a"), F.col("h").alias("cells")), "a").select("a", "b", "count_a", none.alias("count_b"), "cells")
    alone = alone.unionByName(pairs.join(own.select(F.col("g").alias("b"), F.col("n").alias("count_b"), F.col("h").alias("cells")), "b").select("a", "b", none.alias("count_a"), "count_b", "cells"))
    neither = pairs.select("a", "b", none.alias("count_a"), none.alias("count_b"), F.col("rest").alias("cells"))
    implied = corrected.unionByName(shared).unionByName(alone).unionByName(neither).groupBy(*keys).agg(F.sum("cells").alias("cells")).where("cells > 0")
    return both.unionByName(implied)


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, **columns: str) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) that occurs.

    part `pair`: the distance to each other source of the language, summed over all its kept terms, from the joint
    histogram: |p - q| is evaluated once for each (count, count) and taken times the cells. part `term`: the `top_terms` terms
    that the group uses more than its language does. Ranks by value, descending, then by item's bytes.
    Null texts, languages and sources count as empty strings; repeated rows are documents of their own; groups
    and languages without kept terms have distances of zero and no terms. Other columns are not read. Empty in, empty out.
    columns: text_col, lang_col, source_col where the names differ.
    """
    groups, terms, counts = kept_counts(docs, least_docs, **columns)
    facts = lambda side: groups.select(F.col("g").alias(side), F.col("total").alias(f"total_{side}"), *([F.col("terms")] if side == "a" else []))
    cells = joint_histograms(groups, counts).join(facts("a"), "a").join(facts("b"), "b")
    apart = F.abs(probability(F.col("count_a"), F.col("total_a"), F.col("terms")) - probability(F.col("count_b"), F.col("total_b"), F.col("terms")))
    distances = cut(cells.groupBy("a", "b").agg(F.sum(apart * F.col("cells")).alias("value")), "distances")
    named = groups.select("g", "lang", "source")
    ways = distances.select(F.col("a").alias("g"), F.col("b").alias("other"), "value").unionByName(distances.select(F.col("b").alias("g"), F.col("a").alias("other"), "value"))
    # Languages without kept terms have no cells; their pairs are there all the same.
    bare = groups.where("terms = 0").select("g", "lang").join(groups.where("terms = 0").select(F.col("g").alias("other"), "lang"), "lang").where("g <> other").select("g", "other", F.lit(0).cast("long").alias("value"))
    pairs = ways.unionByName(bare).join(named, "g").join(named.select(F.col("g").alias("other"), F.col("source").alias("item")), "other").select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    used = counts.join(groups, "g").join(terms.select("t", "term", "lang_count"), "t")
    p, q = probability(F.col("n"), F.col("total"), F.col("terms")), probability(F.col("lang_count"), F.col("lang_total"), F.col("terms"))
    over = used.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (p - q).alias("value")).where("value > 0")
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item")))
    return pairs.withColumn("rank", place).unionByName(over.withColumn("rank", place).where(F.col("rank") <= top_terms))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read_table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS i,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
     w AS (SELECT lang, source, i, unnest(words) AS term FROM d),
     kept AS (SELECT lang, term, count(*) AS lang_count FROM w GROUP BY ALL HAVING count(DISTINCT i) >= 30),
     g AS (SELECT DISTINCT lang, source FROM d),
     n AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
     grid AS (SELECT g.lang, g.source, k.term, k.lang_count, coalesce(n.c, 0) AS c FROM g JOIN kept k ON g.lang = k.lang
              LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
     sums AS (SELECT *, sum(c) OVER (PARTITION BY lang, source) AS total, count(*) OVER (PARTITION BY lang, source) AS v,
                     sum(lang_count) OVER (PARTITION BY lang, source) AS lang_total FROM grid),
     p AS (SELECT lang, source, term, c, (1 + (1000000000::HUGEINT * (c + 5)) // (total + 5 * v)::HUGEINT) AS p,
                  (1 + (1000000000::HUGEINT * (lang_count + 5)) // (lang_total + 5 * v)::HUGEINT) AS q FROM sums),
     pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                      coalesce((SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
                                WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
               FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
     terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (FROM pairs UNION ALL FROM terms))
WHERE part = 'pair' OR rank <= 50
"""
