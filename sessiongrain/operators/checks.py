"""Checks that return issues as rows: partitions, citations, links, uniqueness; and guarded model answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessiongrain.operators.rules import episode_route
from sessiongrain.operators.sessions import coverage

# Short replies that cannot open a task of their own.
DEPENDENT_START = r"(?i)^(?:好(?:的|呢|呀)?|行|对|是的|没问题|方案\s*[0-9一二三四五六七八九十]+|按(?:照)?(?:这个|上面|前面)|继续(?:完成|修改|处理|做)?|这个|这样)(?:[\s，,。.!！?？]|$)"
DEPENDENT_PREFIXES = ("继续", "这个", "这样", "按这个", "按照这个", "按上面", "按照上面", "按前面", "按照前面")


def context_dependent(text: Column) -> Column:
    compact = F.trim(F.regexp_replace(text, r"\s+", " "))
    starts = compact.rlike(DEPENDENT_START)
    for p in DEPENDENT_PREFIXES:
        starts = starts | compact.startswith(p)
    return (F.length(compact) > 0) & (F.length(compact) <= 80) & starts


def unique(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows, or an error at execution if a key occurs twice."""
    counted = rows.withColumn("__n", F.count("*").over(Window.partitionBy(*keys)))
    return counted.where(F.when(F.col("__n") == 1, True).otherwise(F.raise_error(F.concat_ws(" ", F.lit("duplicate key"), *[F.col(k).cast("string") for k in keys])).cast("boolean"))).drop("__n")


def partition_issues(turns: DataFrame, episodes: DataFrame, trace: str = "trace_id") -> DataFrame:
    """(trace, issue, detail) for episodes that do not cover each user turn once in order.

    turns: trace, turn_id, pos (from 0), content. episodes: trace, ord, start_turn_id, end_turn_id, query_turn_id.
    Lists of turns hold at most 12 ids, as reports of one trace.
    """
    at = turns.select(trace, F.col("turn_id").alias("__t"), F.col("pos").alias("__p"))

    def placed(rows: DataFrame, column: str, into: str) -> DataFrame:
        return rows.join(at.withColumnRenamed("__t", column).withColumnRenamed("__p", into), [trace, column], "left")

    e = placed(placed(placed(episodes, "start_turn_id", "start"), "end_turn_id", "end"), "query_turn_id", "query")
    previous = F.lag("start").over(Window.partitionBy(trace).orderBy("ord"))
    e = e.withColumn("__prev", previous)
    found = F.array_compact(
        F.array(
            F.when(F.col("start").isNull(), "unknown_start"), F.when(F.col("end").isNull(), "unknown_end"), F.when(F.col("start") > F.col("end"), "reversed_range"),
            F.when(F.col("start") <= F.col("__prev"), "start_not_increasing"), F.when(F.col("query_turn_id").isNotNull() & F.col("query").isNull(), "unknown_query"),
            F.when((F.col("query") < F.col("start")) | (F.col("query") > F.col("end")), "query_outside_boundary"),
        )
    )
    own = e.select(trace, F.explode(found).alias("issue"), F.col("ord").cast("string").alias("detail"))
    times = coverage(turns.select(trace, "pos"), e.where("start <= end").select(trace, "start", "end"), [trace])
    joined = times.join(turns, [trace, "pos"])
    listed = lambda cond, name: joined.where(cond).groupBy(trace).agg(F.array_join(F.slice(F.transform(F.array_sort(F.collect_list(F.struct("pos", "turn_id"))), lambda x: x["turn_id"]), 1, 12), ",").alias("detail")).select(trace, F.lit(name).alias("issue"), "detail")
    opening = e.where("ord > 0").join(turns.select(trace, F.col("turn_id").alias("start_turn_id"), "content"), [trace, "start_turn_id"]).where(context_dependent(F.col("content")))
    soft = opening.select(trace, F.lit("context_dependent_start").alias("issue"), F.col("ord").cast("string").alias("detail"))
    empty = turns.select(trace).distinct().join(episodes.select(trace).distinct(), trace, "left_anti").select(trace, F.lit("no_episodes").alias("issue"), F.lit("").alias("detail"))
    return own.unionByName(listed(F.col("times") == 0, "uncovered_turns")).unionByName(listed(F.col("times") > 1, "overlapping_turns")).unionByName(soft).unionByName(empty)


def whole_trace_fallback(turns: DataFrame, trace: str = "trace_id") -> DataFrame:
    """One uncertain episode over each trace."""
    ends = turns.groupBy(trace).agg(F.min_by("turn_id", "pos").alias("start_turn_id"), F.max_by("turn_id", "pos").alias("end_turn_id"))
    return ends.withColumn("boundary", F.lit("uncertain")).withColumn("query_turn_id", F.lit(None).cast("string"))


def routed_episodes(episodes: DataFrame, issues: DataFrame, trace: str = "trace_id") -> DataFrame:
    """Recomputed before routing: signals from validated ones, goals without text, queries without turn, boundaries with issues."""
    broken = issues.select(trace).distinct().withColumn("__broken", F.lit(True))
    e = episodes.join(broken, trace, "left")
    e = e.withColumns(
        {
            "signals": F.when(F.col("n_signals") > 0, "present").otherwise("absent"),
            "goal": F.when(F.trim(F.coalesce("goal_text", F.lit(""))) == "", "insufficient").otherwise(F.col("goal")),
            "query": F.when((F.col("query") == "identified") & F.col("query_turn_id").isNull(), "uncertain").otherwise(F.col("query")),
            "boundary": F.when(F.coalesce("__broken", F.lit(False)), "uncertain").otherwise(F.col("boundary")),
        }
    ).drop("__broken")
    return e.withColumn("route", episode_route(*[F.col(c) for c in ("domain", "value", "boundary", "query", "clarity", "goal", "signals")]))


def citations(refs: DataFrame, events: DataFrame) -> DataFrame:
    """refs with `outcome`: the event must be provided, agree in role, turn, locator and membership, and hold the quote."""
    same = ("role", "turn_id", "locator", "membership")
    e = events.select("event_id", "body", "body_provided", *[F.col(c).alias(f"__{c}") for c in same])
    j = refs.join(e, "event_id", "left")
    outcome = F.when(F.col("body_provided").isNull(), "unknown_event").when(~F.col("body_provided"), "body_not_provided")
    for c in same:
        outcome = outcome.when(~F.col(c).eqNullSafe(F.col(f"__{c}")), f"{c}_differs")
    return j.withColumn("outcome", outcome.when(F.contains("body", F.col("quote")) & (F.length("quote") > 0), "valid").otherwise("quote_not_exact")).select(*refs.columns, "outcome")


def links(requirements: DataFrame, claims: DataFrame, evidence: DataFrame, mappings: DataFrame) -> DataFrame:
    """(case_id, issue, detail): repeated ids, and pointers to requirements, claims or evidence that are not there."""
    def twice(df: DataFrame, column: str) -> DataFrame:
        return df.groupBy("case_id", column).agg(F.count("*").alias("n")).where("n > 1").select("case_id", F.lit(f"repeated_{column}").alias("issue"), F.col(column).alias("detail"))

    def dangling(df: DataFrame, column: str, target: DataFrame, key: str, name: str) -> DataFrame:
        flat = df.select("case_id", F.explode(column).alias(key)) if df.schema[column].dataType.typeName() == "array" else df.select("case_id", F.col(column).alias(key)).where(F.col(key).isNotNull())
        return flat.join(target.select("case_id", key), ["case_id", key], "left_anti").select("case_id", F.lit(name).alias("issue"), F.col(key).alias("detail"))

    parts = [
        twice(requirements, "requirement_id"), twice(claims, "claim_id"), twice(evidence, "evidence_id"),
        dangling(claims, "evidence_ids", evidence, "evidence_id", "unknown_evidence"), dangling(mappings, "claim_ids", claims, "claim_id", "unknown_claim"),
        dangling(mappings, "requirement_id", requirements, "requirement_id", "unknown_requirement"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def merge_by_query(episodes: DataFrame, answers: DataFrame, keys: list[str], fields: list[str], order: str = "ord") -> DataFrame:
    """Model answers joined to their episodes; of several for one query the last by order counts; episodes without stay."""
    last = answers.groupBy(*keys).agg(F.max_by(F.struct(*fields), order).alias("__a"))
    return episodes.join(last, keys, "left").select(*[c for c in episodes.columns if c not in fields], *[F.col(f"__a.{c}").alias(c) for c in fields])


def merge_children(parents: DataFrame, children: DataFrame, key: str = "episode_id") -> DataFrame:
    """parents' rows, replaced by the child's where there is one."""
    return children.unionByName(parents.join(children.select(key), key, "left_anti"), allowMissingColumns=True)


def missing_evidence_queries(values: Column, most: int = 8) -> Column:
    return F.slice(F.array_distinct(F.filter(F.transform(values, lambda v: F.trim(v)), lambda v: v != "")), 1, most)


def valid_turn_refs(refs: Column, known: Column) -> Column:
    return F.array_distinct(F.filter(refs, lambda r: F.array_contains(known, r)))
