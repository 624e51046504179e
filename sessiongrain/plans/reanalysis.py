"""What must be computed again, and only that: descendants of changed sources, approved repair jobs, global indexes by parts."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessiongrain.functions.scalars import digest_id
from sessiongrain.operators.checks import unique
from sessiongrain.operators.reviews import approved
from sessiongrain.plans.judge import Judge, call_judge
from sessiongrain.sources.cuts import cuts

MODE = "agent_verify_only"


def stale(edges: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """(id, depth, cause): sources that were changed, added or removed (depth 0), and all that descends from them by edges.

    edges: parent_id, child_id, also in cycles or repeated; old and new: id, digest, one row a source (two null digests are
    equal). depth is the least number of edges from a changed source. Each round takes the children of the last one's
    finds that no round has found, and is written; rounds end with the longest of the shortest paths, not with the
    number of nodes. Null ids are no nodes. What does not descend from a change is in no round's rows.
    """
    cut = cuts(edges.sparkSession, "stale")
    side = lambda df, name: df.where("id IS NOT NULL").select("id", F.col("digest").alias(name), F.lit(True).alias(f"in_{name}"))
    both = side(old, "old").join(side(new, "new"), "id", "full_outer")
    cause = F.when(F.col("in_old").isNull(), "added").when(F.col("in_new").isNull(), "removed").when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    last = found = cut(both.select("id", F.lit(0).alias("depth"), cause.alias("cause")).where("cause IS NOT NULL"), "0")
    depth = 0
    while not last.isEmpty():
        depth += 1
        children = edges.join(last.select(F.col("id").alias("parent_id")), "parent_id", "left_semi").where("child_id IS NOT NULL").select(F.col("child_id").alias("id")).distinct()
        last = cut(children.join(found.select("id"), "id", "left_anti").select("id", F.lit(depth).alias("depth"), F.lit("descendant").alias("cause")), str(depth))
        found = found.unionByName(last)
    return found


class Prepared(NamedTuple):
    jobs: DataFrame
    screens: DataFrame


def prepare_reanalysis(queue: DataFrame, approvals: DataFrame, screens: DataFrame, cycle: str) -> Prepared:
    """Jobs of the approved queue items, one a batch and baseline run, and the baseline screens that they start from.

    queue: queue_id, batch_id, run_id, trace_id, mode; approvals: queue_id, decision, created_at; screens: batch_id, run_id,
    trace_id and more, one row a trace. jobs: job_id, batch_id, baseline_run_id, run_id, n_traces, n_items, status; run_id
    follows from the cycle and the set of traces, so preparing twice gives the same run. screens are the baseline's rows under the
    new run, with supersedes_run_id and cycle_id. Nothing approved, another mode, a trace without a screen and one with two raise.
    """
    cut = cuts(queue.sparkSession, "reanalysis")
    items = approved(queue, approvals)
    if items.isEmpty():
        raise ValueError("no approved queue items")
    known = F.when(F.col("mode") == MODE, True).otherwise(F.raise_error(F.concat(F.lit("unsupported mode "), F.coalesce("mode", F.lit("null")))).cast("boolean"))
    keys = ["batch_id", "run_id"]
    traces = cut(items.where(known).groupBy(*keys, "trace_id").agg(F.count("*").alias("n_items")), "traces")
    # Sums of hashes name the set of traces without sorting or collecting it.
    sums = [F.sum(F.xxhash64(F.lit(seed), "trace_id").cast("decimal(38,0)")).alias(f"sum_{seed}") for seed in (1, 2)]
    grouped = traces.groupBy(*keys).agg(F.count("*").alias("n_traces"), F.sum("n_items").alias("n_items"), *sums)
    named = grouped.withColumn("repair", digest_id("repair", F.lit(cycle), *[F.col(c) for c in (*keys, "n_traces", "sum_1", "sum_2")]))
    jobs = cut(named.select(digest_id("repair_job", F.lit(cycle), F.col("batch_id"), F.col("repair")).alias("job_id"), "batch_id", F.col("run_id").alias("baseline_run_id"), F.col("repair").alias("run_id"), "n_traces", "n_items", F.lit("prepared").alias("status")), "jobs")
    wanted = traces.join(jobs.select("batch_id", F.col("baseline_run_id").alias("run_id"), F.col("run_id").alias("repair")), keys).select(*keys, "trace_id", "repair")
    met = wanted.join(screens.withColumn("__screen", F.lit(True)), [*keys, "trace_id"], "left")
    there = F.coalesce("__screen", F.raise_error(F.concat(F.lit("approved trace without a screen: "), F.coalesce(F.col("trace_id").cast("string"), F.lit("null")))).cast("boolean"))
    reused = unique(met.where(there), [*keys, "trace_id"]).withColumns({"supersedes_run_id": F.col("run_id"), "run_id": F.col("repair"), "cycle_id": F.lit(cycle)})
    return Prepared(jobs, cut(reused.drop("__screen", "repair"), "screens"))


class Executed(NamedTuple):
    results: DataFrame
    failures: DataFrame
    jobs: DataFrame


def execute_reanalysis(prepared: Prepared, judge: Judge, system: str, prompt: str, done: DataFrame | None = None, attempts: int = 1) -> Executed:
    """Model calls for the traces of prepared jobs that `done` (run_id, trace_id, answer) does not hold yet.

    results are `done` and the new answers, failures (run_id, trace_id, error) what failed this time; a job is completed when each of its traces has an
    answer, else partial. Running again with the results as `done` sends only what failed before. Answers are written once.
    """
    cut = cuts(prepared.jobs.sparkSession, "executed")
    keys = ["run_id", "trace_id"]
    todo = prepared.screens if done is None else prepared.screens.join(done, keys, "left_anti")
    requests = todo.select(F.concat_ws("\x1f", "run_id", F.col("trace_id").cast("string")).alias("request_id"), *keys, F.coalesce(F.col(prompt).cast("string"), F.lit("")).alias("prompt"))
    answers = call_judge(requests, judge, system, attempts=attempts).select("request_id", "answer", "error")
    told = cut(requests.drop("prompt").join(answers, "request_id").drop("request_id"), "answers")
    new = told.where("error IS NULL").select(*keys, "answer")
    results = new if done is None else done.select(*keys, "answer").unionByName(new)
    failures = told.where("error IS NOT NULL").select(*keys, "error")
    counts = prepared.screens.select(*keys).join(results.select(*keys, F.lit(1).alias("ok")), keys, "left").groupBy("run_id").agg(F.count("ok").alias("n_completed"), (F.count("*") - F.count("ok")).alias("n_failed"))
    jobs = prepared.jobs.drop("status").join(counts, "run_id").withColumn("status", F.when(F.col("n_failed") == 0, "completed").otherwise("partial"))
    return Executed(results, failures, jobs)


def index_parts(index: DataFrame, catalog: DataFrame) -> DataFrame:
    """(batch_id, run_id, kind, value, n): counts of the active runs' cases by judgment, model, harness and gap.

    catalog: batch_id, active_run; index: batch_id, run_id, judgment, models, harnesses, gaps (arrays). A case
    without judgment, model or harness counts under a null value, repeated values of a list count each.
    """
    active = catalog.select("batch_id", F.col("active_run").alias("run_id"))
    none = F.array().cast("array<string>")
    given = lambda c: F.coalesce(F.filter(c, lambda v: v.isNotNull()), none)
    some = lambda c: F.when(F.size(given(c)) > 0, given(c)).otherwise(F.array(F.lit(None).cast("string")))
    of = lambda kind, values: F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))
    one = lambda v: F.array(v.cast("string"))
    seen = F.concat(of("case", one(F.lit(None))), of("judgment", one(F.nullif(F.col("judgment"), F.lit("")))), of("model", some("models")), of("harness", some("harnesses")), of("gap", given("gaps")))
    rows = index.join(active, ["batch_id", "run_id"], "left_semi").select("batch_id", "run_id", F.explode(seen).alias("s"))
    return rows.groupBy("batch_id", "run_id", "s.kind", "s.value").agg(F.count("*").alias("n"))


def rebuilt_parts(parts: DataFrame, index: DataFrame, catalog: DataFrame) -> DataFrame:
    """parts for the catalog as it is now: those of batches whose active run is the same stay, others are counted, those of dropped batches go.

    Runs are immutable, so a batch whose run has parts is not read; a batch without cases has none and is looked at each time. New counts are
    written once.
    """
    active = catalog.select("batch_id", F.col("active_run").alias("run_id"))
    have = parts.select("batch_id", F.col("run_id").alias("active_run")).distinct()
    fresh = cuts(parts.sparkSession, "index")(index_parts(index, catalog.join(have, ["batch_id", "active_run"], "left_anti")), "parts")
    return parts.join(active, ["batch_id", "run_id"], "left_semi").unionByName(fresh)


def global_summary(parts: DataFrame) -> DataFrame:
    """(kind, value, n) over all batches, null values as unknown, and the number of batches with cases."""
    counts = parts.groupBy("kind", F.when(F.col("kind") != "case", F.coalesce("value", F.lit("unknown"))).alias("value")).agg(F.sum("n").alias("n"))
    return counts.unionByName(parts.agg(F.lit("batch").alias("kind"), F.lit(None).cast("string").alias("value"), F.count_distinct("batch_id").alias("n")))


def global_indexes(parts: DataFrame) -> DataFrame:
    """(kind, value, case_count) of models, harnesses and gaps that cases name, the most common first."""
    named = parts.where(F.col("kind").isin("model", "harness", "gap") & F.col("value").isNotNull())
    return named.groupBy("kind", "value").agg(F.sum("n").alias("case_count")).orderBy("kind", F.desc("case_count"), "value")
