"""Append-only reviews: revisions, latest state, merges with conflict checks, queues, approvals, lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessiongrain.functions.scalars import digest_id
from sessiongrain.operators.rollups import latest
from sessiongrain.operators.rules import queue_mode, queue_priority


def latest_reviews(events: DataFrame, case: str = "case_id") -> DataFrame:
    return latest(events, [case], ["revision", "event_sequence"])


def append_reviews(events: DataFrame, new: DataFrame, case: str = "case_id") -> tuple[DataFrame, DataFrame]:
    """(events and the accepted reviews, conflicts): a review is accepted if expected_revision is the case's latest.

    One case's reviews in `new` beyond the first are conflicts too. Accepted ones get the next revision, the
    next sequence and a link to what they supersede.
    """
    from pyspark.sql.window import Window

    state = latest_reviews(events).select(case, F.col("revision").alias("__rev"), F.col("review_id").alias("__last"))
    top = events.agg(F.coalesce(F.max("event_sequence"), F.lit(0)).alias("__top"))
    joined = new.withColumn("__nth", F.row_number().over(Window.partitionBy(case).orderBy("review_id"))).join(state, case, "left").crossJoin(F.broadcast(top))
    good = (F.col("__nth") == 1) & (F.coalesce("expected_revision", F.lit(0)) == F.coalesce("__rev", F.lit(0)))
    numbered = joined.where(good).withColumn("event_sequence", F.col("__top") + F.row_number().over(Window.orderBy("review_id")))
    accepted = numbered.withColumn("revision", F.coalesce("__rev", F.lit(0)) + 1).withColumn("supersedes", F.col("__last"))
    return events.unionByName(accepted.select(*[c for c in events.columns if c in accepted.columns]), allowMissingColumns=True), joined.where(~good).select(*new.columns)


def valid_reviews(rows: DataFrame, required: list[str], decisions: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): required fields are not blank, the decision is allowed, revision and sequence are 1 or more."""
    ok = F.col("decision").isin(*decisions) & (F.col("revision") >= 1) & (F.col("event_sequence") >= 1)
    for c in required:
        ok = ok & (F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "")
    ok = F.coalesce(ok, F.lit(False))
    return rows.where(ok), rows.where(~ok)


def merge_by_id(old: DataFrame, new: DataFrame, key: str = "review_id") -> DataFrame:
    """Union by id; equal copies collapse, other content under a known id raises."""
    both = old.unionByName(new, allowMissingColumns=True)
    version = F.sha2(F.to_json(F.struct(*both.columns)), 256)
    grouped = both.groupBy(key).agg(F.count_distinct(version).alias("__v"), F.first(F.struct(*both.columns)).alias("__r"))
    checked = grouped.where(F.when(F.col("__v") == 1, True).otherwise(F.raise_error(F.concat(F.lit("conflicting content for "), F.col(key).cast("string"))).cast("boolean")))
    return checked.select("__r.*")


def overlay(cases: DataFrame, reviews: DataFrame, case: str = "case_id") -> DataFrame:
    """cases with the latest human decision over the model's judgment."""
    human = latest_reviews(reviews).select(case, F.col("decision").alias("human_decision"))
    return cases.join(human, case, "left").withColumn("status", F.coalesce("human_decision", "pain_judgment"))


def remediation_queue(impacts: DataFrame) -> DataFrame:
    """(batch_id, run_id, trace_id, codes, seed) rows -> one queue item per trace: codes, mode, priority, state pending."""
    grouped = impacts.groupBy("batch_id", "run_id", "trace_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("codes")))).alias("codes"), F.bool_or("seed").alias("seed"))
    return grouped.select(digest_id("queue", F.col("batch_id"), F.col("run_id"), F.col("trace_id")).alias("queue_id"), "*", queue_mode(F.col("codes")).alias("mode"), queue_priority(F.col("codes"), F.col("seed")).alias("priority"), F.lit("pending").alias("state"))


def approved(queue: DataFrame, approvals: DataFrame, order: str = "created_at") -> DataFrame:
    """Queue items whose latest approval event approves them; nothing runs without one."""
    last = latest(approvals, ["queue_id"], [order])
    return queue.join(last.where(F.col("decision") == "approved").select("queue_id"), "queue_id", "left_semi")


def candidate_run(baseline: DataFrame, repaired: DataFrame, targets: DataFrame, key: str = "trace_id") -> DataFrame:
    """Baseline rows of untouched traces and repaired rows of the targets; a target without repair raises."""
    missing = targets.select(key).distinct().join(repaired.select(key).distinct(), key, "left_anti").agg(F.count("*").alias("__missing"))
    kept = baseline.join(targets.select(key).distinct(), key, "left_anti").unionByName(repaired.join(targets.select(key).distinct(), key, "left_semi"), allowMissingColumns=True)
    guarded = kept.crossJoin(F.broadcast(missing)).where(F.when(F.col("__missing") == 0, True).otherwise(F.raise_error(F.lit("targets without a repaired result")).cast("boolean")))
    return guarded.drop("__missing")


def interruption_followups(turns: DataFrame, key: str = "trace_id", position: str = "pos") -> DataFrame:
    """Interrupted turns with the next turn in which the user really wrote."""
    from sessiongrain.operators.sessions import next_where

    ahead = next_where(turns, [key], [position], F.when(F.col("real_user"), F.struct(position, "turn_id")), "follow")
    return ahead.where("interrupted").select(key, position, "turn_id", F.col(f"follow.{position}").alias("follow_pos"), F.col("follow.turn_id").alias("follow_turn_id"))


def lineage(events: DataFrame) -> DataFrame:
    """Edges from source records to the events made of them."""
    return events.select(digest_id("src", F.col("input_file"), F.col("record_index")).alias("source_record_id"), "event_id", F.lit("normalized_from").alias("edge"))


def pipeline_status(runs: DataFrame, stages: list[str], only_incomplete: bool = False) -> DataFrame:
    """Latest run of each batch; overall is the first stage that is not completed."""
    now = latest(runs, ["batch_id"], ["updated_at"])
    first: Column = F.coalesce(*[F.when(F.coalesce(F.col(s), F.lit("missing")) != "completed", F.concat(F.lit(f"{s}:"), F.coalesce(F.col(s), F.lit("missing")))) for s in stages], F.lit("completed"))
    out = now.withColumn("overall", first)
    return out.where("overall <> 'completed'") if only_incomplete else out
