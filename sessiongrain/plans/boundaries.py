"""Episode boundaries from a model: asked, checked against the turns, repaired, and replaced where they stay unsafe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessiongrain.operators.checks import context_dependent, whole_trace_fallback
from sessiongrain.operators.sessions import coverage
from sessiongrain.plans.judge import Judge, call_judge
from sessiongrain.sources.cuts import cuts

MOST_CHARS = 800_000
MOST_REPAIRS = 1
MOST_LISTED = 12


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def answered_episodes(answers: DataFrame, trace: str = "trace_id") -> DataFrame:
    """(trace, ord, broken, start_turn_id, end_turn_id, query_turn_id, query, boundary) of each answer's list; `broken` says what an element lacks."""
    found = F.try_variant_get(F.try_parse_json("answer"), "$.task_episodes", "array<variant>")
    flat = answers.select(trace, F.posexplode(found).alias("ord", "e"))
    at = lambda path: F.nullif(F.try_variant_get("e", path, "string"), F.lit(""))
    broken = F.when(~_is_object(F.col("e")), "not_object").when(~_is_object(F.try_variant_get("e", "$.episode_boundary", "variant")), "boundary_not_object")
    return flat.select(
        trace, "ord", broken.alias("broken"), at("$.episode_boundary.start_turn_id").alias("start_turn_id"), at("$.episode_boundary.end_turn_id").alias("end_turn_id"),
        at("$.initial_query.turn_id").alias("query_turn_id"), at("$.initial_query.judgment").alias("query"), at("$.episode_boundary.judgment").alias("boundary"),
    )


def answer_issues(turns: DataFrame, answers: DataFrame, trace: str = "trace_id") -> DataFrame:
    """answers with `issues`, in order: what keeps an answer from being an ordered partition of its trace's turns.

    turns: trace, turn_id, pos, content; answers: trace, answer (JSON), error. An issue that begins with
    `structural:` makes an answer unsafe, `semantic:` ones are doubts. Of turns with one id the last counts. Lists of ids hold
    at most 12. The windows are by trace, and a trace with an answer has fitted one request.
    """
    places = turns.join(answers.select(trace), trace, "left_semi").select(trace, "turn_id", "content", (F.row_number().over(Window.partitionBy(trace).orderBy("pos", "turn_id")) - 1).alias("p"))
    ids = places.where("turn_id <> ''").groupBy(trace, "turn_id").agg(F.max("p").alias("p"), F.max_by("content", "p").alias("content"))
    e = answered_episodes(answers, trace)
    for column in ("start", "end", "query"):
        e = e.join(ids.select(trace, F.col("turn_id").alias(f"{column}_turn_id"), F.col("p").alias(f"{column}_p"), *([F.col("content").alias("opening")] if column == "start" else [])), [trace, f"{column}_turn_id"], "left")
    start, end, asked = F.col("start_p"), F.col("end_p"), F.col("query_p")
    sound = F.col("broken").isNull() & start.isNotNull() & end.isNotNull() & (start <= end)
    before = F.last(F.when(sound, start), ignorenulls=True).over(Window.partitionBy(trace).orderBy("ord").rowsBetween(Window.unboundedPreceding, -1))
    e = e.withColumn("sound", F.coalesce(sound, F.lit(False))).withColumn("before", before)
    whole = F.col("broken").isNull()
    named = F.array_compact(
        F.array(
            F.concat(F.lit("structural:"), F.lit("episode_"), F.col("ord").cast("string"), F.lit(":"), F.col("broken")),
            *[
                F.when(cond, F.concat(F.lit(f"{kind}:episode_"), F.col("ord").cast("string"), F.lit(f":{issue}")))
                for kind, cond, issue in (
                    ("structural", whole & start.isNull(), "start_unknown"),
                    ("structural", whole & end.isNull(), "end_unknown"),
                    ("structural", whole & (start > end), "range_reversed"),
                    ("structural", F.col("sound") & (start <= F.col("before")), "not_strictly_ordered"),
                    ("structural", F.col("sound") & asked.isNull() & (F.col("query") == "identified"), "identified_query_unknown"),
                    ("structural", F.col("sound") & ~asked.between(start, end), "query_outside_boundary"),
                    ("semantic", F.col("sound") & (F.col("ord") > 0) & context_dependent(F.coalesce("opening", F.lit(""))), "context_dependent_start"),
                )
            ],
        )
    )
    own = e.groupBy(trace).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ord", named.alias("found")))), lambda x: x["found"])).alias("own"))
    times = coverage(places.select(trace, F.col("p").alias("pos")), e.where("sound").select(trace, F.col("start_p").alias("start"), F.col("end_p").alias("end")), [trace])
    kinds = times.where("times <> 1").join(places.withColumnRenamed("p", "pos"), [trace, "pos"])
    listed = lambda cond, name: F.when(F.count_if(cond) > 0, F.concat_ws(":", F.lit(f"structural:{name}"), F.count_if(cond).cast("string"), F.array_join(F.slice(F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("pos", "turn_id")))), lambda x: F.coalesce(x["turn_id"], F.lit(""))), 1, MOST_LISTED), ",")))
    covered = kinds.groupBy(trace).agg(F.array_compact(F.array(listed(F.col("times") == 0, "uncovered_turns"), listed(F.col("times") > 1, "overlap_turns"))).alias("covered"))
    none = F.array().cast("array<string>")
    length = F.size(F.try_variant_get(F.try_parse_json("answer"), "$.task_episodes", "array<variant>"))
    first = F.when(F.col("error").isNotNull(), F.concat(F.lit("structural:call_failed:"), F.col("error"))).when(length.isNull() | (length < 0), "structural:task_episodes_not_array").when(length == 0, "structural:task_episodes_empty")
    joined = answers.join(own, trace, "left").join(covered, trace, "left")
    return joined.select(*answers.columns, F.when(first.isNotNull(), F.array(first)).otherwise(F.concat(F.coalesce("own", none), F.coalesce("covered", none))).alias("issues"))


def screen_boundaries(turns: DataFrame, judge: Judge, system: str, repair_system: str, trace: str = "trace_id", most_chars: int = MOST_CHARS, most_repairs: int = MOST_REPAIRS) -> DataFrame:
    """(trace, ord, start_turn_id, end_turn_id, query_turn_id, boundary, strategy, n_calls, initial_issues, final_issues, needs_review), a row an episode.

    turns: trace (not null), turn_id, pos, content. A trace's turns are one request; its answer is checked, and one with
    issues goes back with them, up to most_repairs times, until none is left. A repaired answer replaces the one before.
    An answer that stays structurally unsafe, a call that raises, and a trace whose request has over most_chars
    characters (it is not put together) give one uncertain episode over the whole trace, for review; semantic doubts stay as issues.
    Each round's answers are written once, so no finished call is repeated. Null contents count as empty.
    """
    cut = cuts(turns.sparkSession, "boundaries")
    text = F.coalesce("content", F.lit(""))
    turns = turns.select(trace, F.col("turn_id").cast("string").alias("turn_id"), "pos", text.alias("content"))
    lengths = turns.groupBy(trace).agg(F.sum(F.length("content") + F.length(F.coalesce("turn_id", F.lit(""))) + 30).alias("chars"))
    fits = lengths.where(F.col("chars") <= most_chars).select(trace)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "turn_id", "content"))), lambda x: F.struct(x["turn_id"].alias("turn_id"), x["content"].alias("content")))
    views = cut(turns.join(fits, trace, "left_semi").groupBy(trace).agg(ordered.alias("turns")), "views")

    def asked(requests: DataFrame, said: str, n: int) -> DataFrame:
        short = requests.where(F.length("prompt") <= most_chars)
        answers = cut(call_judge(short, judge, said, trace, attempts=1).select(trace, "answer", "error"), f"answers-{n}")
        return cut(answer_issues(turns, answers, trace).withColumn("n_calls", F.lit(n + 1)), f"issues-{n}")

    state = asked(views.select(trace, F.to_json(F.struct(F.col(trace).alias("trace_id"), "turns")).alias("prompt")), system, 0)
    first = state.select(trace, F.col("issues").alias("initial_issues"))
    for n in range(1, most_repairs + 1):
        wrong = state.where((F.size("issues") > 0) & (F.col("n_calls") == n))
        if wrong.isEmpty():
            break
        request = F.struct(F.col(trace).alias("trace_id"), "turns", F.try_parse_json("answer").alias("previous_output"), F.col("issues").alias("validation_issues"))
        again = asked(wrong.join(views, trace).select(trace, F.to_json(request).alias("prompt")), repair_system, n)
        state = state.join(again.select(trace), trace, "left_anti").unionByName(again)
    unsafe = F.exists("issues", lambda x: x.startswith("structural:"))
    too_long = F.array(F.lit("structural:request_too_long"))
    about = lengths.select(trace).join(state, trace, "left").join(first, trace, "left").select(
        trace, "answer", F.coalesce(unsafe, F.lit(True)).alias("needs_review"), F.coalesce("n_calls", F.lit(0)).alias("n_calls"),
        F.coalesce("initial_issues", too_long).alias("initial_issues"), F.coalesce("issues", too_long).alias("final_issues"),
    )
    about = cut(about.withColumn("strategy", F.when(F.col("needs_review"), "fallback").when(F.col("n_calls") > 1, "repaired").otherwise("screened")), "verdicts")
    columns = ["ord", "start_turn_id", "end_turn_id", "query_turn_id", "boundary"]
    kept = answered_episodes(about.where(~F.col("needs_review")), trace).select(trace, *columns)
    whole = whole_trace_fallback(turns.join(about.where("needs_review"), trace, "left_semi"), trace).withColumn("ord", F.lit(0)).select(trace, *columns)
    return kept.unionByName(whole).join(about.drop("answer"), trace).select(trace, *columns, "strategy", "n_calls", "initial_issues", "final_issues", "needs_review")
