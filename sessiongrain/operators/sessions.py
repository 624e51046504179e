"""Sessionisation: carried turns, turn status, trace identity, user turns, spans and look-ahead."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessiongrain.functions.scalars import digest_id

# Starts of user messages that a harness wrote, and markers behind which the user's own text stands.
SYNTHETIC_PREFIXES = (
    "Base directory for this skill:",
    "[System reminder] This is a runtime system reminder, not user input.",
    "<task-notification>",
    "Resume from the paused agent session. The working directory is unchanged.",
    "[Request interrupted by user",
    "The previous request encountered a temporary API error.",
    "This session is being continued from a previous conversation that ran out of context.",
    "[system] Previously read image bytes have been cleared",
    "[User message] The previous PDF parsing attempt already failed",
)
USER_MARKERS = ("### User message",)
# Event types that say nothing about how a turn ended.
SILENT_TYPES = ("system_event", "model_call", "model_result", "token_usage")
OBSERVABLE_TYPES = ("user_message", "assistant_message", "tool_call", "tool_result", "error")


def starts_with_any(text: Column, prefixes: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | text.startswith(p)
    return out


def carry_forward(rows: DataFrame, key: list[str], order: list[str], opened: Column, closes: Column | None = None, into: str = "turn_id") -> DataFrame:
    """`into`: the last non-null `opened` of the key so far; a row where `closes` holds is the last of its turn."""
    before = Window.partitionBy(*key).orderBy(*order)
    if closes is None:
        return rows.withColumn(into, F.last(opened, ignorenulls=True).over(before))
    ended = rows.withColumn("__o", opened).withColumn("__c", F.coalesce(F.lag(F.coalesce(closes, F.lit(False))).over(before), F.lit(False)).cast("int"))
    parted = ended.withColumn("__p", F.sum("__c").over(before))
    return parted.withColumn(into, F.last("__o", ignorenulls=True).over(Window.partitionBy(*key, "__p").orderBy(*order))).drop("__o", "__c", "__p")


def turn_index(rows: DataFrame, session: list[str], turn: str, order: str, into: str = "turn_index") -> DataFrame:
    """Turns numbered from 1 by first appearance; rows without a turn have none."""
    first = rows.withColumn("__f", F.when(F.col(turn).isNotNull(), F.min(order).over(Window.partitionBy(*session, turn))))
    number = F.dense_rank().over(Window.partitionBy(*session).orderBy(F.col("__f").asc_nulls_last(), F.col(turn)))
    return first.withColumn(into, F.when(F.col(turn).isNotNull(), number)).drop("__f")


def turn_status(events: DataFrame, session: list[str] = ["session_id"], turn: str = "turn_id", order: str = "sequence") -> DataFrame:  # noqa: B006
    """One row per turn: aborted, error as aborted, completed, incomplete, or interrupted where a later turn follows.

    events has type, native_type and call_id. A turn without a terminator is complete if its last event of
    substance is a reply and every call has its result.
    """
    calls = F.collect_set(F.when(F.col("type") == "tool_call", F.col("call_id")))
    results = F.collect_set(F.when(F.col("type") == "tool_result", F.col("call_id")))
    last = F.max_by(F.when(~F.col("type").isin(*SILENT_TYPES), F.col("type")), F.when(~F.col("type").isin(*SILENT_TYPES), F.col(order)))
    flags = events.where(F.col(turn).isNotNull()).groupBy(*session, turn).agg(
        F.bool_or(F.col("native_type") == "turn_aborted").alias("aborted"), F.bool_or(F.col("type") == "error").alias("failed"),
        F.bool_or(F.col("native_type") == "task_complete").alias("done"), last.alias("last_type"),
        F.size(F.array_except(calls, results)).alias("open_calls"), F.min(order).alias("first_seen"), F.count("*").alias("n_events"),
    )
    status = (
        F.when(F.col("aborted") | F.col("failed"), "aborted").when(F.col("done"), "completed")
        .when((F.col("last_type") == "assistant_message") & (F.col("open_calls") == 0), "completed").otherwise("incomplete")
    )
    own = Window.partitionBy(*session)
    numbered = flags.withColumn("status", status).withColumn("turn_index", F.row_number().over(own.orderBy("first_seen", turn)))
    late = F.when((F.col("status") == "incomplete") & (F.col("turn_index") < F.max("turn_index").over(own)), "interrupted").otherwise(F.col("status"))
    return numbered.withColumn("status", late).select(*session, turn, "turn_index", "status", "n_events", "open_calls")


def single_or_mixed(values: Column) -> Column:
    """unknown for no value, the value for one, mixed for several; values is an aggregate set."""
    return F.when(F.size(values) == 0, "unknown").when(F.size(values) == 1, F.get(values, F.lit(0))).otherwise("mixed")


def trace_rollup(events: DataFrame, trace: str = "trace_id", session: str = "session_id", model: str = "model", harness: str = "harness") -> DataFrame:
    sets = {c: F.array_sort(F.collect_set(c)) for c in (session, model, harness)}
    return events.groupBy(trace).agg(sets[session].alias("sessions"), sets[model].alias("models"), sets[harness].alias("harnesses"), single_or_mixed(sets[harness]).alias("harness"), F.count("*").alias("n_events"))


def trace_identity(events: DataFrame, session: str = "session_id", project: str | None = None) -> DataFrame:
    """(session, trace_id): the native id if there is one, else a digest of adapters, projects and session; the same in every batch."""
    projects = F.array_join(F.array_sort(F.collect_set(project)), ",") if project else F.lit("")
    return events.groupBy(session).agg(
        F.coalesce(F.min("trace_id"), digest_id("trace", F.array_join(F.array_sort(F.collect_set("adapter")), ","), projects, F.col(session))).alias("trace_id")
    )


def clean_user_text(text: Column) -> Column:
    """What the user wrote: null for a harness's own messages, the part behind the last marker for wrapped ones."""
    out = text
    for marker in USER_MARKERS:
        out = F.when(F.contains(out, F.lit(marker)), F.substring_index(out, marker, -1)).otherwise(out)
    wrapped = text.startswith("[用户提问]") & F.contains(text, F.lit("用户消息："))
    after = F.regexp_replace(text, "(?s)^.*?用户消息：", "")
    return F.nullif(F.trim(F.when(starts_with_any(text, SYNTHETIC_PREFIXES), F.lit(None)).when(wrapped, after).otherwise(out)), F.lit(""))


def interruption(text: Column) -> Column:
    """generation_interrupted or tool_use_rejected for a user's interruption, else null."""
    action = F.when(F.contains(F.lower(text), F.lit("tool use")), "tool_use_rejected").otherwise("generation_interrupted")
    return F.when(text.startswith("[Request interrupted by user"), action)


def first_user_events(events: DataFrame, keys: list[str], order: str = "sequence", text: str = "content") -> DataFrame:
    """The first message of each key that the user really wrote: keys, event_id, content."""
    real = events.where(F.col("type") == "user_message").withColumn("content", clean_user_text(F.col(text))).where(F.col("content").isNotNull())
    return real.groupBy(*keys).agg(F.min_by(F.struct("event_id", "content"), order).alias("e")).select(*keys, "e.event_id", "e.content")


def user_turns(events: DataFrame) -> DataFrame:
    """One row per trace: sessions, harnesses, models ('unknown' where none) and the ordered real user turns."""
    first = first_user_events(events, ["trace_id", "session_id", "turn_id", "turn_index"])
    turns = first.groupBy("trace_id").agg(F.array_sort(F.collect_list(F.struct("turn_index", "turn_id", "event_id", "content"))).alias("user_turns"))
    named = lambda c: F.when(F.size(F.collect_set(c)) == 0, F.array(F.lit("unknown"))).otherwise(F.array_sort(F.collect_set(c)))
    about = events.groupBy("trace_id").agg(F.array_sort(F.collect_set("session_id")).alias("sessions"), named("harness").alias("harnesses"), named("model").alias("models"))
    return about.join(turns, "trace_id")


def observable(events: DataFrame, keys: list[str], order: str = "sequence") -> DataFrame:
    """Events of the five observable types; of user messages only the turn's first real one and interruptions."""
    user = F.col("type") == "user_message"
    real = user & clean_user_text(F.col("content")).isNotNull()
    nth = F.row_number().over(Window.partitionBy(*keys, real).orderBy(order))
    kept = events.where(F.col("type").isin(*OBSERVABLE_TYPES)).withColumn("__n", nth)
    return kept.where(~user | (real & (F.col("__n") == 1)) | interruption(F.col("content")).isNotNull()).drop("__n")


def next_where(rows: DataFrame, key: list[str], order: list[str], value: Column, into: str) -> DataFrame:
    """As-of forward: the first non-null `value` strictly after the row."""
    ahead = Window.partitionBy(*key).orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    return rows.withColumn(into, F.first(value, ignorenulls=True).over(ahead))


def spans(rows: DataFrame, starts: DataFrame, key: list[str], position: str, into: list[str]) -> DataFrame:
    """Positional range join: rows whose position lies in [start, end] of a span of their key, ends included."""
    return rows.join(starts, key).where(F.col(position).between(F.col("start"), F.col("end"))).select(*rows.columns, *into)


def boundaries(starts: DataFrame, key: list[str], start: str, last: Column) -> DataFrame:
    """Adds `end`: one before the next start of the key, or the last position."""
    return starts.withColumn("end", F.coalesce(F.lead(start).over(Window.partitionBy(*key).orderBy(start)) - 1, last))


def coverage(positions: DataFrame, ranges: DataFrame, key: list[str], position: str = "pos") -> DataFrame:
    """Times that each position is covered by the ranges [start, end] of its key: 0 is a gap, more than 1 an overlap.

    By events at range ends and a running sum, so it costs the positions and ranges, not their pairs.
    """
    ups = ranges.select(*key, F.col("start").alias("at"), F.lit(1).alias("step"), F.lit(0).alias("kind"))
    downs = ranges.select(*key, (F.col("end") + 1).alias("at"), F.lit(-1).alias("step"), F.lit(0).alias("kind"))
    points = positions.select(*key, F.col(position).alias("at"), F.lit(0).alias("step"), F.lit(1).alias("kind"))
    order = Window.partitionBy(*key).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = ups.unionByName(downs).unionByName(points).withColumn("times", F.sum("step").over(order))
    return swept.where("kind = 1").select(*key, F.col("at").alias(position), "times")


def sessionize(events: DataFrame, user: str, time: str, gap_seconds: int) -> DataFrame:
    """An extension: sessions by gaps, numbered from 1 for each user."""
    order = Window.partitionBy(user).orderBy(time, "event_id")
    at = F.unix_micros(F.col(time).cast("timestamp"))
    gap = (at - F.lag(at).over(order)) / 1e6
    return events.withColumn("session_no", F.sum(F.when(gap.isNull() | (gap > gap_seconds), 1).otherwise(0)).over(order))
