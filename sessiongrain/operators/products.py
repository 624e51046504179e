"""Slim products of turns and events: references, projections, execution contexts, models, usage, source locations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessiongrain.operators import rollups


def event_references(events: DataFrame, sources: DataFrame, keep: list[str], id_col: str = "event_id") -> DataFrame:
    """Events without their bodies: identity columns and the locator of the source record, null where there is none.

    sources: (id, input_file, record_index), the least locator of an id counts.
    """
    located = sources.groupBy(id_col).agg(F.min(F.struct("input_file", "record_index")).alias("source_ref"))
    return events.select(id_col, *keep).join(located, id_col, "left")


def event_projection(event_type: Column, data: Column) -> Column:
    """What of an event stays with its source record: its type, the size of its data and their digest."""
    return F.struct(event_type.alias("type"), F.length(data).alias("n_chars"), F.sha2(data, 256).alias("sha256"))


def execution_contexts(events: DataFrame, turn: list[str], tool: str, model: str, is_call: Column, is_error: Column) -> DataFrame:
    """One row a turn: n_calls, tools and models (distinct, sorted), n_errors, complete (each call of the turn names its tool)."""
    names = lambda c: F.array_sort(F.collect_set(F.when(is_call, F.col(c))))  # noqa: E731  bounded by the tools and models there are
    return events.groupBy(*turn).agg(
        F.count_if(is_call).alias("n_calls"), names(tool).alias("tools"), names(model).alias("models"), F.count_if(is_error).alias("n_errors"),
        F.coalesce(F.every(F.when(is_call, F.col(tool).isNotNull())), F.lit(False)).alias("complete"),
    )


def turn_models(calls: DataFrame, session: str, turn: str, model: str) -> DataFrame:
    """One row a turn: its models, sorted, and if it has none the session's model where that is exactly one."""
    own = calls.groupBy(session, turn).agg(F.array_sort(F.collect_set(model)).alias("own"))
    whole = calls.groupBy(session).agg(F.min(model).alias("lo"), F.max(model).alias("hi"))
    inferred = F.when(F.size("own") > 0, F.col("own")).when(F.col("lo") == F.col("hi"), F.array("lo")).otherwise(F.array().cast("array<string>"))
    return own.join(whole, session).select(session, turn, inferred.alias("models"), ((F.size("own") == 0) & (F.size(inferred) > 0)).alias("inferred"))


def usage_total(usage: Column, fields: tuple[str, ...] = ("input_tokens", "output_tokens", "cache_read_input_tokens")) -> Column:
    """Sum of optional counts of a JSON object; missing and non-numeric ones count 0, null only where there is no object."""
    parsed = F.try_parse_json(usage)
    total = F.lit(0).cast("long")
    for f in fields:
        total = total + F.coalesce(F.try_variant_get(parsed, f"$.{f}", "long"), F.lit(0))
    return F.when(parsed.isNotNull(), total)


# The counts that a model's answer reports.
USAGE = ("prompt_tokens", "completion_tokens", "total_tokens")


def usage_sums(rows: DataFrame, usage: str, keys: list[str], fields: tuple[str, ...] = USAGE) -> DataFrame:
    """Per key the sum of each reported count; what is missing or no whole number adds nothing, and stays null where no row reports it."""
    parsed = rows.withColumn("__u", F.try_parse_json(usage))
    return parsed.groupBy(*keys).agg(*[F.sum(F.try_variant_get("__u", f"$.{f}", "long")).alias(f) for f in fields])


def event_text(data: Column) -> Column:
    """Readable text of an event's JSON: the tool's name and arguments, else the content, else the message, else nothing."""
    parsed = F.try_parse_json(data)
    at = lambda p: F.try_variant_get(parsed, p, "string")
    call = F.when(at("$.tool_name").isNotNull(), F.concat_ws(" ", at("$.tool_name"), at("$.arguments")))
    return F.coalesce(call, at("$.content"), at("$.message"), F.lit(""))


#: Fixed value: positions that a window holds where lines of a file are numbered (2 ** 16).
_LINE_BITS = 16


def numbered_lines(rows: DataFrame, file: str, position: str, blank: Column) -> DataFrame:
    """rows that are not blank, with line (from 1, blank rows counted) and record (from 0, blank rows skipped) in their file, by position.

    Windows hold one bucket of a file's positions, and the counts of its buckets are summed before them: a file of any size is spread over tasks.
    """
    bucket = F.coalesce(F.shiftright(position, _LINE_BITS).cast("long"), F.lit((1 << 63) - 1))
    placed = rows.withColumn("__b", bucket).withColumn("__blank", F.coalesce(blank, F.lit(False)))
    sizes = placed.groupBy(F.col(file).alias("__file"), F.col("__b").alias("__bucket")).agg(F.count("*").alias("__n"), F.count_if(~F.col("__blank")).alias("__m"))
    before = Window.partitionBy("__file").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__file", "__bucket", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("__n", "__m")])
    own = Window.partitionBy(file, "__b").orderBy(F.col(position).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    inside = placed.withColumn("__line", F.count("*").over(own)).withColumn("__record", F.count_if(~F.col("__blank")).over(own)).where("NOT __blank")
    both = inside.join(offsets, F.col(file).eqNullSafe(F.col("__file")) & (F.col("__b") == F.col("__bucket")))
    return both.select(*rows.columns, (F.col("__n") + F.col("__line")).alias("line"), (F.col("__m") + F.col("__record") - 1).alias("record"))


def source_locations(rows: DataFrame, file: str, turn: str, line: str, record: str) -> DataFrame:
    """(file, turn) -> the line and record where the turn stands; a turn that stands in a file twice raises."""
    found = rows.groupBy(file, turn).agg(F.min(F.struct(line, record)).alias("__at"), F.count("*").alias("__n"))
    twice = F.raise_error(F.concat_ws(" ", F.lit("duplicate source turn"), F.col(file).cast("string"), F.col(turn).cast("string")))
    checked = F.when(F.col("__n") == 1, F.col("__at")).otherwise(twice.cast(rows.select(F.struct(line, record).alias("x")).schema["x"].dataType))
    return found.select(file, turn, checked.alias("__at")).select(file, turn, f"__at.{line}", f"__at.{record}")


def interruptions_within(cases: DataFrame, interruptions: DataFrame, key: str, position: str, start: str = "start", end: str = "end") -> DataFrame:
    """Interruptions of a case's trace whose position lies within the case's bounds, both included."""
    both = cases.join(interruptions, key)
    return both.where(F.col(position).between(F.col(start), F.col(end)))


def first_records(rows: DataFrame, order: list[str], limit: int) -> DataFrame:
    """The first `limit` records over all sources in order; a negative limit takes all."""
    return rows if limit < 0 else rows.orderBy(*order).limit(limit)


def line_index(lines: DataFrame, file: str = "file", line: str = "line_number", text: str = "line") -> DataFrame:
    """lines with the byte offset and length of each: an index for reads by seek, and a check that a file is unchanged.

    Lines end in one byte. Files are independent, so the running sums are per file.
    """
    before = Window.partitionBy(file).orderBy(line).rowsBetween(Window.unboundedPreceding, -1)
    size = F.octet_length(text)
    return lines.withColumn("offset", F.coalesce(F.sum(size + 1).over(before), F.lit(0))).withColumn("length", size)


def episode_rows(index: DataFrame, episodes: DataFrame, trace: str, position: str, ahead: int = 1) -> DataFrame:
    """Rows of each episode, [start, end], and of `ahead` positions behind it (is_ahead), by an equi-join on the trace and a range."""
    both = episodes.join(index, trace).where((F.col(position) >= F.col("start")) & (F.col(position) <= F.col("end") + ahead))
    return both.withColumn("is_ahead", F.col(position) > F.col("end"))
