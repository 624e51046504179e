"""Evidence: chunks, previews, exact quotes, keyword recall, snippets, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessiongrain.functions.scalars import chunk_id, preview

EXTERNAL_CHARS = 2_000
CHUNK_CHARS = 12_000
BUDGET = 24

# What makes a tool result strong evidence.
STRONG = (
    r"(?i)traceback|(?:[A-Za-z_][A-Za-z0-9_.]*(?:Error|Exception))|\b(?:failed|failure|timeout|timed out|denied|not found)\b|"
    r"\b(?:exit_status|exit_code)\s*[=:]\s*[1-9][0-9]*|错误|异常|失败|超时|拒绝|未找到"
)
# Words that a chunk's search aid lists.
RETRIEVAL_TERMS = (
    "error", "exception", "failed", "failure", "missing", "empty", "not found",
    "timeout", "warning", "invalid", "denied", "abort", "rollback", "result",
    "artifact", "archive", "persist", "download", "upload", "write", "save",
    "file", "path", "zip", "test", "metric", "错误", "异常", "失败", "缺失",
    "为空", "未找到", "超时", "警告", "无效", "拒绝", "中止", "回滚",
    "结果", "产物", "归档", "持久化", "下载", "上传", "写入", "保存",
    "文件", "路径", "测试", "指标",
)
# Facts that the search aid copies.
FACTS = (r"\b[A-Z][A-Z0-9_]{2,}\s*=\s*[^\s\\]+", r"(?i)\b(?:exit_status|exit_code|status)\s*[:=]\s*[^\s,;]+")


def chunks(rows: DataFrame, id_col: str, text_col: str, size: int = CHUNK_CHARS) -> DataFrame:
    """(id, chunk, chunk_id, start, text): pieces of `size` characters; an empty text has none."""
    starts = F.when(F.length(text_col) > 0, F.sequence(F.lit(0), F.length(text_col) - 1, F.lit(size)))
    split = rows.select(id_col, text_col, F.explode(starts).alias("start"))
    return split.select(id_col, (F.col("start") / size).cast("int").alias("chunk"), chunk_id(F.col(id_col).cast("string"), F.col("start"), size).alias("chunk_id"), "start", F.substring(F.col(text_col), F.col("start") + 1, F.lit(size)).alias("text"))


def externalise(events: DataFrame, body: str = "body", limit: int = EXTERNAL_CHARS) -> DataFrame:
    """Tool events and bodies over the limit keep a hash, a length and a preview instead of the text."""
    out = (F.length(body) > limit) | F.col("type").isin("tool_call", "tool_result")
    return events.withColumns({"external": out, "body_hash": F.when(out, F.sha2(body, 256)), "body_chars": F.length(body), "preview": F.when(out, preview(F.col(body))), "body": F.when(~out, F.col(body))})


def search_aid(text: Column) -> Column:
    """keywords (first 20 of the list) and facts (first 12, 320 characters each) of a text."""
    low = F.lower(text)
    words = F.slice(F.filter(F.array(*map(F.lit, RETRIEVAL_TERMS)), lambda t: F.contains(low, t)), 1, 20)
    facts = F.slice(F.array_distinct(F.transform(F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(0)) for p in FACTS]), lambda x: F.left(x, F.lit(320)))), 1, 12)
    return F.struct(words.alias("keywords"), facts.alias("facts"), F.size(F.split(text, "\n")).alias("lines"))


def strong_evidence(chunk_rows: DataFrame, id_col: str, per_event: int = 3) -> DataFrame:
    """The first chunks of each event that show an error."""
    hit = chunk_rows.where(F.col("text").rlike(STRONG))
    return hit.withColumn("rank", F.row_number().over(Window.partitionBy(id_col).orderBy("chunk"))).where(F.col("rank") <= per_event).drop("rank")


def partition_budget(parts: Column, budget: int = BUDGET) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.lit(budget) / parts))


def quote_checks(quotes: DataFrame, events: DataFrame, event: str = "event_id", quote: str = "quote", body: str = "body") -> DataFrame:
    """quotes with `outcome`: valid, unknown_event or quote_not_exact (not a contiguous part of the event's text)."""
    joined = quotes.join(events.select(event, F.col(body).alias("__body")), event, "left")
    exact = F.contains(F.col("__body"), F.col(quote)) & (F.length(quote) > 0)
    return joined.withColumn("outcome", F.when(F.col("__body").isNull(), "unknown_event").when(exact, "valid").otherwise("quote_not_exact")).drop("__body")


def closest_passage(quote: Column, source: Column, room: int = 80) -> Column:
    """(quote_start, size, source_start, passage): the longest part of a quote that its source holds, and what stands around it there.

    Starts count from 1 and are 0 where nothing is shared; of equally long parts the first of the quote, where it stands first
    in the source. A part grows while the source holds it and else moves on by a character, so a quote of n
    characters costs 2n searches of the source, whatever they share. A null quote or source gives null.
    """
    length = F.length(quote)

    def step(state: Column, _: Column) -> Column:
        longer = F.substr(quote, state["at"], state["size"] + 1)
        grows = (state["at"] + state["size"] <= length) & F.contains(source, longer)
        return F.struct(
            F.when(grows, state["at"]).otherwise(state["at"] + 1).alias("at"),
            F.when(grows, state["size"] + 1).otherwise(state["size"]).alias("size"),
            F.when(grows, state["at"]).otherwise(state["best"]).alias("best"),
        )

    steps = F.filter(F.sequence(F.lit(0), 2 * length), lambda i: i > 0)
    start = F.struct(F.lit(1).alias("at"), F.lit(0).alias("size"), F.lit(0).alias("best"))

    def shown(found: Column) -> Column:
        place = F.when(found["size"] > 0, F.position(F.substr(quote, found["best"], found["size"]), source)).otherwise(0)
        first = F.greatest(place - room, F.lit(1))
        passage = F.when(found["size"] > 0, F.substr(source, first, place - first + found["size"] + room)).otherwise("")
        return F.struct(found["best"].alias("quote_start"), found["size"].alias("size"), place.alias("source_start"), passage.alias("passage"))

    return F.when(quote.isNotNull() & source.isNotNull(), F.aggregate(steps, start, step, shown))


def citation_feedback(quotes: DataFrame, events: DataFrame, event: str = "event_id", quote: str = "quote", body: str = "body") -> DataFrame:
    """quotes that are not exact, with `outcome` and `feedback`: what a model is told about them, the closest passage with it."""
    joined = quotes.join(events.select(event, F.col(body).alias("__body")), event, "left")
    exact = F.contains(F.col("__body"), F.col(quote)) & (F.length(quote) > 0)
    wrong = joined.where(~F.coalesce(exact, F.lit(False)))
    near = closest_passage(F.col(quote), F.col("__body"))
    told = wrong.withColumn("outcome", F.when(F.col("__body").isNull(), "unknown_event").otherwise("quote_not_exact")).withColumn("__near", near)
    said = F.when(F.col("__near.size") > 0, F.concat(F.lit("; closest passage: "), F.col("__near.passage"))).when(F.col("__body").isNotNull(), "; nothing of it is in the source").otherwise("")
    return told.withColumn("feedback", F.concat("outcome", said)).drop("__body", "__near")


def keyword_hits(rows: DataFrame, patterns: list[tuple[str, str]], id_col: str, text_col: str, window: int = 40) -> DataFrame:
    """(label, id, start, snippet) for each label whose pattern a text has: its first match with context on both sides.

    Labels are a short fixed list, so every text is scanned once with all of them in place of a theta join.
    """
    found = F.array_compact(F.array(*[F.when(F.regexp_instr(text_col, F.lit(p)) > 0, F.struct(F.lit(n).alias("label"), F.regexp_instr(text_col, F.lit(p)).alias("start"), F.length(F.regexp_substr(text_col, F.lit(p))).alias("n"))) for n, p in patterns]))
    flat = rows.select(id_col, text_col, F.explode(found).alias("h"))
    first = F.greatest(F.lit(1), F.col("h.start") - window)
    return flat.select("h.label", id_col, F.col("h.start").alias("start"), F.substring(F.col(text_col), first, F.col("h.start") - first + F.col("h.n") + window).alias("snippet"))


def excerpts(text: Column, terms: tuple[str, ...] = RETRIEVAL_TERMS, most: int = 6, width: int = 220) -> Column:
    """Up to `most` excerpts of `width` characters around occurrences of terms, none overlapping: terms in their order, then places.

    What stands between the occurrences of a term gives their places, so one fold over these pieces sees
    each window once and keeps those that meet none before; letters match in either case. Null gives none.
    """
    taken_type = "array<struct<from:int,to:int>>"

    def around(found: Column, term: Column) -> Column:
        pieces = F.split(text, F.concat(F.lit("(?iu)\\Q"), term, F.lit("\\E")))

        def step(state: Column, piece: Column) -> Column:
            here = state["at"] + F.length(piece)
            start = F.greatest(here - width // 2, F.lit(0))
            window = F.struct(start.alias("from"), F.least(start + width, F.length(text)).alias("to"))
            free = (F.size(state["taken"]) < most) & ~F.exists(state["taken"], lambda t: (t["from"] < window["to"]) & (window["from"] < t["to"]))
            return F.struct((here + F.length(term)).alias("at"), F.when(free, F.concat(state["taken"], F.array(window))).otherwise(state["taken"]).alias("taken"))

        inner = F.slice(pieces, 1, F.size(pieces) - 1)
        return F.aggregate(inner, F.struct(F.lit(0).alias("at"), found.alias("taken")), step)["taken"]

    windows = F.aggregate(F.array(*map(F.lit, terms)), F.array().cast(taken_type), around)
    shown = lambda w: F.trim(F.regexp_replace(F.substr(text, w["from"] + 1, w["to"] - w["from"]), r"(?U)\s+", " "))
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(F.transform(windows, shown))


def chunk_recall(expected: DataFrame, selected: DataFrame, key: str, item: str) -> DataFrame:
    """Per key: expected items, matched ones and recall (null where nothing is expected)."""
    marked = expected.select(key, item).distinct().join(selected.select(key, item).distinct().withColumn("__hit", F.lit(1)), [key, item], "left")
    out = marked.groupBy(key).agg(F.count("*").alias("n_expected"), F.count("__hit").alias("n_matched"))
    return out.withColumn("recall", F.bround(F.col("n_matched") / F.nullif(F.col("n_expected"), F.lit(0)), 4))


def complete_pairs(selected: DataFrame, events: DataFrame, event: str = "event_id", call: str = "call_id", turn: str = "turn_id") -> DataFrame:
    """Selected events and the other side of every call that they belong to."""
    calls = events.join(selected.select(event), event, "left_semi").where(F.col(call).isNotNull()).select(turn, call).distinct()
    return events.join(calls, [turn, call], "left_semi").select(event).unionByName(selected.select(event)).distinct()
