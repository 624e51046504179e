"""Views: evidence chains, transcripts, public cases, bundles, label views, references inside JSON."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sessiongrain.functions.scalars import public_text
from sessiongrain.operators.rules import benchmark_note

# Metadata keys that an analysis view leaves out.
HIDDEN_KEYS = ("model", "models", "harness", "provider", "api_provider", "service_tier", "request_id", "sessionId", "session_id")
# Keys of tool events that an index shows.
SHOWN_KEYS = ("call_id", "tool", "tool_name", "name", "command", "path", "file_path", "status", "error", "is_error", "exit_code", "url", "artifact_path")
EVIDENCE_ROLES = ("user_signal", "requirement", "goal", "result", "gap")
TRANSCRIPT_ROLES = {"user_message": "user", "assistant_message": "agent", "tool_call": "tool_call", "tool_result": "tool_result", "error": "error"}


def without_keys(data: Column, keys: tuple[str, ...] = HIDDEN_KEYS) -> Column:
    """A JSON object's text without the keys; other JSON stays."""
    fields = F.map_filter(F.try_parse_json(data).cast("map<string,variant>"), lambda k, _: ~k.isin(*keys))
    is_object = F.schema_of_variant(F.try_parse_json(data)).startswith("OBJECT")
    return F.when(is_object, F.to_json(fields)).otherwise(data)


def structural_fields(data: Column, limit: int = 500) -> Column:
    fields = F.map_filter(F.try_parse_json(data).cast("map<string,variant>"), lambda k, _: k.isin(*SHOWN_KEYS))
    is_object = F.schema_of_variant(F.try_parse_json(data)).startswith("OBJECT")
    return F.when(is_object, F.transform_values(fields, lambda _, v: F.left(F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v)), F.lit(limit))))


def analysis_view(events: DataFrame) -> DataFrame:
    return events.select("event_id", "sequence", "timestamp", "type", without_keys(F.col("data")).alias("data"))


def evidence_values(episodes: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """(keys, role, event_id, turn_id, quote): the evidence arrays of an episode one after another, first mentions only.

    columns maps a role to its array<struct<event_id, turn_id, quote>> column.
    """
    none = F.array().cast("array<struct<role:string,event_id:string,turn_id:string,quote:string>>")

    def named(role: str, column: str) -> Column:
        return F.coalesce(F.transform(F.col(column), lambda e: F.struct(F.lit(role).alias("role"), e["event_id"].alias("event_id"), e["turn_id"].alias("turn_id"), e["quote"].alias("quote"))), none)

    parts = [named(role, column) for role, column in columns.items()]
    flat = episodes.select(*keys, F.posexplode(F.concat(*parts)).alias("pos", "e")).select(*keys, "pos", "e.*")
    first = Window.partitionBy(*keys, "role", "event_id", "quote").orderBy("pos")
    return flat.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")


def transcript(events: DataFrame, user_limit: int = 20_000, other_limit: int = 12_000) -> DataFrame:
    """Roles, texts cut to their limits, whether they were cut and their length; events without text go."""
    text = F.coalesce(
        F.when(F.col("type") == "tool_call", F.concat_ws(" ", F.get_json_object("data", "$.tool_name"), F.get_json_object("data", "$.arguments"))),
        F.get_json_object("data", "$.content"), F.get_json_object("data", "$.message"), F.get_json_object("data", "$.error"),
    )
    role = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in TRANSCRIPT_ROLES.items() for x in kv]), F.col("type")), F.lit("other"))
    limit = F.when(F.col("type").isin("user_message", "assistant_message"), user_limit).otherwise(other_limit)
    out = events.withColumn("role", role).withColumn("__t", text).where(F.trim(F.coalesce("__t", F.lit(""))) != "")
    return out.withColumns({"text": F.left(F.col("__t"), limit), "truncated": F.length("__t") > limit, "chars": F.length("__t")}).drop("__t")


def public_cases(cases: DataFrame) -> DataFrame:
    """Masked, shortened columns of a case; the verified goal, else the screened one; a stable display order."""
    goal = F.coalesce(F.nullif(F.trim("verified_goal"), F.lit("")), F.col("screened_goal"))
    rank = F.create_map(F.lit("confirmed"), F.lit(0), F.lit("review"), F.lit(1), F.lit("excluded"), F.lit(2))
    return cases.select(
        "case_id", "batch_id", "judgment", public_text(goal).alias("goal"), public_text(F.col("agent_failure"), 500).alias("agent_failure"),
        benchmark_note(F.col("judgment"), F.col("clarity"), F.col("value")).alias("benchmark_note"), F.coalesce(F.try_element_at(rank, F.col("judgment")), F.lit(3)).alias("display_rank"),
    )


def case_titles(judgment: Column, gaps: Column, failure: Column, goal: Column) -> Column:
    named = F.array_join(F.slice(gaps, 1, 2), "、")
    return F.when((judgment == "confirmed") & (F.size(gaps) > 0), named).when(F.trim(F.coalesce(failure, F.lit(""))) != "", public_text(failure, 80)).otherwise(public_text(goal, 80))


def evidence_bundle(events: DataFrame, spans: DataFrame, provided: DataFrame, key: str = "case_id") -> DataFrame:
    """Visible events of each case: membership (member or look-ahead), whether the body is provided, and the body only then."""
    joined = events.join(spans, "trace_id").where(F.col("pos").between(F.col("start"), F.coalesce("lookahead", "end")))
    marked = joined.join(provided.select(key, "event_id").withColumn("body_provided", F.lit(True)), [key, "event_id"], "left")
    given = F.coalesce("body_provided", F.lit(False))
    return marked.withColumns({"membership": F.when(F.col("pos") <= F.col("end"), "member").otherwise("lookahead"), "body_provided": given, "body": F.when(given, F.col("body"))})


def bundle_scope(bundle: DataFrame, key: str = "case_id") -> DataFrame:
    return bundle.groupBy(key).agg(F.count("*").alias("n_events"), F.count(F.when(F.col("body_provided"), 1)).alias("n_provided"), F.count(F.when(~F.col("body_provided"), 1)).alias("n_omitted"))


def label_view(fields: DataFrame, claims: DataFrame, evidence: DataFrame) -> DataFrame:
    """Each label field (case_id, target, path) with the claims on it or on a path below it, and their quotes in order."""
    under = (F.col("c_path") == F.col("path")) | F.startswith(F.col("c_path"), F.concat(F.col("path"), F.lit(".")))
    named = claims.select("case_id", "target", "claim_id", F.col("path").alias("c_path"), "status")
    joined = fields.join(named, ["case_id", "target"], "left").withColumn("__on", F.coalesce(under, F.lit(False)))
    quotes = evidence.groupBy("case_id", "claim_id").agg(F.array_sort(F.collect_set("quote")).alias("quotes"))
    full = joined.join(quotes, ["case_id", "claim_id"], "left")
    item = F.when(F.col("__on"), F.struct("claim_id", "status", F.coalesce("quotes", F.array().cast("array<string>")).alias("quotes")))
    return full.groupBy("case_id", "target", "path").agg(F.array_sort(F.collect_list(item)).alias("claims"))


def _leaves(value: object, out: list[str]) -> None:
    if isinstance(value, str):
        out.append(value)
    elif isinstance(value, (dict, list)):
        out.append(json.dumps(value, ensure_ascii=False, separators=(",", ":")))
        for v in value.values() if isinstance(value, dict) else value:
            _leaves(v, out)


@F.pandas_udf(T.ArrayType(T.StringType()))
def string_leaves(documents: pd.Series) -> pd.Series:
    """All strings of a JSON text, and every container as compact JSON; not JSON: the text itself."""

    def one(text: str | None) -> list[str]:
        if text is None:
            return []
        try:
            value = json.loads(text)
        except ValueError:
            return [text]
        out: list[str] = []
        _leaves(value, out)
        return out

    return documents.map(one)


def quoted(document: Column, quote: Column) -> Column:
    """A quote counts where it is a contiguous part of any string or serialised container."""
    return F.exists(string_leaves(document), lambda s: F.contains(s, quote)) & (F.length(quote) > 0)


def _references(value: object, path: str, out: list[tuple[str, str, str]]) -> None:
    if isinstance(value, dict):
        if isinstance(value.get("event_id"), str) and isinstance(value.get("quote"), str):
            out.append((path, value["event_id"], value["quote"]))
        for k, v in value.items():
            _references(v, f"{path}.{k}" if path else k, out)
    elif isinstance(value, list):
        for i, v in enumerate(value):
            _references(v, f"{path}[{i}]", out)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("path", "event_id", "quote")])))
def evidence_references(documents: pd.Series) -> pd.Series:
    """Every object with event_id and quote at any depth, with its path."""

    def one(text: str | None) -> list[dict]:
        out: list[tuple[str, str, str]] = []
        try:
            _references(json.loads(text or "null"), "", out)
        except ValueError:
            pass
        return [{"path": p, "event_id": e, "quote": q} for p, e, q in out]

    return documents.map(one)
