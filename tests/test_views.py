import json

import pytest
from pyspark.sql import functions as F

from sessiongrain.operators import checks, views
from sessiongrain.sources import registry


def test_partition_issues(spark):
    turns = spark.createDataFrame([("t", f"u{i}", i, c) for i, c in enumerate(["build it", "more", "继续", "other", "last"])] + [("v", "x", 0, "only")], "trace_id string, turn_id string, pos int, content string")
    episodes = spark.createDataFrame([("t", 0, "u0", "u1", "u0"), ("t", 1, "u2", "u3", "u4"), ("t", 2, "u3", "zz", "qq")], "trace_id string, ord int, start_turn_id string, end_turn_id string, query_turn_id string")
    got = {(r["trace_id"], r["issue"]): r["detail"] for r in checks.partition_issues(turns, episodes).collect()}
    assert got == {("t", "unknown_end"): "2", ("t", "unknown_query"): "2", ("t", "query_outside_boundary"): "1", ("t", "uncovered_turns"): "u4", ("t", "context_dependent_start"): "1", ("v", "no_episodes"): "", ("v", "uncovered_turns"): "x"}
    assert checks.whole_trace_fallback(turns).where("trace_id = 't'").first()["end_turn_id"] == "u4"


def test_links_and_unique(spark):
    req = spark.createDataFrame([("c", "r1"), ("c", "r1")], "case_id string, requirement_id string")
    claims = spark.createDataFrame([("c", "k1", ["e1", "e9"])], "case_id string, claim_id string, evidence_ids array<string>")
    ev = spark.createDataFrame([("c", "e1")], "case_id string, evidence_id string")
    maps = spark.createDataFrame([("c", "r1", ["k1", "k2"]), ("c", "r7", [])], "case_id string, requirement_id string, claim_ids array<string>")
    got = sorted((r["issue"], r["detail"]) for r in checks.links(req, claims, ev, maps).collect())
    assert got == [("repeated_requirement_id", "r1"), ("unknown_claim", "k2"), ("unknown_evidence", "e9"), ("unknown_requirement", "r7")]
    with pytest.raises(Exception, match="duplicate key"):
        checks.unique(req, ["case_id", "requirement_id"]).collect()


def test_citations(spark):
    events = spark.createDataFrame([("e1", "the text", True, "user", "t1", "l", "member"), ("e2", "x", False, "user", "t1", "l", "member")], "event_id string, body string, body_provided boolean, role string, turn_id string, locator string, membership string")
    refs = spark.createDataFrame([("e1", "user", "t1", "l", "member", "text"), ("e1", "agent", "t1", "l", "member", "text"), ("e1", "user", "t1", "l", "member", "tex t"), ("e2", "user", "t1", "l", "member", "x"), ("e3", "user", "t1", "l", "member", "x")], "event_id string, role string, turn_id string, locator string, membership string, quote string")
    assert sorted(r["outcome"] for r in checks.citations(refs, events).collect()) == ["body_not_provided", "quote_not_exact", "role_differs", "unknown_event", "valid"]


def test_json_views(spark):
    doc = json.dumps({"model": "m", "a": [{"event_id": "e", "quote": "q"}], "text": "say \"x\""})
    row = spark.createDataFrame([(doc,), (None,), ("plain",)], "d string").select(views.without_keys(F.col("d")).alias("w"), views.evidence_references(F.col("d")).alias("r"), views.quoted(F.col("d"), F.lit('say "x"')).alias("q")).collect()
    assert "model" not in json.loads(row[0]["w"]) and [tuple(x) for x in row[0]["r"]] == [("a[0]", "e", "q")] and row[0]["q"]
    assert row[1]["w"] is None and row[1]["r"] == [] and row[2]["w"] == "plain"


def test_evidence_chain_and_transcript(spark):
    one = [("e1", "t1", "q"), ("e1", "t1", "q"), ("e2", "t1", "z")]
    ep = spark.createDataFrame([("x", one, None)], "k string, s array<struct<event_id:string,turn_id:string,quote:string>>, g array<struct<event_id:string,turn_id:string,quote:string>>")
    assert [(r["role"], r["event_id"]) for r in views.evidence_values(ep, ["k"], {"user_signal": "s", "gap": "g"}).orderBy("pos").collect()] == [("user_signal", "e1"), ("user_signal", "e2")]
    ev = spark.createDataFrame([("user_message", json.dumps({"content": "a" * 30})), ("tool_call", json.dumps({"tool_name": "run", "arguments": "ls"})), ("error", json.dumps({"error": "boom"})), ("token_usage", "{}")], "type string, data string")
    got = {r["role"]: (r["text"], r["truncated"], r["chars"]) for r in views.transcript(ev, 10, 5).collect()}
    assert got == {"user": ("a" * 10, True, 30), "tool_call": ("run l", True, 6), "error": ("boom", False, 4)}


def test_registry(spark):
    facts = spark.createDataFrame([("a", 1, "h1"), ("b", 2, "h2")], "path string, length long, sha256 string")
    known = spark.createDataFrame([("z", 1, "h1"), ("b", 2, "old"), ("c", 3, "h3")], "path string, length long, sha256 string")
    assert [r["path"] for r in registry.new_files(facts, known).collect()] == ["b"]
    assert {r["path"]: r["status"] for r in registry.artifact_manifest(known, facts).collect()} == {"z": "missing", "b": "changed", "c": "missing"}
    catalog = spark.createDataFrame([("b1", "r1", ["r1"])], "batch_id string, active_run string, available_runs array<string>")
    after = {r["batch_id"]: (r["active_run"], r["available_runs"]) for r in registry.activate(catalog, spark.createDataFrame([("b1", "r2"), ("b2", "r9")], "batch_id string, run_id string")).collect()}
    assert after == {"b1": ("r2", ["r1", "r2"]), "b2": ("r9", ["r9"])}
