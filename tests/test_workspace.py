"""Products of a batch: what they hold, and that they are committed together or not at all."""

import os

import pytest
from pyspark.sql import functions as F

from sessiongrain.operators import workspace as ws


def batch(spark, most=3):
    rows = [("t", "s", "u1", f"e{i}", i, "error" if i == 2 else "x", "{}", "f", i // 2) for i in range(7)] + [("t", "s", "u0", "e7", 7, "x", "{}", "f", 9), ("t", "s", None, "e8", 8, "x", "{}", "g", 0), ("v", "w", None, "e9", 9, "x", "{}", "g", 1)]
    events = ws.source_ref(spark.createDataFrame(rows, "trace_id string, session_id string, turn_id string, event_id string, sequence long, type string, data string, input_file string, record_index long"))
    turns = ws.turn_product(events, "d", "b", {"n_errors": F.count_if(F.col("type") == "error")}, most)
    sources = spark.createDataFrame([("f", i, "{}") for i in range(10)], "file string, record_index long, record string")
    return events, {"source_records": ws.source_product(sources, "d", "b"), "lineage_edges": ws.lineage_product(events, "d", "b"), "unified_turns": turns, "unified_traces": ws.trace_product(events, turns, "d", "b")}


def test_products(spark):
    _, made = batch(spark)
    turns = sorted(made["unified_turns"].collect(), key=lambda r: (r.turn_index, r.part))
    assert [(r.turn_id, r.turn_index, r.part, r.n_events, [e.event_id for e in r.events]) for r in turns] == [("u1", 0, 0, 7, ["e0", "e1", "e2"]), ("u1", 0, 1, 7, ["e3", "e4", "e5"]), ("u1", 0, 2, 7, ["e6"]), ("u0", 1, 0, 1, ["e7"])]
    assert turns[0].execution_context.n_errors == 1 and len(turns[0].lineage.source_record_ids) == 2 and turns[0].events[0].source_ref.source_record_id == turns[0].events[1].source_ref.source_record_id
    traces = {r.trace_id: r.sessions for r in made["unified_traces"].collect()}
    assert [(x.turn_id, x.n_events) for x in traces["t"][0].turn_refs] == [("u1", 7), ("u0", 1)] and [e.event_id for e in traces["t"][0].unassigned_events] == ["e8"]
    assert traces["v"][0].turn_refs == [] and len(traces["v"][0].unassigned_events) == 1


def test_commit_abort_and_immutability(spark, tmp_path):
    events, made = batch(spark)
    path = f"{tmp_path}/batch"
    check = lambda at: ws.coverage_errors(spark, at, 10)
    fails = made["unified_traces"].withColumn("trace_id", F.when(F.col("trace_id") == "v", F.raise_error(F.lit("lost"))).otherwise(F.col("trace_id")))
    with pytest.raises(Exception, match="lost"):
        ws.materialise(spark, {**made, "unified_traces": fails}, path, {}, "f1", check)
    assert os.listdir(tmp_path) == []
    with pytest.raises(ValueError, match="9 of 10 events"):
        ws.materialise(spark, {**made, "lineage_edges": ws.lineage_product(events.where("event_id <> 'e3'"), "d", "b")}, path, {}, "f1", check)
    assert os.listdir(tmp_path) == []
    first = ws.materialise(spark, made, path, {"batch_id": "b"}, "f1", check)
    assert first["products"]["unified_turns"]["record_count"] == 4 and ws.read_manifest(spark, path) == first and os.listdir(tmp_path) == ["batch"]
    before = sorted(os.listdir(f"{path}/unified_turns"))
    assert ws.materialise(spark, {**made, "unified_traces": fails}, path, {}, "f1", check)["deduplicated"]
    with pytest.raises(ValueError, match="other sources"):
        ws.materialise(spark, made, path, {}, "f2", check)
    assert sorted(os.listdir(f"{path}/unified_turns")) == before
