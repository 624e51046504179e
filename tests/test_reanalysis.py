"""Closures over lineage against a loop; repair jobs prepared, executed and resumed; indexes brought up to date by parts."""

import collections
import random

import pytest
from pyspark.errors import PySparkException

from sessiongrain.plans import reanalysis


def test_a_change_touches_exactly_its_descendants(spark):
    rnd = random.Random(5)
    nodes = [f"n{i}" for i in range(80)]
    edges = [(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(70)] + [("n0", "n0"), ("n1", "n2"), ("n2", "n1"), ("n1", "n2"), (None, "n3"), ("n1", None)]
    old = {n: rnd.choice(["a", "b", None]) for n in nodes[:20]}
    new = {n: d if rnd.random() < 0.8 else "c" for n, d in old.items() if n not in ("n4", "n5")} | {"n20": "x"}
    seeds = {n: "added" if n not in old else "removed" if n not in new else "changed" for n in old | new if (n in old) != (n in new) or old[n] != new[n]}
    expected, last, depth = {n: (0, c) for n, c in seeds.items()}, set(seeds), 0
    while last:
        depth += 1
        last = {c for p, c in edges if p in last and c and c not in expected}
        expected |= {c: (depth, "descendant") for c in last}
    side = lambda d: spark.createDataFrame([*d.items(), (None, "z")], "id string, digest string")
    got = reanalysis.stale(spark.createDataFrame(edges, "parent_id string, child_id string"), side(old), side(new)).collect()
    assert len(got) == len(expected) and {r["id"]: (r["depth"], r["cause"]) for r in got} == expected
    assert reanalysis.stale(spark.createDataFrame(edges, "parent_id string, child_id string"), side(old), side(old)).count() == 0


QUEUE = "queue_id string, batch_id string, run_id string, trace_id string, mode string"


def tables(spark, mode=reanalysis.MODE):
    queue = [("q1", "b", "r", "t1", mode), ("q2", "b", "r", "t1", mode), ("q3", "b", "r", "t2", mode), ("q4", "b", "r", "t3", mode), ("q5", "c", "r", "t1", mode)]
    said = [("q1", "approved", 1), ("q2", "approved", 1), ("q3", "rejected", 1), ("q3", "approved", 2), ("q4", "approved", 1), ("q4", "rejected", 2), ("q5", "approved", 1)]
    screens = [(b, "r", t, f"{b}{t}") for b in "bc" for t in ("t1", "t2", "t3", "t4")] + [("b", "other", "t1", "no")]
    return spark.createDataFrame(queue, QUEUE), spark.createDataFrame(said, "queue_id string, decision string, created_at int"), spark.createDataFrame(screens, "batch_id string, run_id string, trace_id string, text string")


def test_reanalysis_is_prepared_and_resumed(spark):
    queue, said, screens = tables(spark)
    prepared = reanalysis.prepare_reanalysis(queue, said, screens, "cycle")
    jobs = {r["batch_id"]: r for r in prepared.jobs.collect()}
    assert {b: (r["baseline_run_id"], r["n_traces"], r["n_items"], r["status"]) for b, r in jobs.items()} == {"b": ("r", 2, 3, "prepared"), "c": ("r", 1, 1, "prepared")}
    held = {(r["run_id"], r["trace_id"], r["text"], r["supersedes_run_id"], r["cycle_id"]) for r in prepared.screens.collect()}
    assert held == {(jobs["b"]["run_id"], "t1", "bt1", "r", "cycle"), (jobs["b"]["run_id"], "t2", "bt2", "r", "cycle"), (jobs["c"]["run_id"], "t1", "ct1", "r", "cycle")}
    again = reanalysis.prepare_reanalysis(queue, said, screens, "cycle").jobs.collect()
    assert {r["run_id"] for r in again} == {r["run_id"] for r in jobs.values()}
    asked = spark.sparkContext.accumulator(0)

    def judge(bad):
        def call(system, user):
            asked.add(1)
            if user == bad:
                raise RuntimeError("no")
            return {"said": user}, {}

        return call

    first = reanalysis.execute_reanalysis(prepared, judge("bt2"), "s", "text")
    assert {r["batch_id"]: (r["status"], r["n_completed"], r["n_failed"]) for r in first.jobs.collect()} == {"b": ("partial", 1, 1), "c": ("completed", 1, 0)}
    assert [(r["trace_id"], r["error"]) for r in first.failures.collect()] == [("t2", "RuntimeError: no")] and asked.value == 3
    second = reanalysis.execute_reanalysis(prepared, judge(""), "s", "text", first.results)
    assert {r["status"] for r in second.jobs.collect()} == {"completed"} and second.failures.count() == 0 and asked.value == 4
    assert {r["answer"] for r in second.results.collect()} == {'{"said": "bt1"}', '{"said": "bt2"}', '{"said": "ct1"}'}


def test_what_is_not_allowed_raises(spark):
    queue, said, screens = tables(spark)
    with pytest.raises(ValueError, match="no approved"):
        reanalysis.prepare_reanalysis(queue, said.where("decision = 'rejected'"), screens, "cycle")
    with pytest.raises(PySparkException, match="without a screen: t2"):
        reanalysis.prepare_reanalysis(queue, said, screens.where("trace_id <> 't2'"), "cycle")
    with pytest.raises(PySparkException, match="duplicate key"):
        reanalysis.prepare_reanalysis(queue, said, screens.unionByName(screens.where("trace_id = 't2'")), "cycle")
    with pytest.raises(PySparkException, match="unsupported mode full"):
        reanalysis.prepare_reanalysis(*tables(spark, "full"), "cycle")


def test_indexes_by_parts(spark):
    schema = "batch_id string, run_id string, judgment string, models array<string>, harnesses array<string>, gaps array<string>"
    index = spark.createDataFrame(
        [("b", "r1", "confirmed", ["m"], ["h"], ["g", "g"]), ("b", "r2", "", ["m", "n", None], None, None), ("b", "r2", None, [], ["h"], ["g"]), ("c", "r1", "review", ["n"], ["h"], []), ("d", "r1", "review", ["n"], ["h"], [])], schema
    )
    catalog = lambda *rows: spark.createDataFrame(rows, "batch_id string, active_run string")
    counts = lambda df, n: collections.Counter({(r["kind"], r["value"]): r[n] for r in df.collect()})
    before = reanalysis.index_parts(index, catalog(("b", "r1"), ("c", "r1")))
    assert counts(reanalysis.global_indexes(before), "case_count") == {("gap", "g"): 2, ("harness", "h"): 2, ("model", "m"): 1, ("model", "n"): 1}
    now = catalog(("b", "r2"), ("d", "r1"))
    parts = reanalysis.rebuilt_parts(before, index, now)
    assert sorted(map(repr, parts.collect())) == sorted(map(repr, reanalysis.index_parts(index, now).collect()))
    assert counts(reanalysis.global_summary(parts), "n") == {
        ("batch", None): 2, ("case", None): 3, ("judgment", "unknown"): 2, ("judgment", "review"): 1, ("model", "m"): 1, ("model", "n"): 2, ("model", "unknown"): 1,
        ("harness", "unknown"): 1, ("harness", "h"): 2, ("gap", "g"): 1,
    }
    # Parts that are there are not counted again: what they say of an unchanged batch stays.
    told = parts.withColumn("n", parts["n"] * 10)
    assert counts(reanalysis.global_indexes(reanalysis.rebuilt_parts(told, index, now)), "case_count")["gap", "g"] == 10
