"""Boundary checks against a loop over random answers; the repair loop with models that mend, spoil and fail."""

import json
import random

from sessiongrain.plans import boundaries


def loop_issues(ids, contents, answer):
    episodes = answer.get("task_episodes")
    if not isinstance(episodes, list):
        return ["structural:task_episodes_not_array"]
    if not episodes:
        return ["structural:task_episodes_empty"]
    at = {t: i for i, t in enumerate(ids) if t}
    found, seen, last = [], [0] * len(ids), -1
    for i, e in enumerate(episodes):
        say = lambda what, kind="structural": found.append(f"{kind}:episode_{i}:{what}")  # noqa: B023, E731
        if not isinstance(e, dict):
            say("not_object")
            continue
        b = e.get("episode_boundary")
        if not isinstance(b, dict):
            say("boundary_not_object")
            continue
        s, t = at.get(b.get("start_turn_id")), at.get(b.get("end_turn_id"))
        if s is None:
            say("start_unknown")
        if t is None:
            say("end_unknown")
        if s is None or t is None:
            continue
        if s > t:
            say("range_reversed")
            continue
        if s <= last:
            say("not_strictly_ordered")
        last = s
        for p in range(s, t + 1):
            seen[p] += 1
        q = e.get("initial_query") or {}
        place = at.get(q.get("turn_id"))
        if place is None and q.get("judgment") == "identified":
            say("identified_query_unknown")
        elif place is not None and not s <= place <= t:
            say("query_outside_boundary")
        if i and contents[s].startswith("继续"):
            say("context_dependent_start", "semantic")
    for name, listed in (("uncovered_turns", [t for t, n in zip(ids, seen, strict=True) if n == 0]), ("overlap_turns", [t for t, n in zip(ids, seen, strict=True) if n > 1])):
        if listed:
            found.append(f"structural:{name}:{len(listed)}:" + ",".join(listed[:12]))
    return found


def test_issues_equal_a_loop(spark):
    rnd = random.Random(4)
    turns, answers, expected = [], [], {}
    for k in range(120):
        n = rnd.randint(1, 16)
        ids = [f"t{i}" if rnd.random() < 0.97 else "" for i in range(n)]
        contents = [rnd.choice(["继续", "a task of its own"]) for _ in range(n)]
        turns += [(f"c{k}", t, i, c) for i, (t, c) in enumerate(zip(ids, contents, strict=True))]
        turn = lambda: rnd.choice([*ids, "x", None]) if rnd.random() < 0.3 else rnd.choice(ids)  # noqa: B023, E731
        cuts = sorted({0, *rnd.sample(range(n), rnd.randint(0, min(3, n)))})
        good = [{"episode_boundary": {"start_turn_id": ids[a], "end_turn_id": ids[b - 1]}, "initial_query": {"judgment": "identified", "turn_id": ids[a]}} for a, b in zip(cuts, [*cuts[1:], n], strict=True)]
        bad = [rnd.choice([{"episode_boundary": {"start_turn_id": turn(), "end_turn_id": turn()}, "initial_query": {"judgment": rnd.choice(["identified", "uncertain"]), "turn_id": turn()}}, 7, {"episode_boundary": [1]}, None]) for _ in range(rnd.randint(0, 3))]
        answer = {"task_episodes": rnd.choice([good, good + bad, bad, "none", {"a": 1}])}
        answers.append((f"c{k}", json.dumps(answer), None))
        expected[f"c{k}"] = loop_issues(ids, contents, answer)
    got = boundaries.answer_issues(spark.createDataFrame(turns, "trace_id string, turn_id string, pos int, content string"), spark.createDataFrame(answers, "trace_id string, answer string, error string"))
    assert {r["trace_id"]: r["issues"] for r in got.collect()} == expected


def model(system, user):
    """Says what the trace's name asks for; the repair request is known by its system text."""
    asked = json.loads(user)
    ids = [t["turn_id"] for t in asked["turns"]]
    good = {"task_episodes": [{"episode_boundary": {"judgment": "reliable", "start_turn_id": t, "end_turn_id": t}} for t in ids]}
    short = {"task_episodes": good["task_episodes"][1:]}
    name, again = asked["trace_id"], system == "repair"
    if again:
        assert asked["validation_issues"] and ("previous_output" in asked or name == "raises")
    if name == "raises" and not again or name == "stops" and again:
        raise RuntimeError("gone")
    if name == "third" and again and len(asked["previous_output"]["task_episodes"]) == len(ids) - 1:
        return {"task_episodes": []}, {}
    return (good if name in ("good", "doubt") or again and name != "never" else short), {}


def test_repairs_and_fallback(spark):
    names = ["good", "mended", "never", "raises", "stops", "doubt", "third", "long"]
    rows = [(k, f"{k}{i}", i, ("继续" if k == "doubt" else "text") * (200 if k == "long" else 1) if i != 1 or k == "doubt" else None) for k in names for i in range(3)]
    df = spark.createDataFrame(rows, "trace_id string, turn_id string, pos int, content string")

    def run(most_repairs):
        out = {}
        for r in boundaries.screen_boundaries(df, model, "ask", "repair", most_chars=1000, most_repairs=most_repairs).orderBy("trace_id", "ord").collect():
            out.setdefault(r["trace_id"], []).append(r)
        return out

    got = run(1)
    assert set(got) == set(names)
    said = {k: (len(v), v[0]["strategy"], v[0]["n_calls"], v[0]["needs_review"]) for k, v in got.items()}
    assert said == {
        "good": (3, "screened", 1, False), "mended": (3, "repaired", 2, False), "never": (1, "fallback", 2, True), "raises": (3, "repaired", 2, False),
        "stops": (1, "fallback", 2, True), "doubt": (3, "repaired", 2, False), "third": (1, "fallback", 2, True), "long": (1, "fallback", 0, True),
    }
    assert got["mended"][0]["initial_issues"] == ["structural:uncovered_turns:1:mended0"] and got["mended"][0]["final_issues"] == []
    assert got["doubt"][0]["final_issues"] == ["semantic:episode_1:context_dependent_start", "semantic:episode_2:context_dependent_start"]
    assert got["stops"][0]["final_issues"] == ["structural:call_failed:RuntimeError: gone"] and got["long"][0]["final_issues"] == ["structural:request_too_long"]
    r = got["never"][0]
    assert (r["start_turn_id"], r["end_turn_id"], r["query_turn_id"], r["boundary"]) == ("never0", "never2", None, "uncertain")
    assert {k: v[0]["n_calls"] for k, v in run(2).items()} == {"good": 1, "mended": 2, "never": 3, "raises": 2, "stops": 3, "doubt": 3, "third": 3, "long": 0}
    assert run(2)["third"][0]["strategy"] == "repaired" and run(0)["mended"][0]["strategy"] == "fallback"


def test_nothing_to_screen(spark):
    assert boundaries.screen_boundaries(spark.createDataFrame([], "trace_id string, turn_id string, pos int, content string"), model, "ask", "repair").count() == 0
