"""Operators on small fixtures against plain Python."""

import json
import math
import random
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from sessiongrain.functions import scalars, statistics
from sessiongrain.operators import evidence, reviews, rollups, rules, sessions
from sessiongrain.plans import judge
from sessiongrain.sources import adapters, files
from sessiongrain.streaming import turns


def test_redaction_order_and_unicode(spark):
    cases = {
        "mail a.b@example.org and 10.0.0.12": "mail <EMAIL> and <IP_ADDRESS>",
        "password: hunter22 x": "password: <SECRET> x",
        "密码是abcdef1": "密码是<SECRET>",
        "key sk-abcdefghijklmnop end": "key <API_KEY> end",
        "Bearer abcdefghijklmnop": "Bearer <TOKEN>",
        "见/home/user/x y": "见/home/user/x y",
        "see /home/user/x y": "see <LOCAL_PATH> y",
        "C:\\Users\\me\\x": "<LOCAL_PATH>",
        "-----BEGIN RSA PRIVATE KEY-----\nabc\n-----END RSA PRIVATE KEY-----": "<PRIVATE_KEY>",
    }
    df = spark.createDataFrame(list(cases.items()), "t string, want string")
    assert df.where(scalars.redact(F.col("t")) != F.col("want")).count() == 0


def test_scalars(spark):
    row = spark.createDataFrame([("a" * 500, "  X  y ", "$.a[0].b", '```json\n{"k": 1}\n```', None)], "t string, l string, p string, j string, n string").select(
        scalars.preview(F.col("t")).alias("p"), scalars.label_key(F.col("l")).alias("l"), scalars.dotted_path(F.col("p")).alias("d"),
        scalars.parse_candidates(F.col("j")).cast("string").alias("j"), scalars.public_text(F.col("n")).alias("n"), scalars.truncate(F.col("t"), 10).alias("c"),
        scalars.field_value(F.parse_json(F.lit('{"a":[{"b":"x"}]}')), F.lit("a.0.b")).alias("v"),
    ).first()
    assert row["p"]["head"] == "a" * 180 and row["p"]["text"] is None
    assert (row["l"], row["d"], row["j"], row["n"], row["c"], row["v"]) == ("x y", "a.0.b", '{"k":1}', "", "a" * 9 + "…", "x")


def test_carry_reset_keeps_terminator(spark):
    df = spark.createDataFrame([(1, 1, "o"), (1, 2, "x"), (1, 3, "c"), (1, 4, "x"), (1, 5, "o"), (1, 6, "x")], "s int, q int, k string")
    out = sessions.carry_forward(df, ["s"], ["q"], F.when(F.col("k") == "o", F.col("q")), F.col("k") == "c").orderBy("q").collect()
    assert [r["turn_id"] for r in out] == [1, 1, 1, None, 5, 5]


def test_turn_status(spark):
    rows = [
        ("s", "t1", 1, "user_message", None, None), ("s", "t1", 2, "tool_call", None, "c"),
        ("s", "t2", 3, "user_message", None, None), ("s", "t2", 4, "assistant_message", None, None), ("s", "t2", 5, "token_usage", None, None),
        ("s", "t3", 6, "user_message", None, None), ("s", "t3", 7, "error", None, None),
        ("s", "t4", 8, "user_message", None, None),
    ]
    df = spark.createDataFrame(rows, "session_id string, turn_id string, sequence int, type string, native_type string, call_id string")
    out = {r["turn_id"]: (r["turn_index"], r["status"]) for r in sessions.turn_status(df).collect()}
    assert out == {"t1": (1, "interrupted"), "t2": (2, "completed"), "t3": (3, "aborted"), "t4": (4, "incomplete")}


def test_clean_user_text(spark):
    cases = [("<task-notification> x", None), ("[用户提问] a 用户消息： hello", "hello"), ("pre ### User message\n real ", "real"), ("  plain ", "plain"), ("   ", None), (None, None)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    got = [r["c"].strip() if r["c"] else r["c"] for r in df.select("i", sessions.clean_user_text(F.col("t")).alias("c")).orderBy("i").collect()]
    assert got == [w for _, w in cases]


def test_coverage_against_loops(spark):
    rnd = random.Random(1)
    ranges = [("a", x, x + rnd.randint(0, 5)) for x in (rnd.randint(0, 20) for _ in range(12))]
    df = sessions.coverage(spark.createDataFrame([("a", p) for p in range(25)], "k string, pos int"), spark.createDataFrame(ranges, "k string, start int, end int"), ["k"])
    assert {r["pos"]: r["times"] for r in df.collect()} == {p: sum(a <= p <= b for _, a, b in ranges) for p in range(25)}


def test_excerpts_equal_one_by_one(spark):
    rnd = random.Random(3)
    terms = ("error", "fail", "错误", "ab")
    texts = ["x" * 300 + " Error here " + "y" * 50 + " failed there " + "z" * 500 + " fail ", "", None, "abab" * 30, "error", "\n\terror \n  x" * 9]
    texts += ["".join(rnd.choice(["ERROR", "fail", "错误", "é ", "\n", "ab", "q" * 40, "😀"]) for _ in range(rnd.randint(0, 60))) for _ in range(30)]

    def brute(text):
        windows = []
        for term in terms:
            for m in re.finditer(re.escape(term), text or "", re.I):
                low = max(m.start() - 30, 0)
                high = min(low + 60, len(text))
                if len(windows) < 4 and not any(x < high and low < y for x, y in windows):
                    windows.append((low, high))
        return [" ".join(text[x:y].split()) for x, y in windows]

    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = dict(tuple(r) for r in df.select("id", evidence.excerpts(F.col("text"), terms, 4, 60)).collect())
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_quotes(spark):
    events = spark.createDataFrame([("e1", "the quick fox")], "event_id string, body string")
    quotes = spark.createDataFrame([("e1", "quick fox"), ("e1", "quick  fox"), ("e2", "x"), ("e1", "")], "event_id string, quote string")
    assert sorted(r["outcome"] for r in evidence.quote_checks(quotes, events).collect()) == ["quote_not_exact", "quote_not_exact", "unknown_event", "valid"]


@pytest.mark.parametrize(
    ("gates", "integrity", "want"),
    [((True,) * 4, "complete", "high"), ((True, False, None, True), "complete", "low"), ((True, None, True, True), "complete", "unknown"), ((True,) * 4, "partial", "medium"), ((True,) * 4, "broken", "low"), ((True,) * 4, None, "unknown")],
)
def test_gates(spark, gates, integrity, want):
    df = spark.createDataFrame([(*gates, integrity)], "a boolean, b boolean, c boolean, d boolean, i string")
    assert df.select(rules.quality_gates([F.col(c) for c in "abcd"], F.col("i"))).first()[0] == want


def test_selection_and_downgrades(spark):
    df = spark.createDataFrame([(True, "pass", False, "pass", "pass"), (True, "pass", True, "fail", "pass"), (True, "pass", False, "fail", "pass"), (False, "pass", False, "pass", "pass"), (True, "pending", False, "pass", "pass")], "v boolean, s string, c boolean, r1 string, r2 string")
    got = [r[0] for r in df.select(rules.selection_decision(F.col("v"), F.col("s"), F.col("c"), [F.col("r1"), F.col("r2")])).collect()]
    assert got == ["priority_candidate", "review", "not_selected", "review", "review"]
    d = spark.createDataFrame([(True, "f", "r", ["g"], "sufficient"), (True, "", "r", ["g"], "sufficient"), (True, "f", "r", ["g"], None), (False, None, None, [], "sufficient")], "a boolean, f string, r string, g array<string>, e string")
    assert [r[0] for r in d.select(rules.downgrade_attribution(*[F.col(c) for c in "afrg"], F.col("e"))).collect()] == [True, None, None, False]
    assert [r[0] for r in d.select(rules.reason_codes(F.lit(None).cast("boolean"), F.array(F.lit("x:incomplete"), F.lit("quote_not_exact")))).limit(1).collect()] == [["evidence_quote_not_exact", "required_analysis_fields_missing"]]


def tail(k, n, p):
    """P[Bin(n, p) >= k] in whole numbers and fractions' logarithms."""
    return math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(max(k, 0), n + 1))


def test_bounds_and_tests(spark):
    for k, n in ((0, 10), (3, 10), (10, 10), (1, 500)):
        up, low = statistics.bound(k, n, 0.95, True), statistics.bound(k, n, 0.95, False)
        if k < n:
            assert math.isclose(1 - tail(k + 1, n, up), 0.05, abs_tol=1e-9)
        if k:
            assert math.isclose(tail(k, n, low), 0.05, abs_tol=1e-9)
    df = spark.createDataFrame([(3, 4, 4, 8)], "both int, a int, b int, n int")
    assert math.isclose(statistics.fisher_greater(df, "both", "a", "b", "n").first()["p"], 17 / 70, rel_tol=1e-9)


def test_tests_over_wide_ranges(spark):
    """Binomial, hypergeometric and adjusted values against exact sums, on both sides of the mean and at the edges."""
    from fractions import Fraction

    cases = [(k, n) for n in (1, 2, 17, 400, 9000) for k in sorted({-1, 0, 1, n // 50, n // 20, n // 10, n - 1, n})]
    got = statistics.binomial_cdf(spark.createDataFrame([*cases, (None, 3)], "k int, n int"), "k", "n", 0.05).collect()
    for r in got:
        if r["k"] is None:
            assert r["cdf"] is None
        else:
            want = 0.0 if r["k"] < 0 else 1 - tail(r["k"] + 1, r["n"], 0.05) if r["k"] < r["n"] / 20 else math.fsum([1, -tail(r["k"] + 1, r["n"], 0.05)])
            assert math.isclose(r["cdf"], want, abs_tol=1e-9), r
    tables = [(x, a, b, n) for a, b, n in ((4, 4, 8), (0, 3, 9), (700, 800, 1000), (1500, 2000, 4000)) for x in sorted({0, min(a, b) // 2, a * b // n, min(a, b), min(a, b) + 1})]
    for r in statistics.fisher_greater(spark.createDataFrame(tables, "x int, a int, b int, n int"), "x", "a", "b", "n").collect():
        ways = sum(math.comb(r["a"], i) * math.comb(r["n"] - r["a"], r["b"] - i) for i in range(max(r["x"], 0), min(r["a"], r["b"]) + 1))
        assert math.isclose(r["p"], float(Fraction(ways, math.comb(r["n"], r["b"]))), rel_tol=1e-8, abs_tol=1e-300), r
    ps = [0.0, 1e-300, 1e-9, 0.01, 0.01, 0.011, 0.2, 0.2, 0.2, 0.7, 1.0, 1.0]
    m, ordered = len(ps), sorted(ps)
    h = sum(1 / i for i in range(1, m + 1))
    want = {p: min(min(1.0, q * m * h / (j + 1)) for j, q in enumerate(ordered) if q >= p) for p in ps}
    out = statistics.by_adjust(spark.createDataFrame([(p,) for p in [*ps, None]], "p double"), "p").collect()
    assert len(out) == m + 1 and all((r["q"] is None) if r["p"] is None else math.isclose(r["q"], want[r["p"]], rel_tol=1e-10) for r in out)


def test_bootstrap_follows_the_multinomial(spark):
    """Clusters of unlike sizes, null keys among them: the interval is near that of plain resampling."""
    import numpy as np

    rows = [(c, key, (c * 7 + i) % 5 == 0) for key in ("x", None) for c in range(80) for i in range(c % 4 + 1)]
    got = {r["k"]: r for r in statistics.bootstrap_interval(spark.createDataFrame(rows, "c int, k string, hit boolean"), "hit", "c", "k").collect()}
    assert set(got) == {"x", None}
    hits, size = np.zeros(80), np.zeros(80)
    for c, key, hit in rows:
        if key == "x":
            hits[c] += hit
            size[c] += 1
    w = np.random.default_rng(1).multinomial(80, [1 / 80] * 80, 20_000)
    low, high = np.quantile((w @ hits) / (w @ size), [0.025, 0.975])
    for r in got.values():
        assert abs(r["low"] - low) < 0.012 and abs(r["high"] - high) < 0.012


def test_bootstrap_is_repeatable(spark):
    df = spark.createDataFrame([(c, "x", (c * 7) % 3 == 0) for c in range(60)], "c int, k string, hit boolean")
    a = statistics.bootstrap_interval(df, "hit", "c", "k", 200).first()
    b = statistics.bootstrap_interval(df.repartition(3), "hit", "c", "k", 200).first()
    assert a == b and a["low"] < 1 / 3 < a["high"]


def test_reviews(spark):
    events = spark.createDataFrame([("r1", "c1", 1, 1, "confirmed"), ("r2", "c1", 2, 2, "excluded")], "review_id string, case_id string, revision int, event_sequence int, decision string")
    assert reviews.latest_reviews(events).first()["review_id"] == "r2"
    new = spark.createDataFrame([("r3", "c1", "review", 2), ("r4", "c1", "review", 2), ("r5", "c2", "confirmed", 1)], "review_id string, case_id string, decision string, expected_revision int")
    after, conflicts = reviews.append_reviews(events, new)
    assert {r["review_id"]: r["revision"] for r in after.collect()} == {"r1": 1, "r2": 2, "r3": 3}
    assert sorted(r["review_id"] for r in conflicts.collect()) == ["r4", "r5"]
    cases = spark.createDataFrame([("c1", "review"), ("c9", "confirmed")], "case_id string, pain_judgment string")
    assert {r["case_id"]: r["status"] for r in reviews.overlay(cases, events).collect()} == {"c1": "excluded", "c9": "confirmed"}
    with pytest.raises(Exception, match="conflicting content"):
        reviews.merge_by_id(events, events.withColumn("decision", F.lit("x"))).collect()


def test_tree_and_positions(spark):
    t = spark.createDataFrame([("r", None, 0), ("a", "r", 1), ("b", "r", 2), ("c", "a", 5)], "id string, parent string, n int")
    assert {r["id"]: r["total"] for r in rollups.tree_rollup(t).collect()} == {"r": 8, "a": 6, "b": 2, "c": 5}
    df = spark.createDataFrame([(i * 37 % 101, i) for i in range(101)], "x int, i int")
    assert [r["position"] for r in rollups.global_position(df, ["x"]).orderBy("x").collect()] == list(range(101))


def test_sources(spark, tmp_path):
    (tmp_path / "in").mkdir()
    good = [{"a": 1}, {"b": "x\u2028y"}]
    (tmp_path / "in" / "x.jsonl").write_text("\ufeff" + "\n".join(json.dumps(g, ensure_ascii=False) for g in good) + "\n\n[1]\nnot json password=abcdefgh\n", encoding="utf-8")
    ok, bad = files.split_rejects(files.read_json_lines(spark, str(tmp_path / "in")))
    assert ok.count() == 2 and sorted(r["text"] for r in bad.collect()) == ["[1]", "not json password=<SECRET>"]
    numbered = files.read_numbered_lines(spark, str(tmp_path / "in")).orderBy("line").collect()
    assert [r["line"] for r in numbered] == [1, 2, 4, 5]
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("dir/raw_trace_events.jsonl", "1\n\n2\n")
    rows = files.read_archives(spark, str(tmp_path)).orderBy("line").collect()
    assert [(r["line"], r["value"]) for r in rows] == [(1, "1"), (3, "2")] and rows[0]["crc32"] == files.crc32_hex(b"1\n\n2\n")
    (tmp_path / "t.csv").write_text("\ufeffparent,child\nA,x\n,y\nB,z\n", encoding="utf-8")
    csv = files.read_csv(spark, str(tmp_path / "t.csv")).withColumn("n", F.monotonically_increasing_id())
    assert [r["parent"] for r in files.fill_hierarchy(csv, "parent", "n").orderBy("n").collect()] == ["A", "A", "B"]


def test_upsert_and_immutable(spark):
    base = spark.createDataFrame([(1, "a", "t0"), (None, "n", "t0")], "k int, v string, registered_at string")
    out = files.upsert(base, spark.createDataFrame([(None, "m", "t1"), (2, "b", "t1")], base.schema), ["k"])
    assert sorted((r["k"] or 0, r["v"]) for r in out.collect()) == [(0, "m"), (1, "a"), (2, "b")]
    assert files.add_immutable(base, spark.createDataFrame([(1, "a", "t9"), (3, "c", "t9")], base.schema), "k").count() == 3
    with pytest.raises(Exception, match="conflicting record"):
        files.add_immutable(base, spark.createDataFrame([(1, "z", "t9")], base.schema), "k").collect()


def records(spark, rows):
    df = spark.createDataFrame([("f.jsonl", i, json.dumps(r)) for i, r in enumerate(rows)], "file string, record_index long, value string")
    return df.select("file", "record_index", F.parse_json("value").alias("record"))


def test_session_adapter(spark):
    rows = [
        {"type": "user", "sessionId": "s", "uuid": "u1", "promptId": "p1", "timestamp": "t1", "message": {"role": "user", "content": "do it"}},
        {"type": "assistant", "sessionId": "s", "uuid": "u2", "message": {"id": "m", "model": "x", "stop_reason": "tool_use", "content": [{"type": "thinking", "thinking": "hm"}, {"type": "tool_use", "id": "c1", "name": "run", "input": {"a": 1}}], "usage": {"input": 1}}},
        {"type": "user", "sessionId": "s", "uuid": "u3", "message": {"content": [{"type": "tool_result", "tool_use_id": "c1", "content": "ok"}]}},
        {"type": "assistant", "sessionId": "s", "uuid": "u4", "message": {"id": "m2", "model": "x", "stop_reason": "end_turn", "content": [{"type": "text", "text": "done"}]}},
        {"type": "system", "sessionId": "s", "uuid": "u5", "content": "idle"},
    ]
    out = adapters.normalise(records(spark, rows), "b").orderBy("sequence").collect()
    assert [r["type"] for r in out] == ["user_message", "model_call", "reasoning", "tool_call", "token_usage", "model_result", "tool_result", "model_call", "assistant_message", "model_result", "system_event"]
    assert len({r["turn_id"] for r in out[:-1]}) == 1 and out[-1]["turn_id"] is None
    assert out[0]["sequence"] == 101 and json.loads(out[3]["data"])["tool_name"] == "run"


def test_collector_adapter(spark):
    wrap = lambda inner, **more: {"trace_schema_version": "1", "event_id": "e", "session_id": "s", "source": {}, "event_type": "event_msg", "payload": {"payload": inner}, **more}
    rows = [
        wrap({"type": "user_message", "message": "hi"}, event_id="e1", sequence=1),
        wrap({"type": "message"}, event_id="e2", event_type="response_item", sequence=2),
        wrap({"type": "function_call", "call_id": "c", "name": "run", "arguments": "{}"}, event_id="e3", sequence=3),
        wrap({"type": "mystery"}, event_id="e4", sequence=4),
        wrap({"type": "turn_aborted"}, event_id="e5", sequence=5),
    ]
    out = adapters.normalise(records(spark, rows), "b").orderBy("sequence").collect()
    assert [r["type"] for r in out] == ["user_message", "system_event", "tool_call", "system_event", "error"]
    assert json.loads(out[0]["data"])["content"] == "hi" and json.loads(out[2]["data"])["call_id"] == "c"


def test_proxy_adapter(spark):
    head = {"request_metadata": {"headers": {"x-session-id": "s"}}}
    u1, a1, u2 = {"role": "user", "content": "q1"}, {"role": "assistant", "content": "r1"}, {"role": "user", "content": [{"type": "text", "text": "q2", "cache_control": {"x": 1}}]}
    snaps = [{**head, "id": "1", "messages": [u1], "response": "r1"}, {**head, "id": "2", "messages": [u1, a1, u2], "response": "r2", "tool_calls": [{"id": "c", "name": "run", "input": {}}]}, {**head, "id": "3", "messages": [a1, u2, {"role": "user", "content": "<system-reminder> x"}], "error": "boom"}]
    out = adapters.normalise(records(spark, [{"content": json.dumps(x)} for x in snaps]), "b").orderBy("sequence").collect()
    said = [(r["type"], json.loads(r["data"]).get("content")) for r in out if r["type"] in ("user_message", "assistant_message")]
    assert said == [("user_message", "q1"), ("assistant_message", "r1"), ("user_message", "q2"), ("assistant_message", "r2")]
    assert sum(r["type"] == "error" for r in out) == 1 and len({r["turn_id"] for r in out if r["turn_id"]}) == 2


def test_snapshot_starts_of_any_session(spark):
    rnd = random.Random(6)
    message = lambda: {"role": "user", "content": rnd.choice("abc")}
    sessions, now = [], []
    for k in range(60):
        if k % 20 == 0:
            now = []
        now = [*now[rnd.choice([0, 0, 1, len(now)]) :], *[message() for _ in range(rnd.randint(0, 3))]]
        sessions.append((f"s{k // 20}", k % 20 + 1, [json.dumps(m) for m in now]))
    got = {(r.session_id, r.place): r.start for r in adapters.snapshot_starts(spark.createDataFrame(sessions, "session_id string, place int, messages array<string>")).collect()}
    marks = {(s, p): [adapters.fingerprint(json.loads(m)) for m in ms] for s, p, ms in sessions}
    assert got == {(s, p): adapters.first_new(marks[s, p - 1], m) if p > 1 else 0 for (s, p), m in marks.items()}


def test_proxy_events_in_order(spark):
    head = {"request_metadata": {"headers": {"x-session-id": "s"}}, "timestamp": "t"}
    upload = "look The user just uploaded\n- a: local path /a"
    first = [{"role": "system", "content": None}, {"role": "user", "content": upload}, "stray", {"role": "user", "content": ["bare", {"type": "image", "source": "z"}]}]
    reply = {"role": "assistant", "content": [{"type": "thinking", "thinking": "hm"}, {"type": "text", "text": " done "}]}
    used = {"role": "assistant", "content": [{"type": "text", "text": "call"}, {"type": "tool_use", "id": "c1", "name": "run", "input": {"x": [1]}}]}
    result = {"role": "user", "content": [{"type": "text", "text": "with result"}, {"type": "tool_result", "tool_use_id": "c1", "content": [{"k": 1}], "is_error": False}]}
    snaps = [
        {**head, "id": "1", "model": "m", "messages": first, "response": "done", "reasoning": "hm"},
        {**head, "id": "2", "messages": [*first, reply, used, result, {"role": "user", "content": "[system] note"}], "tool_calls": [{"call_id": "c2", "tool_name": "go", "arguments": "{}"}, 5], "error": {"code": 1}, "status_code": 500},
        {**head, "messages": [{"role": "user", "content": "next"}]},
    ]
    out = adapters.normalise(records(spark, [{"content": json.dumps(x)} for x in snaps]), "b").orderBy("sequence").collect()
    assert [r["sequence"] for r in out] == list(range(1, len(out) + 1)) and len({r["event_id"] for r in out}) == len(out)
    seen = [(r["type"], {k: v for k, v in json.loads(r["data"]).items() if k not in ("request_id", "model", "provider")}) for r in out]
    assert seen == [
        ("system_event", {"kind": "request_snapshot"}), ("assistant_message", {}), ("user_message", {"content": "look"}), ("system_event", {"kind": "uploaded_files", "content": upload[5:]}),
        ("user_message", {"content": "bare"}), ("unknown", {"content_block": {"type": "image", "source": "z"}}), ("model_call", {}), ("reasoning", {"content": "hm"}), ("model_result", {}), ("assistant_message", {"content": "done"}),
        ("system_event", {"kind": "request_snapshot"}), ("assistant_message", {"content": "call"}), ("tool_call", {"call_id": "c1", "tool_name": "run", "arguments": {"x": [1]}}),
        ("user_message", {"content": "with result"}), ("tool_result", {"call_id": "c1", "content": [{"k": 1}], "is_error": False}), ("system_event", {"content": "[system] note"}),
        ("model_call", {}), ("tool_call", {"call_id": "c2", "tool_name": "go", "arguments": "{}"}), ("error", {"error": {"code": 1}, "status_code": 500}),
        ("system_event", {"kind": "request_snapshot"}), ("user_message", {"content": "next"}), ("model_call", {}),
    ]
    turns = [r["turn_id"] for r in out]
    assert turns[0] is None and turns[1] is None and len(set(turns[2:4])) == 1 and len(set(turns[4:20])) == 1 and len(set(turns[20:])) == 1 and len(set(turns)) == 4
    assert json.loads(out[6]["data"])["model"] == "m" and {r["timestamp"] for r in out} == {"t"}


def test_snapshot_alignment():
    assert adapters.first_new(["a", "b"], ["a", "b", "c"]) == 2
    assert adapters.first_new(["a", "b", "c"], ["b", "c", "d"]) == 2
    assert adapters.first_new(["a", "b"], ["x", "a", "b", "y"]) == 3
    assert adapters.first_new(["a", "x"], ["a", "y"]) == 1


def test_judge_keeps_failures_and_cache(spark):
    def picky(system, user):
        if "bad" in user:
            raise ValueError("no")
        return {"n": len(user)}, {}

    req = spark.createDataFrame([(1, "ok"), (2, "bad"), (3, "known")], "request_id int, prompt string")
    first = judge.call_judge(req.where("request_id = 3"), picky, "s").select("request_hash", "answer")
    cache = spark.createDataFrame(first.collect(), first.schema)
    out = {r["request_id"]: r for r in judge.call_judge(req, picky, "s", cache=cache).collect()}
    assert out[1]["answer"] == '{"n": 2}' and out[2]["error"] == "ValueError: no" and out[2]["attempts"] == 3 and out[3]["cached"]


def test_streaming_turns_equal_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    events = spark.createDataFrame([(i, f"2024-01-01 00:{i:02d}:00", i % 2, k) for i, k in enumerate(["signup", "signup", "view", "purchase", "purchase", "view", "view", "signup"])], "event_id long, ts string, user_id long, event_type string").withColumn("ts", F.to_timestamp("ts"))
    events.coalesce(1).write.parquet(src)
    stream = turns.carry_turns(turns.read_events(spark, src, "event_id long, ts timestamp, user_id long, event_type string"), "user_id", "signup", "purchase")
    q = turns.write_once(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = {r["event_id"]: r["turn_no"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {0: 1, 2: 1, 4: 1, 6: None, 1: 1, 3: 1, 5: None, 7: 2}
