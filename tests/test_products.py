"""Turn products, selections, settings and the model client."""

import json

import duckdb
import pytest
from pyspark.sql import functions as F

from sessiongrain.operators import products, selections
from sessiongrain.plans import client, product_queries, queries
from sessiongrain.sources import adapters, files


def test_usage_text_and_models(spark):
    rows = [(1, '{"input_tokens": 3, "output_tokens": 4}'), (2, '{"output_tokens": "x"}'), (3, None), (4, "no json")]
    df = spark.createDataFrame(rows, "id int, u string")
    assert [r["t"] for r in df.select("id", products.usage_total(F.col("u")).alias("t")).orderBy("id").collect()] == [7, 0, None, None]
    texts = ['{"tool_name": "run", "arguments": "a"}', '{"content": "c", "message": "m"}', '{"message": "m"}', "{}", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, d string")
    assert [r["t"] for r in df.select("id", products.event_text(F.col("d")).alias("t")).orderBy("id").collect()] == ["run a", "c", "m", "", ""]
    calls = spark.createDataFrame([("s", 1, "m"), ("s", 2, None), ("t", 1, "m"), ("t", 2, "n"), ("t", 3, None)], "s string, t int, m string")
    got = {(r["s"], r["t"]): (r["models"], r["inferred"]) for r in products.turn_models(calls, "s", "t", "m").collect()}
    assert got["s", 2] == (["m"], True) and got["t", 3] == ([], False) and got["t", 1] == (["m"], False)


def test_selections_on_empty_and_null(spark):
    empty = spark.createDataFrame([], "g string, l string, c long")
    assert selections.compression_draft(empty, "g", "l", "c", 0.1).count() == 0 and selections.facet_options(empty, ["g"]).count() == 0
    assert tuple(selections.watermark(empty, "c").first()) == (0, None)
    rows = spark.createDataFrame([("a", None), ("a", "x"), ("b", "x")], "g string, l string")
    allowed = spark.createDataFrame([("x",)], "l string")
    assert {r["g"]: r["within"] for r in selections.groups_within(rows, "g", "l", allowed).collect()} == {"a": False, "b": True}
    tree = spark.createDataFrame([("r", None, ""), ("i", "r", "x"), ("l", "i", "Xy"), ("m", "i", "z")], "id string, parent string, text string")
    assert {r["id"] for r in selections.tree_search(tree, "text", "x").collect()} == {"l", "i", "r"} and selections.tree_search(tree, "text", "q").count() == 0


def test_back_off_opens_and_probes():
    answers = iter([client.Unavailable] * 7 + [None] * 2)

    def judge(system, user):
        if next(answers):
            raise client.Unavailable
        return {"ok": 1}, {}

    caller = client.Caller([judge, judge])
    with pytest.raises(client.Unavailable):
        caller.send("s", "u")
    assert caller.waited == [15, 45, 120] and caller.failures == 4
    assert caller.send("s", "u")[0] == {"ok": 1} and caller.waited[3:] == [180, 180, 180] and caller.failures == 0


def test_a_dead_service_stops_all_requests_of_a_task():
    """Forty requests: five failures open the circuit, then one probe every 180 seconds; each request has four tries."""
    calls = []

    def dead(system, user):
        calls.append(sum(caller.waited))
        raise client.Unavailable

    caller = client.Caller([dead])
    got = list(caller.answers("s", ((i, client.dialogue("u", lambda v: None)) for i in range(40))))
    assert {k for k, _, _ in got} == set(range(40)) and all(r["error"] == "service unavailable" and w == 180 for _, r, w in got)
    assert len(calls) == 160 and calls[:5] == [0] * 5 and all(b - a >= 180 for a, b in zip(calls[4:], calls[5:], strict=False))


def test_a_service_that_recovers_answers_everything():
    """While one client fails, requests wait their turn and others go on; the probe closes the circuit; clients take equal shares."""
    served = [0, 0]

    def away_until(k, end):
        def judge(system, user):
            if sum(caller.waited) < end:
                raise client.Unavailable
            served[k] += 1
            return {"ok": k}, {}

        return judge

    caller = client.Caller([away_until(0, 100), away_until(1, 0)])
    got = list(caller.answers("s", ((i, client.dialogue("u", lambda v: None)) for i in range(30))))
    assert len(got) == 30 and all(r["error"] is None for _, r, _ in got) and max(w for _, _, w in got) <= 180
    assert [k for k, _, _ in got][0] == 1 and served[1] > served[0] > 0
    served[:] = [0, 0]
    caller = client.Caller([away_until(0, 0), away_until(1, 0)])
    assert len(list(caller.answers("s", ((i, client.dialogue("u", lambda v: None)) for i in range(30))))) == 30 and served == [15, 15]
    caller = client.Caller([away_until(0, 100)])
    got = list(caller.answers("s", ((i, client.dialogue("u", lambda v: None)) for i in range(30))))
    assert all(r["error"] is None for _, r, _ in got) and caller.waited == [180] and sum(w > 0 for _, _, w in got) == 5


def test_wrong_citations_are_told_their_passage(spark):
    source = "the quick brown fox"

    def judge(system, user):
        return {"quote": "quick brown" if "closest passage: the quick brown" in user else "quick browm"}, {}

    check = lambda v: None if v["quote"] in source else ("not in the source", v["quote"], source)
    out = client.ask_rows(spark.createDataFrame([(i, "p") for i in range(5)], "id int, prompt string").coalesce(1), [judge, judge], "s", check, "id").collect()
    assert [(r["answer"], r["attempts"]) for r in out] == [(json.dumps({"quote": "quick brown"}), 2)] * 5


def test_feedback_keys_and_paths():
    assert "closest passage: the quick" in client.feedback("bad", "quick browm", "the quick brown fox") and client.feedback("bad") == "bad"
    assert client.repaired_keys({"atribution": 1, "x": 2}, ("attribution",)) == {"attribution": 1, "x": 2}
    assert client.path_indexes("r[req_b].f[0]", ["req_a", "req_b"]) == "r[1].f[0]" and client.path_indexes("r[a]", ["a", "a"]) == "r[a]"
    seen = []

    def judge(system, user):
        seen.append(user)
        return {"v": len(seen)}, {}

    got = client.ask(client.Caller([judge]), "s", "u", lambda v: None if v["v"] == 3 else f"no {v['v']}")
    assert got["attempts"] == 3 and "no 2" in seen[2] and got["answer"] == {"v": 3}


def test_balanced_sample_is_spread_and_filled(spark):
    rows = spark.createDataFrame([(i, 100 - i, i < 3) for i in range(20)], "id int, size int, p boolean")
    got = [(r["id"], r["p"]) for r in selections.balanced_sample(rows, F.col("p"), "id", "size", 8).collect()]
    order = sorted(range(3, 20), key=lambda i: 100 - i)
    assert got == [*[(order[round(k * 16 / 4)], False) for k in range(5)], (2, True), (1, True), (0, True)]
    few = spark.createDataFrame([(i, i, i > 0) for i in range(9)], "id int, size int, p boolean")
    got = [r["id"] for r in selections.balanced_sample(few, F.col("p"), "id", "size", 6).collect()]
    assert len(set(got)) == 6 and got == sorted(got) and {0, 1, 8} <= set(got)


def test_source_turns_stand_once(spark):
    rows = spark.createDataFrame([("f", "t", 1, 0), ("g", "t", 2, 1)], "file string, turn string, line int, record int")
    assert products.source_locations(rows, "file", "turn", "line", "record").count() == 2
    with pytest.raises(Exception, match="duplicate source turn f t"):
        products.source_locations(rows.union(rows.limit(1)), "file", "turn", "line", "record").collect()


def test_lines_of_files_are_numbered_past_blank_ones(spark):
    rows = [("f", 0, "a"), ("g", 1, "b"), ("f", 2, " "), ("f", 1 << 16, "c"), (None, 3, "d"), ("f", (1 << 16) + 1, ""), ("f", 1 << 17, "e"), ("f", None, "z"), ("g", 7, None)]
    lines = products.numbered_lines(spark.createDataFrame(rows, "file string, position long, text string"), "file", "position", F.trim("text") == "")
    got = {(r["file"], r["position"]): (r["line"], r["record"]) for r in lines.collect()}
    assert got == {("f", 0): (1, 0), ("f", 1 << 16): (3, 1), ("f", 1 << 17): (5, 2), ("f", None): (6, 3), ("g", 1): (1, 0), ("g", 7): (2, 1), (None, 3): (1, 0)}


def test_source_locations_number_every_file_of_the_events(spark, tmp_path):
    e = [(5, "view", 1, 9, "{}"), (6, "view", 1, 8, " "), (7, "view", 1, 7, "{}"), (4, "view", 2, 6, "{}"), (8, "click", 1, 5, "{}")]
    rows = spark.createDataFrame(e, "event_id long, event_type string, d int, user_id long, props string").withColumn("ts", F.timestamp_seconds(F.col("d") * 86400))
    rows.write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(tuple(r) for r in product_queries.source_locations(spark, str(tmp_path)).select("file", "event_id", "line", "record", "first_event", "first_user").collect())
    assert got == [("click/1970-01-02", 8, 1, 0, 8, 5), ("view/1970-01-02", 5, 1, 0, 5, 9), ("view/1970-01-02", 7, 3, 1, 5, 9), ("view/1970-01-03", 4, 1, 0, 4, 6)]


def test_settings_in_capitals_only(spark):
    said = spark.createDataFrame([("k", "use 512 or x777 please, 900a")], "key string, text string")
    done = spark.createDataFrame([("k", "MAX_LEN = '512' max_len=512 AB=512 LIMIT=777 SIZE: 512 TOP=5120 DEEP=512x")], "key string, text string")
    assert [tuple(r) for r in selections.stated_settings(said, done, "key", "text").collect()] == [("k", "MAX_LEN", "512")]


def test_stated_settings_take_every_order_and_line(spark, tmp_path):
    orders = [(1, 7, "F", 51200.0, "2-HIGH"), (2, 7, "O", 9900.0, "5-LOW"), (3, 8, "P", 77700.0, "5-LOW"), (4, 9, "f", 88800.0, "1-URGENT"), (5, 9, None, 66600.0, "5-LOW")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(2, "R", 51250.0), (2, "N", 9950.0), (3, "A", 51200.0), (4, "A", 66610.0), (99, "A", 51200.0), (3, "N", None)]
    spark.createDataFrame(lines, "l_orderkey long, l_returnflag string, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = sorted(tuple(r) for r in product_queries.stated_settings(spark, str(tmp_path)).select("o_custkey", "name", "value").collect())
    assert got == [(7, "FLAG_R", "512"), (7, "STATUS_F", "512"), (8, "STATUS_P", "777"), (9, "FLAG_A", "666")]
    con = duckdb.connect()
    for t in ("orders", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    assert sorted(con.sql(queries.SQL["stated_settings"]).fetchall()) == got


def test_settings_and_tables(spark, tmp_path):
    assert files.read_settings("# c\nexport A='1'\nB=2\nbad\nA=3", {"B": "own"}) == {"A": "1", "B": "own"}
    toml = '[providers.p]\nbase_url = "u"\nmodel = "m"\n'
    assert files.provider_settings(toml, "p")["model"] == "m"
    with pytest.raises(ValueError):
        files.provider_settings(toml, "q")
    with pytest.raises(ValueError):
        files.markdown_table(spark.range(5), [F.col("id")], 4)
    files.append_durably(f"{tmp_path}/log", [{"a": 1}])
    files.append_durably(f"{tmp_path}/log", [{"a": 2}])
    assert [json.loads(x)["a"] for x in open(f"{tmp_path}/log")] == [1, 2]
    (tmp_path / "b" / "run1").mkdir(parents=True)
    (tmp_path / "b" / "run1" / "x.jsonl").write_text("{}")
    assert files.result_path(spark, str(tmp_path), "b", "run1").endswith("x.jsonl")
    with pytest.raises(ValueError):
        files.result_path(spark, str(tmp_path), "b", "run2")


def test_uploads_and_alignment(spark):
    text = "- a b.txt: local path /x/y z \r\n-\tc: local path /d\nprose: local path /e\n- no path\n"
    row = spark.createDataFrame([(text,)], "t string").select(adapters.uploaded_files(F.col("t")).alias("u")).first()["u"]
    assert [tuple(x) for x in row] == [("a b.txt", "/x/y z"), ("c", "/d")]
    assert adapters.first_new(["a", "b", "c"], ["x", "b", "c", "y", "c", "z"]) == 3 and adapters.first_new(["a", "b"], ["a", "c"]) == 1
