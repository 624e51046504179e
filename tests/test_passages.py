"""The closest passage of a wrong quote against all its parts; what a model is told."""

import random

from pyspark.sql import functions as F

from sessiongrain.operators import evidence


def longest(quote, source):
    parts = ((n, i) for n in range(len(quote), 0, -1) for i in range(len(quote) - n + 1) if quote[i : i + n] in source)
    n, i = next(parts, (0, -1))
    return (i + 1, n, source.find(quote[i : i + n]) + 1 if n else 0)


def test_closest_passage_equals_all_parts(spark):
    rnd = random.Random(7)
    word = lambda k: "".join(rnd.choice("ab é😀") for _ in range(rnd.randint(0, k)))
    pairs = [(word(14), word(40)) for _ in range(150)] + [("", "abc"), ("abc", ""), ("xyz", "abc"), ("abc", "abc"), ("aaaa", "aaa"), ("abcXdef", "def abc")]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)] + [(-1, None, "a"), (-2, "a", None)], "i int, q string, s string").repartition(4)
    got = {r["i"]: r["p"] for r in rows.select("i", evidence.closest_passage(F.col("q"), F.col("s"), 3).alias("p")).collect()}
    assert got.pop(-1) is None and got.pop(-2) is None
    for i, (q, s) in enumerate(pairs):
        start, n, at = longest(q, s)
        assert tuple(got[i])[:3] == (start, n, at), (q, s)
        assert got[i]["passage"] == (s[max(0, at - 4) : at - 1 + n + 3] if n else ""), (q, s)


def test_feedback(spark):
    quotes = spark.createDataFrame([("e1", "the file was lost"), ("e1", "the file"), ("e1", "zzz"), ("e1", ""), ("e2", "q"), ("e3", "q"), ("e1", None)], "event_id string, quote string")
    events = spark.createDataFrame([("e1", "so the file was found"), ("e3", None)], "event_id string, body string")
    got = {(r["event_id"], r["quote"]): r["feedback"] for r in evidence.citation_feedback(quotes, events).collect()}
    assert got == {
        ("e1", "the file was lost"): "quote_not_exact; closest passage: so the file was found", ("e1", "zzz"): "quote_not_exact; nothing of it is in the source",
        ("e1", ""): "quote_not_exact; nothing of it is in the source", ("e1", None): "quote_not_exact; nothing of it is in the source", ("e2", "q"): "unknown_event", ("e3", "q"): "unknown_event",
    }
