"""Partitions that fail are tried in halves; every item is answered or listed as failed."""

import json

from sessiongrain.plans import worklist


def picky(system, user):
    items = json.loads(user)
    if len(items) > 2 or any(x["text"] == "bad" for x in items):
        raise RuntimeError("no")
    return {"items": {x["id"]: x["text"].upper() for x in items if x["text"] != "mute"}}, {}


def test_failed_partitions_are_halved(spark):
    texts = ["a", "b", "bad", "c", "mute", "d", "e", "f", "g"]
    rows = [("p", i, i, t) for i, t in enumerate(texts)] + [(None, 1, 100, "z"), ("q", 1, 101, "bad")]
    df = spark.createDataFrame(rows, "part string, at int, id long, text string")
    got = {r["id"]: (r["part"], r["depth"], r["answer"], r["error"]) for r in worklist.subdivide(df, picky, "s", "part", "at", "id", "text").collect()}
    assert len(got) == len(rows)
    # Nine items: 5 + 4, then 3 + 2 and 2 + 2, then 2 + 1.
    assert got["0"] == ("p.0.0.0", 3, '"A"', None) and got["2"] == ("p.0.0.1", 3, None, "RuntimeError: no")
    assert got["3"] == ("p.0.1", 2, '"C"', None) and got["4"] == ("p.0.1", 2, None, "not answered") and got["8"] == ("p.1.1", 2, '"G"', None)
    assert got["100"] == ("", 0, '"Z"', None) and got["101"] == ("q", 0, None, "RuntimeError: no")
    shallow = worklist.subdivide(df, picky, "s", "part", "at", "id", "text", most_depth=1)
    assert shallow.where("error = 'RuntimeError: no'").count() == 10 and shallow.count() == len(rows)


def test_nothing_to_do(spark):
    assert worklist.subdivide(spark.createDataFrame([], "part string, at int, id long, text string"), picky, "s", "part", "at", "id", "text").count() == 0
