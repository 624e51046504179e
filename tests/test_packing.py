"""Packing: step functions against a walk, and the whole operator where one key holds nearly all items."""

import random

import numpy as np
import pytest

from sessiongrain.operators import packing


def walk(sizes, limit, held=0, at=0):
    out = []
    for n in sizes:
        if held and held + n > limit:
            at, held = at + 1, 0
        held += n
        out.append(at)
    return out, held


def test_steps_equal_a_walk():
    rnd = random.Random(1)
    for _ in range(150):
        limit = rnd.randint(1, 40)
        runs = [[rnd.choice([0, 1, 2, rnd.randint(0, 60)]) for _ in range(rnd.randint(1, 12))] for _ in range(rnd.randint(1, 4))]
        steps = packing.steps_of(np.array(runs[0]), limit)
        for run in runs[1:]:
            steps = steps.then(packing.steps_of(np.array(run), limit))
        flat = [n for run in runs for n in run]
        for held in range(0, limit + 70):
            bins, after = walk(flat, limit, held)
            got = steps.at(np.array([held]))
            assert (int(got[0][0]), int(got[1][0])) == (after, bins[-1]), (limit, runs, held)
            assert packing._walk(np.array(flat), limit, held, 0).tolist() == bins


@pytest.mark.parametrize(("block_rows", "fan"), [(3, 2), (7, 3), (65_536, 128)])
def test_packing_is_greedy(spark, block_rows, fan):
    rnd = random.Random(2)
    rows = [("hot", i, rnd.choice([0, rnd.randint(1, 60), rnd.randint(90, 130)]), "x") for i in range(600)]
    rows += [(k, i, rnd.randint(1, 60), "x") for k in ("a", "", None) for i in range(40)] + [("one", 1, 500, "x")]
    df = spark.createDataFrame(rows, "k string, i int, n int, bin_note string")
    got = {(r["k"], r["i"]): r["bin"] for r in packing.pack(df, "k", "i", "n", 100, block_rows, fan).collect()}
    assert len(got) == len(rows)
    for k in ("hot", "a", "", None, "one"):
        mine = [r for r in rows if r[0] == k]
        assert [got[k, r[1]] for r in mine] == walk([r[2] for r in mine], 100)[0]


def test_ties_nulls_and_nothing(spark):
    df = spark.createDataFrame([("a", None, 3), ("a", None, 3), ("a", 2, None), ("a", 2, 4), ("a", 2, 4)], "k string, i long, n long")
    got = sorted((r["i"] is not None, r["n"] or 0, r["bin"]) for r in packing.pack(df, "k", "i", "n", 6, 2, 2).collect())
    assert got == [(False, 3, 0), (False, 3, 0), (True, 0, 0), (True, 4, 1), (True, 4, 2)]
    assert packing.pack(df.where("false"), "k", "i", "n", 6).count() == 0
