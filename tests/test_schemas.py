"""The schema compiler against a validator of one value at a time."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from sessiongrain.operators import schemas
from sessiongrain.plans import checked_queries as cq


def kind(v):
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, (int, float)):
        return "integer" if v == int(v) else "number"
    return "string" if isinstance(v, str) else "array" if isinstance(v, list) else "object"


def same(a, b):
    return kind(a).replace("integer", "number") == kind(b).replace("integer", "number") and a == b


def check(v, s, root, named, path=""):
    if isinstance(s, bool):
        return [] if s else [(path, "false")]
    t, out = kind(v), []
    bad = lambda k, x: out.append((path, k)) if x else None
    num, down = t in ("integer", "number"), lambda x, q, p: check(x, q, root, named, p)
    for k, r in s.items():
        if k == "$ref":
            name, _, pointer = r.partition("#")
            base = named[name] if name else root
            at = base
            for part in [p for p in pointer.split("/") if p]:
                at = at[part]
            out += check(v, at, base, named, path)
        elif k == "type":
            allowed = [r] if isinstance(r, str) else r
            bad(k, not (t in allowed or t == "integer" and "number" in allowed))
        elif k == "enum":
            bad(k, not any(same(v, x) for x in r))
        elif k == "const":
            bad(k, not same(v, r))
        elif k in ("minLength", "maxLength", "pattern") and t == "string":
            bad(k, len(v) < r if k == "minLength" else len(v) > r if k == "maxLength" else not re.search(r, v))
        elif k in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf") and num:
            bad(k, {"minimum": lambda: v < r, "maximum": lambda: v > r, "exclusiveMinimum": lambda: v <= r, "exclusiveMaximum": lambda: v >= r, "multipleOf": lambda: v % r != 0}[k]())
        elif k in ("minItems", "maxItems") and t == "array":
            bad(k, len(v) < r if k == "minItems" else len(v) > r)
        elif k == "uniqueItems" and t == "array":
            bad(k, r and any(same(a, b) for i, a in enumerate(v) for b in v[:i]))
        elif k in ("minProperties", "maxProperties", "required") and t == "object":
            bad(k, len(v) < r if k == "minProperties" else len(v) > r if k == "maxProperties" else any(x not in v for x in r))
        elif k == "properties" and t == "object":
            for name, inner in r.items():
                if name in v:
                    out += down(v[name], inner, f"{path}/{name}".replace("a/b", "a~1b"))
        elif k == "additionalProperties" and t == "object":
            other = [x for x in v if x not in s.get("properties", {}) and not any(re.search(p, x) for p in s.get("patternProperties", {}))]
            if r is False:
                bad(k, other)
            else:
                for x in other:
                    out += down(v[x], r, f"{path}/{x}")
        elif k == "patternProperties" and t == "object":
            for p, inner in r.items():
                for x in v:
                    if re.search(p, x):
                        out += down(v[x], inner, f"{path}/{x}".replace("a/b", "a~1b"))
        elif k == "items" and t == "array":
            n = len(s.get("prefixItems", []))
            for i, x in enumerate(v[n:]):
                out += down(x, r, f"{path}/{i + n}")
        elif k == "prefixItems" and t == "array":
            for i, (x, inner) in enumerate(zip(v, r, strict=False)):
                out += down(x, inner, f"{path}/{i}")
        elif k == "contains" and t == "array":
            bad(k, sum(not down(x, r, "") for x in v) < s.get("minContains", 1))
        elif k == "allOf":
            for x in r:
                out += down(v, x, path)
        elif k in ("anyOf", "oneOf"):
            n = sum(not down(v, x, "") for x in r)
            bad(k, n == 0 if k == "anyOf" else n != 1)
        elif k == "not":
            bad(k, not down(v, r, ""))
        elif k == "if":
            branch = "else" if down(v, r, "") else "then"
            out += down(v, s[branch], path) if branch in s else []
    return out


SCHEMA = {
    "type": ["object", "array", "string", "integer"],
    "properties": {
        "a": {"type": "number", "minimum": 1, "exclusiveMaximum": 3, "multipleOf": 0.5}, "a/b": {"$ref": "other#/$defs/name"}, "c": {"items": {"$ref": "#"}, "minItems": 1, "uniqueItems": True},
        "d": {"prefixItems": [{"const": 1}, {"type": "boolean"}], "items": {"enum": ["x", 2, None, [1, 2], {"k": "v"}]}, "contains": {"const": "x"}},
        "o": {"oneOf": [{"type": "integer"}, {"minimum": 2}], "not": {"const": 5}}, "z": False,
    },
    "patternProperties": {"^p": {"type": "string", "maxLength": 2}}, "additionalProperties": {"type": "null"}, "minProperties": 1, "maxProperties": 4,
    "if": {"required": ["a"]}, "then": {"required": ["c"]}, "else": {"allOf": [{"minLength": 2}, {"pattern": "x"}]},
}
OTHER = {"$defs": {"name": {"anyOf": [{"type": "string", "minLength": 2}, {"enum": [True, 0]}]}}}


def value(rnd, depth=0):
    simple = [None, True, False, 0, 1, 1.0, 1.5, 2, 2.25, 5, -3, "", "x", "xy", "é😀x", "abc"]
    if depth > 2 or rnd.random() < 0.5:
        return rnd.choice(simple)
    if rnd.random() < 0.5:
        return [value(rnd, depth + 1) for _ in range(rnd.randint(0, 4))]
    return {k: value(rnd, depth + 1) for k in rnd.sample(["a", "a/b", "c", "d", "o", "z", "p1", "q"], rnd.randint(0, 5))}


def test_violations_equal_one_by_one(spark):
    rnd = random.Random(5)
    values = [value(rnd) for _ in range(300)]
    rows = [(i, json.dumps(v, ensure_ascii=False)) for i, v in enumerate(values)]
    df = spark.createDataFrame([*rows, (998, None), (999, "{not json"), (0, rows[0][1])], "id long, text string").withColumn("path", F.lit(1))
    got = {}
    for r in schemas.schema_violations(df, ["id"], "text", SCHEMA, {"other": OTHER}).collect():
        got.setdefault(r.id, []).append((r.path, r.keyword))
    want = {i: check(v, SCHEMA, SCHEMA, {"other": OTHER}) for i, v in enumerate(values)} | {998: [("", "type")], 999: [("", "type")]}
    want[0] = want[0] * 2
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items() if v}


def test_deeper_than_unrolled_is_reported(spark):
    schema = {"type": "object", "properties": {"x": {"$ref": "#"}}}
    nested = lambda n: '{"x":' * n + "{}" + "}" * n
    df = spark.createDataFrame([(1, nested(3)), (2, nested(9)), (3, '{"x":{"x":3}}')], "id long, text string")
    assert sorted(tuple(r) for r in schemas.schema_violations(df, ["id"], "text", schema).collect()) == [(2, "/x" * 6, "$ref"), (3, "/x/x", "type")]


def test_unknown_reference_raises(spark):
    with pytest.raises(KeyError):
        schemas.schema_violations(spark.createDataFrame([("1",)], "text string"), [], "text", {"$ref": "nowhere#/x"})


def test_query_equals_one_by_one(spark, sf_dir):
    events = cq.event_records(cq.table(spark, sf_dir, "events")).select("event_id", "record")
    got = sorted(tuple(r) for r in cq.schema_violations(spark, sf_dir).collect() if r.keyword != "format")
    want = sorted((e, *x) for e, text in events.collect() for x in check(json.loads(text), cq.EVENT_SCHEMA, cq.EVENT_SCHEMA, {"common.schema.json": cq.USER_SCHEMA}))
    assert got == want
