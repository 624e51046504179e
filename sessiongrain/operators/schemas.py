"""JSON Schema validation as one expression over VARIANT: a schema becomes columns, no row meets Python."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessiongrain.functions.scalars import let

VIOLATIONS = "array<struct<path:string,keyword:string>>"
#: How often a reference may lead back into itself. Values nested deeper than that are reported under `$ref`, never passed over.
MOST_DEPTH = 4

# Fixed values of the public format rules (RFC 3339), as far as they are checked.
FORMATS = {
    "date-time": r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])[Tt]([01]\d|2[0-3]):[0-5]\d:([0-5]\d|60)(\.\d+)?([Zz]|[+-]([01]\d|2[0-3]):[0-5]\d)$",
    "date": r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$",
}


def _none() -> Column:
    return F.array().cast(VIOLATIONS)


def _when(bad: Column, path: Column, keyword: str) -> Column:
    return F.when(bad, F.array(F.struct(path.alias("path"), F.lit(keyword).alias("keyword")))).otherwise(_none())


def _key(name: Column) -> Column:
    return F.replace(F.replace(name, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))


def _type(v: Column) -> Column:
    """null, boolean, integer, number, string, array or object; a number without a fraction is an integer."""
    return _type_of(F.schema_of_variant(v), v)


def _type_of(kind: Column, v: Column) -> Column:
    whole = F.try_variant_get(v, "$", "double")
    simple = F.when(kind.startswith("OBJECT"), "object").when(kind == "STRING", "string").when(kind.startswith("ARRAY"), "array").when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null")
    return simple.when(kind.rlike("^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL|FLOAT|DOUBLE)"), F.when(whole == F.floor(whole), "integer").otherwise("number"))


def _same(v: Column, kind: Column) -> Column:
    """A string that equal JSON values share: numbers by value, objects by sorted keys (numbers within arrays and objects as written)."""
    return F.when(kind.isin("integer", "number"), F.try_variant_get(v, "$", "double").cast("string")).otherwise(F.to_json(v))


def _literal(value: object) -> Column:
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return F.lit(float(value)).cast("string")
    return F.to_json(F.parse_json(F.lit(json.dumps(value, ensure_ascii=False))))


class Schemas:
    """Schemas by $id or name, for references from one to another: `#/...`, `name#/...` and `name`."""

    def __init__(self, schemas: Mapping[str, dict] | None = None, most_depth: int = MOST_DEPTH):
        self.named = dict(schemas or {})
        self.named |= {s["$id"].rsplit("/", 1)[-1]: s for s in self.named.values() if "$id" in s}
        self.most_depth = most_depth

    def violations(self, value: Column, schema: dict) -> Column:
        """Array of (path, keyword), one for each violation of `schema` by a VARIANT; paths as in JSON Pointer, "" is the whole.

        Sub-schemas of anyOf, oneOf, not and if count as a whole, those of allOf, then and else by themselves. SQL null (no JSON) is a
        violation of `type`. Unknown keywords are no assertions, as the specification has it; an unknown reference raises.
        """
        return F.when(value.isNull(), _when(F.lit(True), F.lit(""), "type")).otherwise(self._value(value, F.lit(""), schema, schema, ()))

    def _value(self, value: Column, path: Column, schema: dict | bool, root: dict, seen: tuple) -> Column:
        if isinstance(schema, bool):
            return _none() if schema else _when(F.lit(True), path, "false")
        return let(F.struct(value.alias("v"), F.schema_of_variant(value).alias("k"), path.alias("p")), lambda x: self._checked(x["v"], _type_of(x["k"], x["v"]), x["p"], schema, root, seen))

    def _checked(self, v: Column, t: Column, path: Column, schema: dict, root: dict, seen: tuple) -> Column:
        nested = {"$ref": self._ref, "properties": self._properties, "additionalProperties": self._additional, "patternProperties": self._pattern_properties, "items": self._items, "prefixItems": self._prefix_items}
        nested |= {"contains": self._contains, "allOf": self._all_of, "anyOf": self._any_of, "oneOf": self._one_of, "not": self._not, "if": self._if}
        found: list[Column] = []
        for keyword, rule in schema.items():
            if keyword in _SIMPLE:
                found.append(_when(_SIMPLE[keyword](v, t, rule), path, keyword))
            elif keyword in nested:
                found.append(nested[keyword](v, t, path, rule, schema, root, seen))
        return F.concat(*found) if found else _none()

    def _valid(self, v: Column, schema: dict | bool, root: dict, seen: tuple) -> Column:
        return F.size(self._value(v, F.lit(""), schema, root, seen)) == 0

    def _ref(self, v, t, path, rule, schema, root, seen):
        name, _, pointer = rule.partition("#")
        if name and name.rsplit("/", 1)[-1] not in self.named:
            raise KeyError(f"no schema named {name}")
        base = self.named[name.rsplit("/", 1)[-1]] if name else root
        step = lambda at, part: at[part.replace("~1", "/").replace("~0", "~")]
        target = reduce(step, [p for p in pointer.split("/") if p], base)
        if seen.count(id(target)) > self.most_depth:
            return _when(F.lit(True), path, "$ref")
        return self._value(v, path, target, base, (*seen, id(target)))

    def _properties(self, v, t, path, rule, schema, root, seen):
        each = []
        for name, inner in rule.items():
            at = F.try_variant_get(v, "$[" + json.dumps(name, ensure_ascii=False) + "]", "variant")
            here = F.concat(path, F.lit("/"), _key(F.lit(name)))
            each.append(let(F.struct(at.alias("v"), here.alias("p")), self._if_present(inner, root, seen)))
        return F.when(t == "object", F.concat(*each)).otherwise(_none()) if each else _none()

    def _if_present(self, inner: dict | bool, root: dict, seen: tuple) -> Callable[[Column], Column]:
        return lambda x: F.when(x["v"].isNotNull(), self._value(x["v"], x["p"], inner, root, seen)).otherwise(_none())

    def _entries(self, v, t, path, wanted: Callable[[Column], Column], inner, root, seen):
        """The violations of the members of an object whose key is wanted."""
        entries = F.filter(F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")), lambda e: wanted(e["key"]))
        found = F.flatten(F.transform(entries, lambda e: self._value(e["value"], F.concat(path, F.lit("/"), _key(e["key"])), inner, root, seen)))
        return F.when(t == "object", found).otherwise(_none())

    def _additional(self, v, t, path, rule, schema, root, seen):
        known, patterns = list(schema.get("properties", {})), list(schema.get("patternProperties", {}))
        other = lambda k: reduce(lambda a, b: a & b, [~k.isin(*known) if known else F.lit(True), *[~F.regexp_like(k, F.lit(p)) for p in patterns]])
        if rule is False:
            keys = F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))
            return _when((t == "object") & F.exists(keys, other), path, "additionalProperties")
        return self._entries(v, t, path, other, rule, root, seen)

    def _pattern_properties(self, v, t, path, rule, schema, root, seen):
        parts = [self._entries(v, t, path, lambda k, p=p: F.regexp_like(k, F.lit(p)), inner, root, seen) for p, inner in rule.items()]
        return F.concat(*parts) if parts else _none()

    def _items(self, v, t, path, rule, schema, root, seen):
        first = len(schema.get("prefixItems", []))
        check = lambda x, i: self._value(x, F.concat(path, F.lit("/"), (i + first).cast("string")), rule, root, seen)
        rest = F.try_variant_get(v, "$", "array<variant>")
        rest = F.slice(rest, first + 1, F.size(rest)) if first else rest
        return F.when(t == "array", F.flatten(F.transform(rest, check))).otherwise(_none())

    def _prefix_items(self, v, t, path, rule, schema, root, seen):
        at = lambda i: F.try_variant_get(v, f"$[{i}]", "variant")
        each = [F.when(at(i).isNotNull(), self._value(at(i), F.concat(path, F.lit(f"/{i}")), inner, root, seen)).otherwise(_none()) for i, inner in enumerate(rule)]
        return F.when(t == "array", F.concat(*each)).otherwise(_none()) if each else _none()

    def _contains(self, v, t, path, rule, schema, root, seen):
        hits = F.size(F.filter(F.try_variant_get(v, "$", "array<variant>"), lambda x: self._valid(x, rule, root, seen)))
        return _when((t == "array") & (hits < schema.get("minContains", 1)), path, "contains")

    def _all_of(self, v, t, path, rule, schema, root, seen):
        return F.concat(*[self._value(v, path, s, root, seen) for s in rule])

    def _any_of(self, v, t, path, rule, schema, root, seen):
        return _when(~reduce(lambda a, b: a | b, [self._valid(v, s, root, seen) for s in rule]), path, "anyOf")

    def _one_of(self, v, t, path, rule, schema, root, seen):
        return _when(reduce(lambda a, b: a + b, [self._valid(v, s, root, seen).cast("int") for s in rule]) != 1, path, "oneOf")

    def _not(self, v, t, path, rule, schema, root, seen):
        return _when(self._valid(v, rule, root, seen), path, "not")

    def _if(self, v, t, path, rule, schema, root, seen):
        branches = [self._value(v, path, schema[k], root, seen) if k in schema else _none() for k in ("then", "else")]
        return F.when(self._valid(v, rule, root, seen), branches[0]).otherwise(branches[1])


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _number(v: Column) -> Column:
    return F.try_variant_get(v, "$", "double")


def _is_number(t: Column) -> Column:
    return t.isin("integer", "number")


def _members(v: Column) -> Column:
    return F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))


def _elements(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _wrong_type(v: Column, t: Column, rule: str | list[str]) -> Column:
    allowed = {rule} if isinstance(rule, str) else set(rule)
    return ~F.coalesce(t.isin(*(allowed | ({"integer"} if "number" in allowed else set()))), F.lit(False))


def _repeated(v: Column, t: Column, rule: bool) -> Column:
    keys = F.transform(_elements(v), lambda x: _same(x, _type(x)))
    return (t == "array") & F.lit(rule) & (F.size(F.array_distinct(keys)) < F.size(keys))


#: keyword -> (value, type, rule) -> whether the value violates it. Null never counts as true.
_SIMPLE: dict[str, Callable[[Column, Column, object], Column]] = {
    "type": _wrong_type,
    "enum": lambda v, t, r: ~F.coalesce(_same(v, t).isin(*map(_literal, r)), F.lit(False)) if r else F.lit(True),
    "const": lambda v, t, r: ~F.coalesce(_same(v, t) == _literal(r), F.lit(False)),
    "minLength": lambda v, t, r: (t == "string") & (F.length(_text(v)) < r),
    "maxLength": lambda v, t, r: (t == "string") & (F.length(_text(v)) > r),
    "pattern": lambda v, t, r: (t == "string") & ~F.regexp_like(_text(v), F.lit(r)),
    "format": lambda v, t, r: (t == "string") & ~F.regexp_like(_text(v), F.lit(FORMATS[r])) if r in FORMATS else F.lit(False),
    "minimum": lambda v, t, r: _is_number(t) & (_number(v) < r),
    "maximum": lambda v, t, r: _is_number(t) & (_number(v) > r),
    "exclusiveMinimum": lambda v, t, r: _is_number(t) & (_number(v) <= r),
    "exclusiveMaximum": lambda v, t, r: _is_number(t) & (_number(v) >= r),
    "multipleOf": lambda v, t, r: _is_number(t) & (_number(v) / r != F.floor(_number(v) / r)),
    "required": lambda v, t, r: (t == "object") & (F.size(F.array_except(F.array(*map(F.lit, r)), _members(v))) > 0) if r else F.lit(False),
    "minProperties": lambda v, t, r: (t == "object") & (F.size(_members(v)) < r),
    "maxProperties": lambda v, t, r: (t == "object") & (F.size(_members(v)) > r),
    "minItems": lambda v, t, r: (t == "array") & (F.size(_elements(v)) < r),
    "maxItems": lambda v, t, r: (t == "array") & (F.size(_elements(v)) > r),
    "uniqueItems": _repeated,
}


def schema_violations(rows: DataFrame, key: list[str], value: str, schema: dict, schemas: Mapping[str, dict] | None = None) -> DataFrame:
    """(key columns, path, keyword): every violation of `schema` by the JSON text in column `value`; valid rows give none.

    Text that is no JSON, and null, violates `type`. Repeated rows are reported each; empty in, empty out.
    """
    found = Schemas(schemas).violations(F.try_parse_json(value), schema)
    return rows.select(*key, F.explode(found).alias("x")).select(*key, "x.path", "x.keyword")
