"""JSON Schema contracts compiled to column expressions over Variant.

A contract is an ordinary schema document (``$ref``, ``allOf``, ``oneOf``, ``not``, types,
``const``, ``enum``, ``pattern``, bounds, ``required``, ``additionalProperties``, arrays).
Compiling it gives one expression per place where a new row has to begin.  What
lies in nested objects, arrays and open objects is checked inside the row; only a
definition that contains itself begins new rows, after ``FOLLOWED`` turns.  The
rows of a depth are checked together, whichever place they come from, and make
those of the next, until none is left.

Reading a value costs as much as is in it, so tests of objects and arrays only ask
for their keys or their length.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce
from itertools import count
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored_table

FOLLOWED = 2

_FOUND = "array<struct<path:string,violation:string>>"
_ROWS = "array<struct<path:string,place:int,node:string>>"


@dataclass
class Rules:
    """SQL of what a value breaks, one by one and as arrays, and of the rows that begin inside it; each part may be NULL."""

    ones: list[str] = field(default_factory=list)
    many: list[str] = field(default_factory=list)
    rows: list[str] = field(default_factory=list)
    #: numbers of the places of those rows
    places: set[int] = field(default_factory=set)

    def found(self) -> str | None:
        return _flat([f"array_compact(array({', '.join(self.ones)}))"] * bool(self.ones) + self.many)

    def inner(self) -> str | None:
        return _flat(self.rows)

    def add(self, other: Rules, wrap=lambda sql: sql) -> None:
        """All of ``other``, inside a condition or a loop."""
        self.many += [wrap(sql) for sql in [other.found()] if sql]
        self.rows += [wrap(sql) for sql in [other.inner()] if sql]
        self.places |= other.places


@dataclass(frozen=True)
class Value:
    """A value at a path below a variable; ``at`` is its path in the row's node, ``there`` whether it exists."""

    base: str
    path: tuple[str, ...] = ()
    at: tuple[str, ...] = ()
    there: str = "true"

    def get(self, kind: str = "variant") -> str:
        way = "$" + "".join(f'["{p}"]' if "'" in p else f"['{p}']" for p in self.path)
        return f"try_variant_get({self.base}, {_text(way)}, '{kind}')" if self.path or kind != "variant" else self.base

    def below(self, name: str, keys: str) -> Value:
        return Value(self.base, (*self.path, name), (*self.at, _text(name)), f"array_contains({keys}, {_text(name)})")

    def where(self, *more: str) -> str:
        """The path in the document: that of the row and that in the row's node."""
        pieces = (*self.at, *more)
        if not pieces:
            return "path"
        below = pieces[0] if len(pieces) == 1 else f"concat_ws('/', {', '.join(pieces)})"
        return f"CASE WHEN path = '' THEN {below} ELSE concat(path, '/', {below}) END"

    def breaks(self, said: str) -> str:
        return f"named_struct('path', {self.where()}, 'violation', {said})"

    def is_a(self, kind: str) -> str:
        """Whether the value has a JSON type; a whole number written with a point is an integer, too."""
        named = f"schema_of_variant({self.get()})"
        number = f"({named} IN ('BIGINT', 'INT', 'SMALLINT', 'TINYINT', 'DOUBLE', 'FLOAT') OR startswith({named}, 'DECIMAL'))"
        return {
            "object": f"{self.get('struct<>')} IS NOT NULL", "array": f"{self.get('array<struct<>>')} IS NOT NULL", "string": f"{named} = 'STRING'", "boolean": f"{named} = 'BOOLEAN'",
            "null": f"is_variant_null({self.get()})", "number": number, "integer": f"({self.get('double')} % 1 = 0 AND {number})",
        }[kind]

    def is_any(self, kinds: list[str]) -> str:
        """Objects and arrays first: the others look at all that the value holds."""
        return _any(self.is_a(k) for k in sorted(kinds, key=lambda k: k not in ("object", "array", "null")))

    def equals(self, wanted: Any) -> str:
        kind = {str: "string", bool: "boolean", int: "number", float: "number"}[type(wanted)]
        read, literal = {"string": (self.get("string"), _text(wanted) if kind == "string" else ""), "boolean": (self.get("boolean"), str(wanted).lower()), "number": (self.get("double"), f"double('{wanted}')")}[kind]
        return f"({read} = {literal} AND {self.is_a(kind)})"


class Place:
    """What is checked in one kind of row, and the kinds of rows that begin inside it."""

    rules = Rules()


class Compiled:
    """All places of a schema; place 0 is the document."""

    def __init__(self, schema: dict[str, Any]) -> None:
        self.schema = schema
        self.numbers: dict[str, int] = {}
        self.places: list[Place] = []
        self.fresh = count()
        self._place(schema)

    def _place(self, schema: dict[str, Any]) -> int:
        name = json.dumps(schema, sort_keys=True)
        if name not in self.numbers:
            self.numbers[name] = len(self.places)
            self.places.append(place := Place())
            place.rules = self._walk(schema, Value("n"), (), (name,))
        return self.numbers[name]

    def _resolved(self, schema: dict[str, Any], seen: tuple[str, ...]) -> tuple[dict[str, Any], tuple[str, ...]]:
        while "$ref" in schema:
            if schema["$ref"] in seen:
                raise ValueError(f"{schema['$ref']} contains itself without an array or object in between")
            seen = (*seen, schema["$ref"])
            schema = reduce(lambda at, key: at[key], schema["$ref"].removeprefix("#/").split("/"), self.schema)
        return schema, seen

    def _walk(self, schema: dict[str, Any], v: Value, seen: tuple[str, ...], turns: tuple[str, ...]) -> Rules:
        """Rules of ``schema`` for a value; ``turns`` are the schemas of the arrays and open objects around it."""
        schema, seen = self._resolved(schema, seen)
        rules = Rules()

        def check(broken: str, said: str) -> None:
            rules.ones.append(f"CASE WHEN {broken} AND {v.there} THEN {v.breaks(_text(said))} END")

        if "type" in schema:
            kinds = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
            check(f"NOT {v.is_any(kinds)}", f"type: {' or '.join(kinds)}")
        for word in ("const", "enum"):
            if word in schema:
                allowed = [schema[word]] if word == "const" else schema[word]
                check(f"NOT {_any(v.equals(a) for a in allowed)}", f"{word}: {', '.join(map(str, allowed))}")
        # the type is asked for after the rule, as presence is: a value in order needs no second look
        text, is_text = v.get("string"), v.is_a("string")
        if "pattern" in schema:
            check(f"NOT rlike({text}, {_text(schema['pattern'])}) AND {is_text}", f"pattern: {schema['pattern']}")
        if "pattern" in schema.get("not", {}):
            check(f"rlike({text}, {_text(schema['not']['pattern'])}) AND {is_text}", f"not: {schema['not']['pattern']}")
        if "minLength" in schema:
            check(f"length({text}) < {schema['minLength']} AND {is_text}", f"minLength: {schema['minLength']}")
        if "minimum" in schema:
            check(f"{v.get('double')} < {schema['minimum']} AND {v.is_a('number')}", f"minimum: {schema['minimum']}")
        for part in schema.get("allOf", ()):
            rules.add(self._walk(part, v, seen, turns))
        if "oneOf" in schema:
            chosen = [(self._guard(self._resolved(part, seen)[0], v), part) for part in schema["oneOf"]]
            check(f"NOT {_any(guard for guard, _ in chosen)}", "oneOf: no alternative fits")
            for guard, part in chosen:
                rules.add(self._walk(part, v, seen, turns), lambda sql, guard=guard: f"CASE WHEN {guard} AND {v.there} THEN {sql} END")
        rules.add(*self._object(schema, v, seen, turns))
        if "items" in schema:
            x, i = f"x{next(self.fresh)}", f"i{next(self.fresh)}"
            self._each(rules, schema["items"], v, v.get("array<variant>"), f"({x}, {i})", x, f"string({i})", turns)
        return rules

    def _object(self, schema: dict[str, Any], v: Value, seen: tuple[str, ...], turns: tuple[str, ...]):
        """Rules for the fields of an object, and the condition and names they need: its keys are read once."""
        keys = f"k{next(self.fresh)}"
        known, rest, inside = schema.get("properties", {}), schema.get("additionalProperties", True), Rules()
        if schema.get("required"):
            inside.many.append(f"transform(array_except({_texts(schema['required'])}, {keys}), m -> {v.breaks('concat(' + _text('required: ') + ', m)')})")
        if rest is False:
            extra = f"array_except({keys}, {_texts(known)})"
            inside.ones.append(f"CASE WHEN size({extra}) > 0 THEN {v.breaks(f'concat({_text("additionalProperties: ")}, array_join(array_sort({extra}), {_text(", ")}))')} END")
        for name, part in known.items():
            of = self._walk(part, v.below(name, keys), seen, turns)
            inside.ones += of.ones
            of.ones = []
            inside.add(of)
        if isinstance(rest, dict):
            e = f"e{next(self.fresh)}"
            entries = f"map_entries({v.get('map<string,variant>')})"
            others = f"filter({entries}, {e} -> NOT array_contains({_texts(known)}, {e}.key))" if known else entries
            self._each(inside, rest, v, others, e, f"{e}.value", f"{e}.key", turns)
        return inside, lambda sql: f"flatten(transform(array(map_keys({v.get('map<string,struct<>>')})), {keys} -> CASE WHEN {keys} IS NOT NULL THEN {sql} END))"

    def _each(self, rules: Rules, schema: dict[str, Any], v: Value, entries: str, variables: str, node: str, key: str, turns: tuple[str, ...]) -> None:
        """Rules for every entry of an array or open object: inside the row, or in rows of their own."""
        name = json.dumps(schema, sort_keys=True)
        # an empty key of the node itself adds nothing to a path, which only a new row can tell
        if turns.count(name) < FOLLOWED and (v.at or key.startswith("string(")):
            of = self._walk(schema, Value(node, (), (*v.at, key)), (), (*turns, name))
            rules.add(of, lambda sql: f"flatten(array_compact(transform({entries}, {variables} -> {sql})))")
        else:
            no = self._place(schema)
            rules.places.add(no)
            rules.rows.append(f"transform({entries}, {variables} -> named_struct('path', {v.where(key)}, 'place', {no}, 'node', to_json({node})))")

    @staticmethod
    def _guard(schema: dict[str, Any], v: Value) -> str:
        """Whether an alternative is meant: by its type and by what its properties are fixed to."""
        kinds = schema.get("type", [])
        kinds = [kinds] if isinstance(kinds, str) else kinds
        fixed = {n: p["const"] for n, p in schema.get("properties", {}).items() if "const" in p}
        tests = [v.is_any(kinds)] * bool(kinds) + [_any([Value(v.base, (*v.path, n)).equals(wanted)]) for n, wanted in fixed.items()]
        return f"({' AND '.join(tests)})" if tests else "true"


def _text(value: str) -> str:
    """A SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _texts(values) -> str:
    return f"array({', '.join(map(_text, values))})" if values else "cast(array() AS array<string>)"


def _any(tests) -> str:
    return f"coalesce({' OR '.join(tests)}, false)"


def _flat(parts: list[str]) -> str | None:
    """Arrays put together, without those that are NULL."""
    return f"flatten(array_compact(array({', '.join(parts)})))" if parts else None


def violations(docs: DataFrame, schema: dict[str, Any], keep: list[str], raw: str = "doc") -> DataFrame:
    """``keep``, path and violation of everything in the documents that breaks the schema.

    A document that can't be parsed breaks ``json`` at the empty path; a null one is
    taken for that, too.  Keys and kinds that the schema leaves open are accepted.
    Documents are told apart by ``keep``; equal ones give equal rows, once each.
    """
    compiled = Compiled(schema)
    rows = docs.select(F.struct(*keep).alias("_keys"), F.lit("").alias("path"), F.lit(0).alias("place"), F.try_parse_json(raw).alias("node"))
    found, possible = [], {0}
    while possible:
        rules = {no: compiled.places[no].rules for no in possible}
        broken = _per_place({no: r.found() for no, r in rules.items()}, _FOUND)
        possible = set().union(*[r.places for r in rules.values()])
        if possible:
            checked = stored_table(rows.select("_keys", broken.alias("found"), _per_place({no: r.inner() for no, r in rules.items()}, _ROWS).alias("inner")), "contract-level")
            found.append(checked.select("_keys", F.explode("found").alias("_f")))
            inner = checked.filter(F.size("inner") > 0)
            rows = inner.select("_keys", F.explode("inner").alias("_i")).select("_keys", "_i.path", "_i.place", F.parse_json("_i.node").alias("node"))
            if inner.isEmpty():
                break
        else:
            found.append(rows.select("_keys", F.explode(broken).alias("_f")))
    return reduce(DataFrame.unionByName, found).select("_keys.*", "_f.path", "_f.violation")


def _per_place(sql: dict[int, str | None], kind: str) -> Column:
    """The rules of each row's own place, about its node ``n``; one that couldn't be parsed breaks just that."""
    chain = " ".join(f"WHEN place = {no} THEN {text}" for no, text in sorted(sql.items()) if text)
    unread = "array(named_struct('path', path, 'violation', 'json: not parseable'))" if kind == _FOUND else "NULL"
    return F.expr(f"flatten(transform(array(node), n -> cast(CASE WHEN n IS NULL THEN {unread} {chain} END AS {kind})))")
