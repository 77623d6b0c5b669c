"""Contracts compiled to column expressions, against a plain evaluation of the same schemas."""

import json
import random
import re


from coursegrain.operators import contract_schemas, json_contracts

TREE = {
    "type": "object", "required": ["name"], "additionalProperties": False,
    "properties": {
        "name": {"type": "string", "minLength": 1}, "size": {"type": ["integer", "null"], "minimum": 0}, "kind": {"enum": ["a", "b", 3, True]},
        "children": {"type": "array", "items": {"$ref": "#"}}, "labels": {"type": "object", "additionalProperties": {"type": "string", "pattern": "^x"}},
        "note": {"oneOf": [{"type": "string"}, {"type": "object", "required": ["text"]}]},
    },
}
TREE["properties"]["children"]["items"] = {"$ref": "#/definitions/node"}
TREE["definitions"] = {"node": {k: v for k, v in TREE.items() if k != "definitions"}}


def kind_of(value):
    return {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null", int: "number", float: "number"}[type(value)]


def is_a(value, kind):
    return kind_of(value) == kind or (kind == "integer" and kind_of(value) == "number" and value == int(value))


def plain(value, schema, root, path=""):
    """(path, violation) pairs by plain recursion."""
    while "$ref" in schema:
        at = root
        for part in schema["$ref"].removeprefix("#/").split("/"):
            at = at[part]
        schema = at
    found, below = [], lambda n: f"{path}/{n}" if path else str(n)
    kinds = schema.get("type")
    if kinds:
        kinds = [kinds] if isinstance(kinds, str) else kinds
        if not any(is_a(value, k) for k in kinds):
            found.append((path, f"type: {' or '.join(kinds)}"))
    for word in ("const", "enum"):
        if word in schema:
            allowed = [schema[word]] if word == "const" else schema[word]
            if not any(kind_of(a) == kind_of(value) and a == value for a in allowed):
                found.append((path, f"{word}: {', '.join(map(str, allowed))}"))
    if isinstance(value, str):
        if "pattern" in schema and not re.search(schema["pattern"], value):
            found.append((path, f"pattern: {schema['pattern']}"))
        if len(value) < schema.get("minLength", 0):
            found.append((path, f"minLength: {schema['minLength']}"))
    if kind_of(value) == "number" and "minimum" in schema and value < schema["minimum"]:
        found.append((path, f"minimum: {schema['minimum']}"))
    if isinstance(value, dict):
        found += [(path, f"required: {n}") for n in schema.get("required", ()) if n not in value]
        known, rest = schema.get("properties", {}), schema.get("additionalProperties", True)
        extra = sorted(set(value) - set(known))
        if rest is False and extra:
            found.append((path, f"additionalProperties: {', '.join(extra)}"))
        for n in value:
            if n in known:
                found += plain(value[n], known[n], root, below(n))
            elif isinstance(rest, dict):
                found += plain(value[n], rest, root, below(n))
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            found += plain(x, schema["items"], root, below(i))
    if "oneOf" in schema:
        fits = [a for a in schema["oneOf"] if is_a(value, a["type"])]
        found += plain(value, fits[0], root, path) if fits else [(path, "oneOf: no alternative fits")]
    return found


def random_node(turns, depth):
    node = {"name": turns.choice(["n", "", 4, "long"]), "size": turns.choice([0, 2, -1, 1.5, 2.0, None, "x"]), "kind": turns.choice(["a", "c", 3, 4, True, False]), "note": turns.choice(["s", {"text": 1}, {}, 5, None])}
    node["labels"] = turns.choice([{}, {"p": "xx", "q": "y"}, {"p": 1}, []])
    if depth:
        node["children"] = turns.choice([[], "none", [random_node(turns, depth - 1) for _ in range(turns.randrange(3))], [1, None]])
    if turns.random() < 0.2:
        node["other"] = 1
    return {k: v for k, v in node.items() if turns.random() < 0.85}


def test_compiled_rules_equal_plain_recursion(spark):
    turns = random.Random(12)
    docs = [random_node(turns, 4) for _ in range(60)] + [[], "text", 3, {}]
    rows = [(n, json.dumps(d)) for n, d in enumerate(docs)] + [(100, "{"), (101, None), (102, "")]
    got = json_contracts.violations(spark.createDataFrame(rows, "path int, doc string").withColumnRenamed("path", "no"), TREE, ["no"]).collect()
    want = {(n, *v) for n, d in enumerate(docs) for v in plain(d, TREE, TREE)} | {(n, "", "json: not parseable") for n in (100, 101, 102)}
    assert {tuple(r) for r in got} == want and len(got) == sum(len(plain(d, TREE, TREE)) for d in docs) + 3
    assert json_contracts.violations(spark.createDataFrame([], "no int, doc string"), TREE, ["no"]).count() == 0


ENVELOPE = {"run_id": "cc:run:1", "export": "", "label": "", "source": {
    "source_lineage_key": "cc:lineage:1", "source_instance_key": "cc:source:1", "lineage_state": "resolved", "lineage_basis": "x", "source_name": "",
    "logical_fingerprint": {"algorithm": "sha256", "digest": "a" * 64, "scope": "s", "bytes": 1, "extensions": {}}, "transport_fingerprint": None, "observed_identity": {"new": 1}, "extensions": {},
}}


def test_unseen_kinds_pass_and_missing_keys_do_not(spark):
    known = {"entity_key": "cc:entity:1", "identity": {"quality": "fallback", "basis": "b", "source_lineage_key": "cc:lineage:1", "source_aliases": [], "extensions": {}}}
    unseen = known | {"kind": "vendor_container", "parent_entity_key": None, "children": [known | {"kind": "yet_another", "parent_entity_key": "cc:entity:1", "children": []}]}
    good = ENVELOPE | {"schema": "structure/1", "kind_counts": {"vendor_container": 1}, "tree": [unseen], "html_topics": [], "diagnostics": ["d", {}], "extensions": {}, "future": [1]}
    broken = json.loads(json.dumps(good))
    del broken["tree"][0]["children"][0]["entity_key"]
    rows = spark.createDataFrame([(1, json.dumps(good)), (2, json.dumps(broken))], "no int, doc string")
    got = json_contracts.violations(rows, contract_schemas.structure(), ["no"]).collect()
    assert [tuple(r) for r in got] == [(2, "tree/0/children/0", "required: entity_key")]


def test_every_registered_contract_compiles():
    for schema_id, made in contract_schemas.REGISTERED.items():
        schema = made()
        assert json_contracts.Compiled(schema).places and (schema_id == "progress/1" or schema["properties"]["schema"] == {"const": schema_id})
    shared = [made()["definitions"] for made in (contract_schemas.activities, contract_schemas.structure, contract_schemas.run)]
    assert all(d[n] == shared[0][n] for d in shared for n in ("fingerprint", "sourceIdentity", "identity"))


def test_only_definitions_that_contain_themselves_begin_rows(spark, monkeypatch):
    stored = []
    kept = json_contracts.stored_table
    monkeypatch.setattr(json_contracts, "stored_table", lambda df, purpose: stored.append(purpose) or kept(df, purpose))
    item = {"name": "", "status": "late", "started_at": None, "finished_at": 1, "artifact_paths": ["a", 2], "diagnostic_ids": [], "extensions": {}}
    rows = spark.createDataFrame([(1, json.dumps({"steps": [item]})), (2, "{")], "no int, doc string")
    got = {tuple(r) for r in json_contracts.violations(rows, contract_schemas.run(), ["no"]).collect()}
    assert not stored and {r for r in got if r[1]} == {
        (1, "steps/0", "required: notes"), (1, "steps/0/name", "minLength: 1"), (1, "steps/0/status", "enum: completed, skipped, failed, unresolved"),
        (1, "steps/0/finished_at", "type: string or null"), (1, "steps/0/artifact_paths/1", "type: string"),
    }
    assert (2, "", "json: not parseable") in got and len(got) == 6 + sum(1 for r in got if r[0] == 1 and not r[1])
    docs = [random_node(random.Random(n), 5) for n in range(20)]
    rows = spark.createDataFrame([(n, json.dumps(d)) for n, d in enumerate(docs)], "no int, doc string")
    got = json_contracts.violations(rows, TREE, ["no"]).collect()
    assert sorted(map(tuple, got)) == sorted((n, *v) for n, d in enumerate(docs) for v in plain(d, TREE, TREE)) and 0 < len(stored) <= 3


def test_empty_keys_and_quotes(spark):
    schema = {"type": "object", "properties": {"it's": {"enum": ["a'b", "c\\d"]}}, "additionalProperties": {"type": "array", "items": {"type": "string", "pattern": r"^\d'$"}}}
    docs = [{"": 1, "it's": "c\\d"}, {"": ["1'", "x"], "p": {"": 2}}, {"it's": "b", "p": [None, "2'"]}, {"p": [[]]}]
    rows = spark.createDataFrame([(n, json.dumps(d)) for n, d in enumerate(docs)], "no int, doc string")
    got = json_contracts.violations(rows, schema, ["no"]).collect()
    assert sorted(map(tuple, got)) == sorted((n, *v) for n, d in enumerate(docs) for v in plain(d, schema, schema))
