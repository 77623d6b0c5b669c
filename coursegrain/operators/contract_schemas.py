"""The registered contracts as schema documents, put together from their shared parts.

Field names, kinds and patterns are fixed values of the formats.
"""

from __future__ import annotations

from typing import Any

TEXT, WHOLE, FLAG = {"type": "string"}, {"type": "integer"}, {"type": "boolean"}
FILLED = {"type": "string", "minLength": 1}
TEXT_OR_NULL, NUMBER_OR_NULL, FLAG_OR_NULL = ({"type": [k, "null"]} for k in ("string", "number", "boolean"))
COUNT = {"type": "integer", "minimum": 0}
FROM_ONE = {"type": "integer", "minimum": 1}
OPEN = {"type": "object"}
SHA256 = {"type": "string", "pattern": "^[0-9a-f]{64}$"}


def key(prefix: str) -> dict:
    return {"type": "string", "pattern": f"^cc:{prefix}:"}


def ref(name: str) -> dict:
    return {"$ref": f"#/definitions/{name}"}


def listed(items: dict) -> dict:
    return {"type": "array", "items": items}


def one_of(*words: str) -> dict:
    return {"enum": list(words)}


def record(needed: dict[str, Any], optional: dict[str, Any] | None = None, closed: bool = False) -> dict:
    """An object whose ``needed`` fields must be there; a closed one has no others than those named."""
    return {"type": "object", "required": list(needed), "properties": needed | (optional or {}), "additionalProperties": not closed}


FINGERPRINT = record({"algorithm": {"const": "sha256"}, "digest": SHA256, "scope": FILLED, "bytes": COUNT, "extensions": OPEN}, {"file_count": COUNT})
SOURCE = record({
    "source_lineage_key": key("lineage"), "source_instance_key": key("source"), "lineage_state": one_of("resolved", "unresolved"), "lineage_basis": FILLED, "source_name": TEXT,
    "logical_fingerprint": ref("fingerprint"), "transport_fingerprint": {"oneOf": [ref("fingerprint"), {"type": "null"}]}, "observed_identity": OPEN, "extensions": OPEN,
})
IDENTITY = record({
    "quality": one_of("durable_source_id", "scoped_source_id", "observed_reference", "fallback", "unresolved"), "basis": FILLED, "source_lineage_key": key("lineage"),
    "source_aliases": listed(record({"kind": TEXT, "value": TEXT})), "extensions": OPEN,
})
ENTITY = record({"entity_key": key("entity"), "identity": ref("identity")})
DIAGNOSTIC = {"oneOf": [TEXT, OPEN]}
_SHARED = {"fingerprint": FINGERPRINT, "sourceIdentity": SOURCE, "identity": IDENTITY, "entity": ENTITY, "diagnostic": DIAGNOSTIC}
_ENVELOPE = {"run_id": key("run"), "source": ref("sourceIdentity"), "export": TEXT, "label": TEXT}


def contract(schema_id: str, body: dict, definitions: dict) -> dict:
    fixed = {"schema": {"const": schema_id}}
    return body | {"required": ["schema", *body["required"]], "properties": fixed | body["properties"], "definitions": definitions}


def activities() -> dict:
    link = record({
        "quality": one_of("resolved_endpoints", "partial_endpoints", "evidence_only"), "source_lineage_key": key("lineage"), "basis": listed(TEXT), "duplicate_ordinal": COUNT, "extensions": OPEN,
    })
    relationship = record({"relationship_key": key("relationship"), "source_entity_key": TEXT_OR_NULL, "target_entity_key": TEXT_OR_NULL, "identity": link})
    lists = {n: listed(ref("entity")) for n in ("condition_sets", "dropbox_folders", "discussions", "checklists", "quizzes", "grade_items")}
    body = record(_ENVELOPE | {"export_identity": OPEN} | lists | {"joins": listed(ref("relationship")), "diagnostics": listed(ref("diagnostic")), "extensions": OPEN})
    return contract("activities/1", body, _SHARED | {"relationship": relationship})


def structure() -> dict:
    node = {"allOf": [ref("entity"), record({"kind": FILLED, "children": listed(ref("node")), "parent_entity_key": TEXT_OR_NULL})]}
    counts = {"type": "object", "additionalProperties": COUNT}
    body = record(_ENVELOPE | {"kind_counts": counts, "tree": listed(ref("node")), "html_topics": listed(ref("entity")), "diagnostics": listed(ref("diagnostic")), "extensions": OPEN})
    return contract("structure/1", body, _SHARED | {"node": node})


def run() -> dict:
    times = {"started_at": TEXT_OR_NULL, "finished_at": TEXT_OR_NULL}
    producer = record({
        "component": FILLED, "identity_state": one_of("release", "git", "unknown"), "version": TEXT_OR_NULL, "repository": TEXT_OR_NULL, "ref": TEXT_OR_NULL, "commit": TEXT_OR_NULL,
        "dirty": FLAG_OR_NULL, "extensions": OPEN,
    })
    used = record({"schema": FILLED, "schema_path": FILLED, "sha256": SHA256, "extensions": OPEN})
    step = record({"name": FILLED, "status": one_of("completed", "skipped", "failed", "unresolved")} | times | {n: listed(TEXT) for n in ("artifact_paths", "diagnostic_ids", "notes")} | {"extensions": OPEN})
    inside = FILLED | {"not": {"pattern": r"(^/|(^|/)\.\.(/|$))"}}
    artifact = record({"path": inside, "bytes": COUNT, "sha256": SHA256, "media_type": FILLED, "contract": TEXT_OR_NULL, "extensions": OPEN})
    body = record({"run_id": key("run"), "status": one_of("ok", "partial", "error")} | times | {
        "source": ref("sourceIdentity"), "producer": producer, "contracts": listed(used), "parameters": OPEN, "steps": listed(step), "emitted_files": listed(artifact),
        "receipt_path": FILLED, "diagnostics": listed(DIAGNOSTIC), "extensions": OPEN,
    })
    return contract("run/1", body, _SHARED)


def blueprint() -> dict:
    kinds = one_of("p", "li", "label", "practice", "visual", "dropdown", "embed", "image", "file", "hidden", "divider")
    piece = record({"text": TEXT, "href": TEXT}, closed=True)
    block = record({"kind": TEXT | kinds, "level": WHOLE, "runs": listed(ref("run"))}, {"blocks": ref("blocks"), "meta": {"type": "object", "additionalProperties": TEXT}}, closed=True)
    section = record({"label": TEXT, "blocks": ref("blocks")}, {"source_page": TEXT, "level": WHOLE}, closed=True)
    sections, blocks = listed(ref("labeled_section")), ref("blocks")
    week = record({"title": TEXT}, {"overview": blocks, "learning_objectives": blocks} | {n: sections for n in ("resources", "assignments", "discussions", "checklist", "other_sections")}, closed=True)
    front = record({n: blocks for n in ("course_description", "required_materials", "course_learning_outcomes", "course_introduction")}, closed=True)
    loose = record({}, {"assignments": sections, "discussions": sections}, closed=True)
    optional = {n: TEXT for n in ("template_reference", "course_number", "term")} | {"unplaced_activities": loose, "diagnostics": listed(TEXT)}
    body = record({"course_title": TEXT, "front_matter": front, "before_week_1": sections, "weeks": listed(week)}, optional, closed=True)
    return contract("blueprint/4", body, {"run": piece, "block": block, "blocks": listed(ref("block")), "labeled_section": section})


def rubrics() -> dict:
    level = record({"level_id": TEXT, "name": TEXT, "sort_order": WHOLE, "score_band": TEXT}, closed=True)
    cell = record({"level_id": TEXT, "level_name": TEXT, "points": NUMBER_OR_NULL, "points_raw": TEXT, "description": TEXT}, closed=True)
    criterion = record({"name": TEXT, "sort_order": WHOLE, "cells": listed(cell)}, closed=True)
    overall = record({"name": TEXT, "sort_order": WHOLE, "range_start_value": NUMBER_OR_NULL, "description": TEXT, "feedback": TEXT}, closed=True)
    rubric = record({n: TEXT for n in ("id", "resource_code", "name", "scoring_method")} | {
        "attributes": {"type": "object", "additionalProperties": TEXT}, "description": TEXT, "levels": listed(level), "criteria": listed(criterion), "overall_levels": listed(overall),
    }, closed=True)
    return contract("rubrics/1", record({"source_file": TEXT, "rubrics": listed(rubric), "diagnostics": listed(TEXT)}, closed=True), {})


def progress() -> dict:
    fixed = lambda word: {"const": word}
    outputs = (
        "markdown json docx workbook rubrics_json rubrics_unparsed rubrics_workbook rubrics_docx qa_report render_qa_dir docx_structure_report docx_structure_json status_report status_json run_identity".split()
    )
    counted = lambda *names: {n: COUNT for n in names}
    checks = record({}, counted("breaks", "warnings", "notes"), closed=True) | {"type": ["object", "null"]}
    issue = record({"step": TEXT, "status": one_of("failed", "degraded", "skipped"), "message": TEXT}, closed=True)
    delivery = record({"usable": FLAG, "empty": FLAG, "core_failures": listed(TEXT)}, closed=True)
    ended = {
        "message": TEXT, "bundle_dir": TEXT, "outputs": record({}, {n: TEXT_OR_NULL for n in outputs}, closed=True), "issues": listed(issue),
        "summary": record({}, counted("weeks", "rubrics", "diagnostics", "needs_review") | {"qa": checks}, closed=True), "delivery": delivery,
    }
    return {"oneOf": [
        record({"event": fixed("run_start"), "schema": fixed("progress/1"), "label": TEXT, "total": FROM_ONE, "steps": listed(TEXT)}, closed=True),
        record({"event": fixed("step_start"), "index": FROM_ONE, "total": FROM_ONE, "label": TEXT}, closed=True),
        record({"event": fixed("step_end"), "index": FROM_ONE, "status": one_of("ok", "error"), "seconds": {"type": "number", "minimum": 0}}, {"message": TEXT}, closed=True),
        record({"event": fixed("run_end"), "status": one_of("ok", "partial", "error")}, ended, closed=True),
    ]}


#: By schema id; an id that isn't here is unknown (see ``contracts.schema_state``).
REGISTERED = {"activities/1": activities, "structure/1": structure, "run/1": run, "blueprint/4": blueprint, "rubrics/1": rubrics, "progress/1": progress}
