"""One whole package through every stage, against the published sample numbers."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import package_fixture as fixture
from coursegrain.operators import identity, rubrics
from coursegrain.plans.fleet import Fleet
from coursegrain.sources import packages, practice


@pytest.fixture(scope="module")
def fleet(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("exports"))
    fixture.write_folder(root, "sample")
    parquet = str(tmp_path_factory.mktemp("files")) + "/files"
    packages.scan_folders(spark, root).write.parquet(parquet)
    return Fleet(spark.read.parquet(parquet))


def test_inventory(fleet):
    assert {r.category: r.n for r in fleet.inventory.collect()} == {"d2l_xml": 9, "document": 3, "frontend_support": 1, "html": 12, "image": 3, "xml": 2}


def test_tree(fleet):
    rows = fleet.nodes.collect()
    assert Counter(r.kind for r in rows) == {"module": 3, "html_topic": 12, "content_file": 2, "dropbox_link": 3, "quiz_link": 2, "discussion_link": 2, "checklist_link": 1}
    assert sum(r.is_hidden for r in rows) == 3 and not any(r.href_missing for r in rows)
    assert {r.path for r in rows if r.title == "Case Packet PDF"} == {"Week 1 > Case Packet PDF"}
    by_pos = {r.pos: r for r in rows}
    assert all(r.depth == by_pos[r.parent_pos].depth + 1 for r in rows if r.parent_pos is not None)


def test_modules(fleet):
    assert sorted((r.role, r.title, r.week_no) for r in fleet.modules.collect()) == [("before", "Getting Started", 999), ("week", "Week 1", 1), ("week", "Week 2", 2)]


def test_activities_and_edges(fleet):
    kinds = Counter(r.kind for r in fleet.activities.collect())
    assert kinds == {"dropbox_folder": 4, "forum": 1, "discussion_topic": 3, "checklist": 1, "quiz": 1}
    edges = fleet.edges.collect()
    assert len(edges) == 19 - 0 and not [e for e in edges if e.resolved == "NO"]
    assert [e.source_name for e in edges if e.join_type == "linked_activity"] == ["Standalone Participation"]
    # invariant: every quicklink edge agrees with the number of manifest links
    assert {e.source_code: e.resolved for e in edges if e.join_type == "manifest_quicklink"}["CODE-A4"] == "none"


def test_findings(fleet):
    rows = fleet.findings.collect()
    assert Counter(r.severity for r in rows) == {"warnings": 2, "notes": 7}
    messages = {r.message for r in rows}
    assert "grade item with no linked activity: 'Standalone Participation'" in messages
    assert "gradebook countable total: 73 (set expected_total in --config to enforce)" in messages
    assert "images missing alt text across activities and pages: 1 (pages/week1-overview.html -> ../assets/equation-screenshot.png)" in messages


def test_rubric_grid(fleet):
    cells = rubrics.cells(fleet.rubrics).orderBy("criterion_order", "cell_no").collect()
    assert [(c.criterion, c.level_name, c.points, c.points_raw) for c in cells][:2] == [("Planning clarity", "Achieving", 10.0, "10.000000000"), ("Planning clarity", "Developing", 5.0, "5.000000000")]
    bands = rubrics.level_bands(rubrics.levels(fleet.rubrics), rubrics.overall_levels(fleet.rubrics)).collect()
    assert {b.level_name: b.score_band for b in bands} == {"Achieving": "90%+", "Developing": "50%+"}


def test_week_sections_and_unplaced(fleet):
    sections = {(r.module_title, r.section, r.page) for r in fleet.week_sections.collect()}
    assert ("Week 1", "learning_objectives", "Week 1 Learning Objectives") in sections
    # week 1 has its own materials page, so reading headings of its overview page stay in the overview
    assert {s for m, s, p in sections if p == "Week 1 Overview"} == {"overview"}
    assert sorted(r.name for r in fleet.unplaced.collect()) == ["Open Questions", "Peer Review"]


def test_practice_card(fleet):
    docs = fleet.files.filter("rel_path like '%.practice.json'").select("export_id", packages.as_text(F.col("content")).alias("doc"))
    card = practice.cards(docs, ["export_id"]).first()
    assert (card.title, card.practice_type, card["items"], card.scoring) == ("Sort it", "Sorting", 2, "5 pts")


def test_zip_equals_folder_and_corrupt_archive(spark, tmp_path):
    folders, zips = str(tmp_path / "f"), str(tmp_path / "z")
    fixture.write_folder(folders, "same")
    fixture.write_folder(folders, "changed", change={"links_d2l.xml": "<root>new</root>"})
    fixture.write_zip(zips, "same-zip")
    fixture.write_zip(zips, "wrapped", prefix="Course 1/")
    with open(os.path.join(zips, "broken.zip"), "w") as handle:
        handle.write("not a zip")
    files = packages.scan_folders(spark, folders).unionByName(packages.scan_archives(spark, zips))
    fleet = Fleet(files)
    prints = {r.export_id: r.digest for r in fleet.fingerprints.collect()}
    assert prints["same"] == prints["same-zip"] == prints["wrapped"] != prints["changed"]
    keys = {r.export_id: r for r in fleet.lineage.collect()}
    assert keys["broken"].lineage_basis == "unreadable_source_argument" and keys["broken"].lineage_state == "unresolved"
    notes = packages.reroot_notes(fleet.manifest_choice).collect()
    assert [n.subject for n in notes] == ["Course 1"]


def test_fingerprint_matches_plain_hash(spark, tmp_path):
    import hashlib
    import json

    rows = [("a", "é/b.txt", 3, "x" * 64), ("a", "A.txt", 5, "y" * 64), ("b", 'q".txt', 1, "z" * 64)]
    df = spark.createDataFrame(rows, "export_id string, rel_path string, bytes bigint, sha256 string")
    got = {r.export_id: r.digest for r in identity.fingerprints(df).collect()}
    for key in ("a", "b"):
        lines = [json.dumps([p, n, s], separators=(",", ":")) + "\n" for e, p, n, s in sorted(rows, key=lambda r: r[1]) if e == key]
        assert got[key] == hashlib.sha256("".join(lines).encode()).hexdigest()


def test_identity_of_structure_and_edges(fleet):
    nodes = fleet.structure_keys.collect()
    keys = {(r.export_id, r.pos): r.entity_key for r in nodes}
    assert len(nodes) == 25 and len(set(keys.values())) == 25
    assert all(r.parent_entity_key == (keys[r.export_id, r.parent_pos] if r.parent_pos is not None else None) for r in nodes)
    edges = fleet.relationships.collect()
    assert len(edges) == fleet.edges.count() and len({e.relationship_key for e in edges}) == len(edges)
    grades = [e for e in edges if e.join_type == "grade_item"]
    assert grades and all(e.endpoint_quality == "resolved_endpoints" for e in grades)


def test_course_model(fleet):
    import json

    rows = fleet.course_model.collect()
    assert [(r.path, r.part) for r in rows] == [("", 0)]
    course = json.loads(rows[0].doc)
    weeks = {w["title"]: w for w in course["weeks"]}
    assert "Week 1" in weeks and any(s["source_page"] == "Week 1 Learning Objectives" for s in weeks["Week 1"]["learning_objectives"])
    shown = {s["label"] for w in course["weeks"] for n in ("assignments", "discussions", "checklist") for s in w.get(n, [])}
    nowhere = [s["label"] for sections in course["unplaced_activities"].values() for s in sections]
    assert sorted(nowhere) == ["Open Questions", "Peer Review"] and not shown & set(nowhere) and shown
    assert course["diagnostics"]["lines"]
