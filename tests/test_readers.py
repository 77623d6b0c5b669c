"""Odd packages, files and tags: one of them never ends a job, nor changes what the others give."""

import hashlib
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from coursegrain import session
from coursegrain.operators import blocks, findings, identity, rubrics, silver, xml, xml_index
from coursegrain.plans.fleet import Fleet
from coursegrain.sources import archives, artifacts, packages, sinks


def xml_files(spark, *texts):
    return spark.createDataFrame([("e", f"f{n}.xml", t) for n, t in enumerate(texts)], "export_id string, rel_path string, xml string")


def test_one_archive_is_read_by_many_tasks(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as made:
        for n in range(10_000):
            made.writestr(f"m/{n}.txt", f"member {n}")
    rows = archives.directory(spark, str(tmp_path))
    read = archives.contents(rows).select("rel_path", "content", F.spark_partition_id().alias("task")).collect()
    assert {(r["rel_path"], bytes(r["content"]).decode()) for r in read} == {(f"m/{n}.txt", f"member {n}") for n in range(10_000)}
    assert len({r["task"] for r in read}) > 1
    chosen = packages.scan_archives(spark, str(tmp_path), F.col("rel_path").isin("m/7.txt", "m/9999.txt")).collect()
    assert sorted(bytes(r["content"]) for r in chosen) == [b"member 7", b"member 9999"]


def test_an_archive_is_opened_once_in_a_run(spark, tmp_path):
    for name in "ab":
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as made:
            for n in range(50):
                made.writestr(f"{n}.txt", str(n))
    opened = []

    def opener(place):
        opened.append(place)
        return archives._open(place)

    rows = archives.directory(spark, str(tmp_path)).orderBy("path", "begin").select(archives._MEMBER).toArrow()
    got = list(archives.members(iter(rows.to_batches()), opener=opener))
    assert len(got) == 100 and len(opened) == 2 and all(r[5] is None for r in got)


def test_members_beyond_a_cell(spark, tmp_path):
    body = random.Random(2).randbytes(300_000) + bytes(700_000)
    methods = {"s": zipfile.ZIP_STORED, "d": zipfile.ZIP_DEFLATED, "b": zipfile.ZIP_BZIP2, "l": zipfile.ZIP_LZMA}
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as made:
        for name, method in methods.items():
            made.writestr(name, body, compress_type=method)
        made.writestr("empty", b"")
    rows = archives.directory(spark, str(tmp_path))
    got = {r["rel_path"]: r for r in archives.contents(rows, cell_bytes=1000).collect()}
    digest = hashlib.sha256(body).hexdigest()
    assert all(got[n]["sha256"] == digest and got[n]["content"] is None and got[n]["bytes"] == len(body) and got[n]["open_error"] is None for n in "sdb")
    assert got["l"]["open_error"] and bytes(got["empty"]["content"]) == b""
    pieces = archives.parts(rows.filter("rel_path in ('s', 'd', 'b', 'empty')"), 99_991).orderBy("part_no").collect()
    whole = {n: b"".join(bytes(r["content"]) for r in pieces if r["rel_path"] == n) for n in ("s", "d", "b", "empty")}
    assert whole == {"s": body, "d": body, "b": body, "empty": b""}
    assert archives.directory(spark, str(tmp_path)).limit(0).count() == 0


def test_receipts_of_written_files(spark, tmp_path):
    folder = str(tmp_path / "out")
    files = spark.createDataFrame([("a", "x/one.txt", b"1"), ("a", "two.json", b"{}" * 2_000_000), ("b", "three.md", None), ("b", "v.txt", b"v")], "export_id string, rel_path string, content binary")
    artifacts.write(files, folder)
    receipts = identity.receipts(artifacts.scan(spark, folder)).cache()
    want = {(r["export_id"], r["rel_path"]): hashlib.sha256(r["content"] or b"").hexdigest() for r in files.collect()}
    assert {(r["export_id"], r["rel_path"]): r["sha256"] for r in receipts.collect()} == want
    assert identity.verify_receipts(receipts, artifacts.scan(spark, folder)).count() == 0
    (tmp_path / "out/a/x/one.txt").write_text("2")
    os.rename(tmp_path / "out/b/v.txt", tmp_path / "out/b/w.txt")
    (tmp_path / "out/b/_draft-1").write_text("left by a lost task")
    problems = {(r["rel_path"], r["problem"]) for r in identity.verify_receipts(receipts, artifacts.scan(spark, folder)).collect()}
    assert problems == {("x/one.txt", "artifact checksum mismatch"), ("v.txt", "missing artifact")}
    with pytest.raises(Exception, match="unsafe artifact path"):
        artifacts.write(files.limit(1).withColumn("rel_path", F.lit("../x")), folder)


def test_long_tags(spark):
    long = ["<p " + "a" * 200_000 + ">x</p>", "<p class='" + "b " * 100_000 + "'>x</p>", "<p " + 'c="1" ' * 30_000 + ">x</p>", '<p title="never closed ' + "d" * 100_000]
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(long)], "id int, fragment string")
    kinds = blocks.token_rows(rows, ["id"]).filter("tag = 'p' and not is_end").groupBy("id").count().collect()
    assert {r["id"] for r in kinds} == {0, 1, 2}
    attributes = " ".join(f'a{n}="{n}"' for n in range(20_000))
    assert xml.tokens(xml_files(spark, f"<r {attributes}><s/></r>"), ["rel_path"]).filter("tag is not null").count() == 3


def archive(path, members):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for name, data in members.items():
            out.writestr(name, data)


def damage(path, name):
    """Flip bytes inside a member's data."""
    with zipfile.ZipFile(path) as source:
        info = source.getinfo(name)
    with open(path, "r+b") as raw:
        raw.seek(info.header_offset + 30 + len(name) + 5)
        raw.write(b"\xff\xff\xff\xff")


def test_archives(spark, tmp_path):
    turns = random.Random(1)
    noise = bytes(turns.randrange(256) for _ in range(5000))
    archive(str(tmp_path / "spring/C.zip"), {"imsmanifest.xml": "<manifest/>", "a.html": "<p>a</p>"})
    archive(str(tmp_path / "fall/C.zip"), {"imsmanifest.xml": "<manifest/>", "b.html": "<p>b</p>", "bad.bin": noise})
    damage(str(tmp_path / "fall/C.zip"), "bad.bin")
    (tmp_path / "text.zip").write_text("no archive")
    files = packages.scan_archives(spark, str(tmp_path))
    got = {(r["export_id"], r["rel_path"]): r for r in files.collect()}
    assert set(got) == {("spring/C", "imsmanifest.xml"), ("spring/C", "a.html"), ("fall/C", "imsmanifest.xml"), ("fall/C", "b.html"), ("fall/C", "bad.bin"), ("text", "")}
    assert {k for k, r in got.items() if r["open_error"]} == {("fall/C", "bad.bin"), ("text", "")}
    assert bytes(got["fall/C", "b.html"]["content"]) == b"<p>b</p>"
    fleet = Fleet(files)
    assert {r["export_id"]: r["open_error"] is None for r in fleet.packages.collect()} == {"spring/C": True, "fall/C": True, "text": False}
    assert [r["subject"] for r in findings.unreadable_members(fleet.unreadable).collect()] == ["bad.bin"]


def test_elements_see_markup_only(spark):
    text = (
        '<r><folder name="a > b"/><folder name="c"><body><![CDATA[<folder name="no"/> <!-- kept --> & x]]></body></folder>'
        "<!-- <folder name='gone'/> --><f:folder name='d' xmlns:f='u'></f:folder></r>"
    )
    rows = xml.elements(xml_files(spark, text), "folder", "_name string, body string, _corrupt_record string", ["rel_path"]).orderBy("pos").collect()
    assert [(r["e"]["_name"], r["e"]["body"]) for r in rows] == [("a > b", None), ("c", '<folder name="no"/> <!-- kept --> & x'), ("d", None)]


def test_elements_of_long_files(spark):
    body = "<c><folders>x</folders></c>" * 20_000
    text = f'<r><folder name="a">{body}</x:folder ><y:folder name="b"/><folder name="c">'
    assert [len(r[0]) for r in xml_files(spark, text).select(F.explode(xml.element_strings(F.col("xml"), "folder"))).collect()] == [len(body) + 17 + 12, 20]


def test_broken_files_give_no_rows(spark):
    files = xml_files(spark, "<r><item/><item></r>", "<r><item/></r>", "", "no xml")
    assert {r["rel_path"] for r in xml.well_formed(files).collect()} == {"f1.xml"}


def test_repeated_attribute_keeps_the_last(spark):
    files = xml_files(spark, '<release><condition_set resource_code="C"><condition a:quiz="1" b:quiz="2" x="a > b"/></condition_set></release>')
    assert silver.conditions(files).first()["attributes"] == {"quiz": "2", "x": "a > b"}


QUIZ = '<questestinterop><assessment id="1" ident="q" title="T">{}<section title="S"><item ident="i"><presentation><material><mattext>question</mattext></material></presentation></item></section></assessment></questestinterop>'


def test_quiz_instructions_are_its_own(spark):
    intro = "<assess_procextension><intro_message>intro</intro_message></assess_procextension>"
    own = "<rubric><flow_mat><material><mattext>own</mattext></material></flow_mat></rubric>"
    files = xml_files(spark, QUIZ.format(intro), QUIZ.format(own + intro), QUIZ.format(""), QUIZ.format("<rubric/>" + intro))
    got = {r["source_file"]: r["html"] for r in silver.quizzes(files).collect()}
    assert got == {"f0.xml": "intro", "f1.xml": "own", "f2.xml": "", "f3.xml": "intro"}


def test_nested_quiz_sections(spark):
    meta = lambda label, entry: f"<qti_metadatafield><fieldlabel>{label}</fieldlabel><fieldentry>{entry}</fieldentry></qti_metadatafield>"
    inner = f'<section title="Inner"><proc>{meta("qmd_numberofitems", 1)}</proc><item ident="a">{meta("qmd_questiontype", "Essay")}</item></section>'
    text = (
        f'<questestinterop><assessment><section title="Outer"><proc>{meta("qmd_numberofitems", 7)}{meta("qmd_weighting", 2)}</proc>{inner}<item ident="b">{meta("qmd_questiontype", "Short")}</item>'
        '<itemref linkrefid="c"/></section><section/><section title="Last"/></assessment></questestinterop>'
    )
    rows = silver.quiz_sections(xml_files(spark, text)).orderBy("section_no").collect()
    assert [(r["title"], r["candidate_count"], r["draw_count"], r["points_per_question"], r["question_types"]) for r in rows] == [
        ("Outer", 2, "1", "2", ["Short"]), ("Inner", 1, "1", "", ["Essay"]), ("Last", 0, "", "", []),
    ]


INDEXED = '<r a="0"><s:a x:k="1" k="2" t="&lt;&#233;">one<b/>two</s:a><![CDATA[<raw>]]><a><b>deep</b></a></r>'


def test_element_index(spark):
    text = INDEXED.replace("<r ", '<r xmlns:s="u" xmlns:x="v" ')
    rows = xml_index.index(xml_files(spark, text, "<r><a></r>", "", None), ["rel_path"]).orderBy("pre").collect()
    assert {r["rel_path"] for r in rows} == {"f0.xml"}
    assert [(r["pre"], r["post"], r["last"], r["depth"], r["parent"], r["tag"], r["content"]) for r in rows] == [
        (0, 4, 4, 1, None, "r", "<raw>"), (1, 1, 2, 2, 0, "a", "onetwo"), (2, 0, 2, 3, 1, "b", ""), (3, 3, 4, 2, 0, "a", ""), (4, 2, 4, 3, 3, "b", "deep"),
    ]
    assert rows[1]["attributes"] == {"k": "1", "t": "<é"}


def test_element_index_of_deep_and_long_files(spark):
    deep = "<d>" * 3000 + "x" * 200_000 + "</d>" * 3000
    wide = "<r>" + "<i/>" * 50_000 + "</r>"
    rows = xml_index.index(xml_files(spark, deep, wide), ["rel_path"])
    found = rows.groupBy("rel_path").agg(F.count("*").alias("n"), F.max("depth").alias("d"), F.max(F.length("content")).alias("c"), F.sum(F.col("last") - F.col("pre")).alias("inside")).orderBy("rel_path").collect()
    assert [tuple(r)[1:] for r in found] == [(3000, 3000, 200_000, 3000 * 2999 // 2), (50_001, 2, 0, 50_000)]


def exchanges(df):
    """Exchanges of the final plan that are really carried out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[: plan.find("Initial Plan")].count("+- Exchange ") if "Initial Plan" in plan else plan.count("Exchange ")


def test_quiz_family_moves_rows_once(spark):
    files = xml_files(spark, QUIZ.format(""), QUIZ.format("<rubric/>"))
    assert exchanges(silver.quiz_rollup(silver.quiz_sections(files))) <= 2
    assert exchanges(silver.quizzes(files)) <= 2


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_only_named_elements_become_rows(spark):
    files = xml_files(spark, INDEXED.replace("<r ", '<r xmlns:s="u" xmlns:x="v" '), "<r>" + "<b>1</b>x" * 3 + "</r>", "<r>", None)
    every = xml_index.index(files, ["rel_path"])
    some = xml_index.index(files, ["rel_path"], tags=("a", "r"))
    listed = lambda df: sorted(tuple(r)[:-2] + (sorted(r["attributes"].items()), r["content"]) for r in df.collect())
    assert listed(some) == listed(every.filter("tag in ('a', 'r')")) != []


def test_question_types_are_one_list_a_section(spark):
    sections = silver.quiz_sections(xml_files(spark, QUIZ.format("")))
    windows = [line for line in plan_of(sections).splitlines() if "Window [" in line]
    assert windows and not any("collect_list" in line for line in windows)
    twice = xml_files(spark, QUIZ.format("")).unionAll(xml_files(spark, QUIZ.format("")))
    assert [(r["title"], r["candidate_count"]) for r in silver.quiz_sections(twice).collect()] == [("S", 2), ("S", 2)]


def test_attributes_are_found_once(spark):
    files = xml_files(spark, '<release><condition_set><condition a:quiz="1" b:quiz="2" x="&lt; b"/><condition/></condition_set></release>')
    rows = silver.conditions(files)
    assert [r["attributes"] for r in rows.orderBy("condition_no").collect()] == [{"quiz": "2", "x": "< b"}, {}]
    assert plan_of(rows.select("attributes")).count(silver._ATTRIBUTE) == 1


def test_checklists_are_decoded_once(spark):
    text = (
        '<checklists><checklist resource_code="C"><category sort_order="2"><name>A</name><description><text>about</text></description><item sort_order="x"><name>a</name></item>'
        '<item sort_order="7"><description>d</description></item></category><category><name>B</name></category></checklist></checklists>'
    )
    entries = silver.checklist_entries(xml_files(spark, text))
    got = [tuple(r) for r in entries.select("category_order", "category_no", "item_order", "item_no", "entry", "text", "html").orderBy("category_no", "item_no").collect()]
    assert got == [(2, 0, -1, -1, "label", "A", "about"), (2, 0, 0, 0, "li", "a", ""), (2, 0, 7, 1, "li", "", "d"), (0, 1, -1, -1, "label", "B", "")]
    assert "Union" not in plan_of(entries)


def test_bands_decode_rubrics_once(spark):
    levels = '<levels><level level_id="1" name="Meets" sort_order="1"/><level level_id="2" name="Not Demonstrated"/></levels>'
    overall = '<overall_level name="Meets" range_start_value="75.5"/><overall_level name="Not Demonstrated" range_start_value="0"/>'
    files = xml_files(spark, f'<rubric id="R"><criteria_groups><criteria_group><level_set>{levels}</level_set></criteria_group></criteria_groups><overall_level_set><overall_levels>{overall}</overall_levels></overall_level_set></rubric>', '<rubric id="S"/>')
    rows = rubrics.stored_levels(rubrics.rubrics(files))
    bands = rubrics.level_bands(rubrics.levels(rows), rubrics.overall_levels(rows))
    assert sorted((r["rubric_id"], r["level_name"], r["score_band"]) for r in bands.collect()) == [("R", "Meets", "75.5%+"), ("R", "Not Demonstrated", "0%")]
    assert "from_xml" not in plan_of(bands)


def test_far_week_numbers(spark):
    rows = [("e", "module", f"Week {n}") for n in (1, 4, 2_000_000_000)]
    found = findings.week_gaps(spark.createDataFrame(rows, "export_id string, kind string, title string")).first()
    assert "weeks [2, 3, 5-1999999999] absent between 1 and 2000000000" in found["message"]


def test_removed_packages_leave_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1, "x", 0), ("b", 2, "y", 1), ("b", 2, "y", 1)], "export_id string, k int, v string, export_bucket int")
    rows.write.partitionBy("export_bucket").parquet(path)
    sinks.write_if_changed(spark, rows.filter("export_id = 'a'"), path)
    assert [tuple(r) for r in spark.read.schema(rows.schema).parquet(path).collect()] == [("a", 1, "x", 0)]
    assert os.listdir(tmp_path) == ["t"]


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(type("Session", (), {"conf": Conf()})(), "x")
