"""Tool files.  XML and JSON files are written from the documents inside each row and then read back
by the real extractors; the checking SQL states the expected result from the documents directly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import xml_safe
from ..operators import contracts, rubrics, silver, xml_index
from ..operators import findings as R
from ..operators import xml as X
from ..sources import practice
from .registry import Tables, query
from .scalars import sql_collapse

_LN = """
    ln AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS i, unnest(string_split(text, chr(10))) AS line FROM {documents}),
"""


def escaped(c: Column) -> Column:
    for raw, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(raw), F.lit(ref))
    return c


def xml_of(t: Tables, head: str, body: str, tail: str, path: str) -> DataFrame:
    """One file per document: ``body`` is a SQL expression over ``line`` (escaped), ``raw`` and ``i``."""
    lines = t.documents.select("doc_id", F.split(escaped(xml_safe(F.col("text"))), "\n").alias("e"), F.split("text", "\n").alias("r"))
    made = F.expr(f"concat({head}, array_join(transform(arrays_zip(e, r), (z, i) -> {body}), ''), {tail})")
    return lines.select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("export_id"), F.lit(path).alias("rel_path"), made.alias("xml"))


def grade_files(t: Tables) -> DataFrame:
    return xml_of(
        t, "'<d:grades xmlns:d=\"urn:x\"><categories><category id=\"c0\"><name>Essays</name></category><category id=\"c1\"><name> Tests </name></category></categories><items>'",
        "concat('<item id=\"', i, '\" identifier=\"I', i, '\" d:resource_code=\"D', doc_id, '-', i, '\" category_id=\"c', i % 3, '\"><name>', z.e, '</name><type_id>', 1 + i % 2, '</type_id>',"
        " '<scoring><out_of>', length(z.r), '</out_of><is_bonus>', i % 4 = 0, '</is_bonus></scoring></item>')",
        "'</items></d:grades>'", "grades_d2l.xml",
    )


@query("xml_grade_items", f"""
    WITH {_LN} done AS (SELECT 1)
    SELECT 'doc-' || doc_id AS export_id, cast(i AS string) AS id, 'D' || doc_id || '-' || i AS resource_code, regexp_replace(line, '^[ \\t\\r]+|[ \\t\\r]+$', '', 'g') AS name, cast(1 + i % 2 AS string) AS type_id,
           CASE i % 3 WHEN 0 THEN 'Essays' WHEN 1 THEN 'Tests' ELSE '' END AS category_name, cast(length(line) AS string) AS out_of, cast(i % 4 = 0 AS string) AS is_bonus
    FROM ln
""")
def xml_grade_items(t: Tables) -> DataFrame:
    return silver.grade_items(grade_files(t)).select("export_id", "id", "resource_code", "name", "type_id", "category_name", "out_of", "is_bonus")


@query("xml_malformed", """
    SELECT 'doc-' || doc_id AS export_id, 'R17' AS rule_id, 'breaks' AS severity, 'file' AS subject_kind, 'grades_d2l.xml' AS subject, 'grades_d2l.xml is not well-formed XML' AS message
    FROM {documents} WHERE lang <> 'en'
""")
def xml_malformed(t: Tables) -> DataFrame:
    broken = t.documents.select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("export_id"), F.lit("grades_d2l.xml").alias("rel_path"),
        F.concat(F.lit("<grades><items><item><name>"), escaped(xml_safe(F.col("text"))), F.when(F.col("lang") == "en", F.lit("</name></item></items></grades>")).otherwise(F.lit("</item></items></grades>"))).alias("xml"),
    )
    return R.malformed_xml(X.malformed(broken, ["export_id", "rel_path"]))


@query("condition_refs", f"""
    WITH {_LN}
    c AS (SELECT doc_id, i, 'Q' || length(line) AS quiz, CASE WHEN i % 2 = 0 THEN '' ELSE 'O' || i END AS grade_object, 'G' || i AS grp FROM ln)
    SELECT 'doc-' || doc_id AS export_id, cast(i AS int) AS set_no, 'D' || doc_id || '-' || i AS resource_code, 0 AS ref_no, 'quiz' AS ref_kind, quiz AS ref_value FROM c
    UNION ALL SELECT 'doc-' || doc_id, i, 'D' || doc_id || '-' || i, 2, 'grade_object', grade_object FROM c WHERE grade_object <> ''
    UNION ALL SELECT 'doc-' || doc_id, i, 'D' || doc_id || '-' || i, 3, 'group', grp FROM c
""")
def condition_refs(t: Tables) -> DataFrame:
    files = xml_of(
        t, "'<release>'",
        "concat('<condition_set resource_code=\"D', doc_id, '-', i, '\" tool=\"x\"><conditions><condition condition_type=\"105\" operator=\"and\" group=\"G', i, '\" quiz=\"Q', length(z.r),"
        " '\" x:grade_object=\"', if(i % 2 = 0, '', concat('O', i)), '\" other=\"', z.e, '\"/></conditions></condition_set>')",
        "'</release>'", "conditionalrelease_d2l.xml",
    )
    refs = silver.condition_references(silver.conditions(files))
    return refs.select("export_id", "set_no", "resource_code", "ref_no", "ref_kind", "ref_value")


_SENT = """
    sn AS (SELECT doc_id, i, unnest(range(len(string_split(line, '. ')))) AS j, unnest(string_split(line, '. ')) AS sent FROM ln)
"""
_TRIM = "regexp_replace(%s, '^[ \\t\\r]+|[ \\t\\r]+$', '', 'g')"


@query("checklist_entries", f"""
    WITH {_LN} {_SENT}
    SELECT 'doc-' || doc_id AS export_id, 'CL-' || doc_id AS resource_code, cast(CASE WHEN i % 5 = 0 THEN 0 ELSE length(line) % 7 END AS int) AS category_order, cast(i AS int) AS category_no, -1 AS item_order, -1 AS item_no, 'label' AS entry, {_TRIM % 'line'} AS text FROM ln
    UNION ALL SELECT 'doc-' || doc_id, 'CL-' || doc_id, CASE WHEN i % 5 = 0 THEN 0 ELSE length(line) % 7 END, i, 100 - j, j, 'li', {_TRIM % 'sent'} FROM sn JOIN ln USING (doc_id, i)
""")
def checklist_entries(t: Tables) -> DataFrame:
    files = xml_of(
        t, "concat('<checklists><checklist id=\"1\" resource_code=\"CL-', doc_id, '\"><name>List</name>')",
        "concat('<category sort_order=\"', if(i % 5 = 0, 'first', string(length(z.r) % 7)), '\"><name>', z.e, '</name>',"
        " array_join(transform(split(z.e, '[.] '), (s, j) -> concat('<item sort_order=\"', 100 - j, '\"><name>', s, '</name></item>')), ''), '</category>')",
        "'</checklist></checklists>'", "checklist_d2l.xml",
    )
    return silver.checklist_entries(files).select("export_id", "resource_code", "category_order", "category_no", "item_order", "item_no", "entry", "text")


def quiz_files(t: Tables) -> DataFrame:
    def meta(label: str, value: str) -> str:
        return f"'<qti_metadatafield><fieldlabel>{label}</fieldlabel><fieldentry>', {value}, '</fieldentry></qti_metadatafield>'"

    return xml_of(
        t, "'<questestinterop><assessment title=\"Quiz\">'",
        f"concat('<section title=\"', if(i % 4 = 1, '', concat('Part ', i)), '\"><sectionproc_extension>', {meta('qmd_numberofitems', 'if(i % 3 = 0, string(length(z.r) % 11), if(i % 3 = 1, concat(length(z.r) % 5, chr(46), 0), if(i % 6 = 2, \"many\", \"\")))')}, {meta('qmd_weighting', '5')}, '</sectionproc_extension>',"
        f" array_join(transform(split(z.e, '[.] '), (s, j) -> if(j % 4 = 3, '<itemref linkrefid=\"q\"/>', concat('<item ident=\"q', j, '\"><itemmetadata>', {meta('qmd_questiontype', 'if(length(s) % 2 = 0, \"Multiple Choice\", \"True/False\")')}, {meta('qmd_weighting', '1')}, '</itemmetadata></item>'))), ''), '</section>')",
        "'</assessment></questestinterop>'", "quiz_d2l_1.xml",
    )


_SECTIONS = f"""
    {_LN} esc AS (SELECT doc_id, i, line, replace(replace(replace(replace(line, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS e FROM ln),
    sn AS (SELECT doc_id, i, unnest(range(len(string_split(e, '. ')))) AS j, unnest(string_split(e, '. ')) AS s FROM esc),
    sec AS (SELECT ln.doc_id, ln.i, CASE WHEN ln.i % 4 = 1 THEN '' ELSE 'Part ' || ln.i END AS title, CASE WHEN ln.i % 3 = 0 THEN cast(length(line) % 11 AS string) WHEN ln.i % 3 = 1 THEN (length(line) % 5) || '.0' WHEN ln.i % 6 = 2 THEN 'many' ELSE '' END AS draw,
                   (SELECT count(*) FROM sn WHERE sn.doc_id = ln.doc_id AND sn.i = ln.i) AS cand FROM ln)
"""


@query("quiz_sections", f"""
    WITH {_SECTIONS},
    ty AS (SELECT doc_id, CASE WHEN length(s) % 2 = 0 THEN 'Multiple Choice' ELSE 'True/False' END AS t, count(*) AS n FROM sn WHERE j % 4 <> 3 GROUP BY ALL),
    sm AS (SELECT doc_id, string_agg(t || ': ' || n, '; ' ORDER BY t) AS question_types FROM ty GROUP BY doc_id)
    SELECT 'doc-' || sec.doc_id AS export_id, count(*) AS sections, cast(sum(cand) AS bigint) AS candidates, cast(coalesce(sum(floor(try_cast(draw AS double))), 0) AS bigint) AS drawn, max(coalesce(question_types, '')) AS question_types
    FROM sec LEFT JOIN sm ON sec.doc_id = sm.doc_id GROUP BY ALL
""")
def quiz_sections(t: Tables) -> DataFrame:
    return silver.quiz_rollup(silver.quiz_sections(quiz_files(t))).drop("rel_path")


@query("quiz_draw", f"""
    WITH {_SECTIONS}
    SELECT 'doc-' || doc_id AS export_id, 'R03' AS rule_id, 'breaks' AS severity, 'quiz_section' AS subject_kind, title AS subject,
           'quiz ''Quiz'' section ''' || title || ''': ' || CASE WHEN draw = 'many' THEN 'invalid draw count ''many''' ELSE 'draws ' || cast(floor(cast(draw AS double)) AS bigint) || ' from ' || cand || ' candidates' END AS message
    FROM sec WHERE draw = 'many' OR try_cast(draw AS double) > cand
""")
def quiz_draw(t: Tables) -> DataFrame:
    return R.quiz_draws(silver.quiz_sections(quiz_files(t)).withColumn("quiz", F.lit("Quiz")))


def rubric_files(t: Tables) -> DataFrame:
    def cell(level: int, points: str) -> str:
        return f"'<cell level_id=\"L{level}\" cell_value=\"', {points}, '\"><description><text>&lt;p&gt;', z.e, '&lt;/p&gt;&lt;p&gt;level {level}&lt;/p&gt;</text></description></cell>'"

    def overall(name: str, order: int, start: str) -> str:
        return f"<overall_level name=\"{name}\" sort_order=\"{order}\" range_start_value=\"{start}\"><description><text>About {name}</text></description></overall_level>"

    return xml_of(
        t, "concat('<rubrics><rubric id=\"RUB-', doc_id, '\" name=\"Rubric ', doc_id, '\"><criteria_groups><criteria_group><level_set><levels><level level_id=\"L1\" name=\"Exceeds\" sort_order=\"1\"/>"
        "<level level_id=\"L2\" name=\"Meets\" sort_order=\"2\"/><level level_id=\"L3\" name=\"Not Demonstrated\" sort_order=\"3\"/></levels></level_set><criteria>')",
        f"concat('<criterion name=\"C', i, '\" sort_order=\"', length(z.r) % 9, '\"><cells>', {cell(1, 'if(i % 3 = 0, \"\", concat(length(z.r), \".000\"))')}, {cell(2, 'if(i % 3 = 1, \"\", concat(i, \".50\"))')}, {cell(9, chr(39) + 'n/a' + chr(39))}, '</cells></criterion>')",
        f"'</criteria></criteria_group></criteria_groups><overall_level_set><overall_levels>{overall('Exceeds', 1, '90.000')}{overall('Meets', 2, '75.5')}{overall('Not Demonstrated', 3, '0')}</overall_levels></overall_level_set></rubric></rubrics>'",
        "rubrics_d2l.xml",
    )


@query("rubric_cells", f"""
    WITH {_LN}
    c AS (SELECT doc_id, i, line, 1 AS lv, 'Exceeds' AS level_name, CASE WHEN i % 3 = 0 THEN '' ELSE length(line) || '.000' END AS raw FROM ln UNION ALL SELECT doc_id, i, line, 2, 'Meets', CASE WHEN i % 3 = 1 THEN '' ELSE i || '.50' END FROM ln UNION ALL SELECT doc_id, i, line, 9, '', 'n/a' FROM ln),
    d AS (SELECT *, {sql_collapse("line")} AS flat FROM c)
    SELECT 'doc-' || doc_id AS export_id, 'RUB-' || doc_id AS rubric_id, 'C' || i AS criterion, cast(length(line) % 9 AS int) AS criterion_order, 'L' || lv AS level_id, level_name, try_cast(raw AS double) AS points, raw AS points_raw,
           CASE WHEN flat = '' THEN '' ELSE flat || chr(10) END || 'level ' || lv AS description
    FROM d
""")
def rubric_cells(t: Tables) -> DataFrame:
    return rubrics.cells(rubrics.rubrics(rubric_files(t))).select("export_id", "rubric_id", "criterion", "criterion_order", "level_id", "level_name", "points", "points_raw", "description")


@query("rubric_bands", """
    SELECT 'doc-' || doc_id AS export_id, 'RUB-' || doc_id AS rubric_id, level_name, cast(sort_order AS int) AS sort_order, score_band FROM {documents},
           (VALUES ('Exceeds', 1, '90%+'), ('Meets', 2, '75.5%+'), ('Not Demonstrated', 3, '0%')) v(level_name, sort_order, score_band)
""")
def rubric_bands(t: Tables) -> DataFrame:
    rows = rubrics.stored_levels(rubrics.rubrics(rubric_files(t)))  # files are decoded once
    return rubrics.level_bands(rubrics.levels(rows), rubrics.overall_levels(rows)).select("export_id", "rubric_id", "level_name", "sort_order", "score_band")


@query("rubric_pivot", f"""
    WITH {_LN} d AS (SELECT *, {sql_collapse("line")} AS flat FROM ln)
    SELECT 'doc-' || doc_id AS export_id, 'C' || i AS criterion, CASE WHEN flat = '' THEN '' ELSE flat || chr(10) END || 'level 1' AS "Exceeds", CASE WHEN flat = '' THEN '' ELSE flat || chr(10) END || 'level 2' AS "Meets",
           CASE WHEN i % 3 = 0 THEN i || '.50' ELSE cast(length(line) AS string) END AS points
    FROM d
""")
def rubric_pivot(t: Tables) -> DataFrame:
    return rubrics.pivot_grid(rubrics.cells(rubrics.rubrics(rubric_files(t))), ["Exceeds", "Meets"]).select("export_id", "criterion", "Exceeds", "Meets", "points")


@query("practice_cards", f"""
    WITH d AS (SELECT doc_id, lang, {sql_collapse("text")} AS flat, len(string_split(text, chr(10))) AS q, doc_id % 9 AS ty FROM {{documents}})
    SELECT doc_id, lang = 'de' AS unreadable, CASE WHEN lang = 'de' THEN 'Untitled Creator+ practice' ELSE 'Set ' || doc_id || ' & more' END AS title,
           CASE WHEN lang = 'de' THEN 'Creator+ practice' ELSE CASE ty WHEN 0 THEN 'Sorting' WHEN 1 THEN 'Sequencing' WHEN 2 THEN 'Hotspot' WHEN 3 THEN 'Quick quiz' WHEN 4 THEN 'Quick quiz - legacy dropdown' WHEN 5 THEN 'Quick quiz - single choice' WHEN 6 THEN 'Quick quiz - multi-select' WHEN 7 THEN 'Quick quiz - fill-in-the-blank' ELSE 'Creator+ type 8' END END AS practice_type,
           CASE WHEN lang = 'de' THEN 0 ELSE cast(q AS int) END AS questions, CASE WHEN lang = 'de' THEN NULL WHEN lang = 'fr' THEN 'Not scored' ELSE (q || ' pts') END AS scoring,
           CASE WHEN lang = 'de' THEN '' WHEN flat = '' THEN 'Instructions=do it' ELSE 'Description=' || flat || '|Instructions=do it' END AS prompts
    FROM d
""")
def practice_cards(t: Tables) -> DataFrame:
    lines = F.split("text", "\n")
    doc = F.struct(
        F.concat(F.lit("<b>Set "), F.col("doc_id").cast("string"), F.lit("</b> &amp; more")).alias("title"), (F.col("doc_id") % 9).alias("type"), F.col("doc_id").alias("id"),
        escaped(F.col("text")).alias("description"), F.lit("do it").alias("customInstructions"), F.lit("DO IT").alias("questionText"),
        F.transform(lines, lambda s: F.struct(F.lit(" Do  it ").alias("text"))).alias("questions"), (F.col("lang") != "fr").alias("hasScoring"), F.size(lines).cast("double").alias("scorePoints"),
    )
    docs = t.documents.select("doc_id", F.when(F.col("lang") == "de", F.concat(F.lit("{"), "text")).otherwise(F.to_json(doc)).alias("doc"))
    shown = F.array_join(F.transform("prompts", lambda p: F.concat(p["label"], F.lit("="), p["text"])), "|")
    return practice.cards(docs, ["doc_id"]).select("doc_id", "unreadable", "title", "practice_type", "questions", "scoring", shown.alias("prompts"))


@query("quarantine_split", """
    SELECT doc_id, lang <> 'en' AS quarantined, CASE WHEN lang = 'en' THEN cast(len(string_split(text, chr(10))) AS int) ELSE 0 END AS n_entries FROM {documents}
""")
def quarantine_split(t: Tables) -> DataFrame:
    good = F.to_json(F.struct(F.split("text", "\n").alias("rubrics")))
    docs = t.documents.select("doc_id", F.when(F.col("lang") == "en", good).when(F.col("lang") == "fr", F.lit('{"rubrics": "none"}')).otherwise(F.concat(F.lit('{"rubrics": ['), "text")).alias("doc"))
    return contracts.split_quarantine(docs, "rubrics").select("doc_id", "quarantined", "n_entries")


@query("contract_check", """
    WITH e AS (SELECT event_id, event_type, value, user_id % 4 AS m FROM {events})
    SELECT event_id, 'run_id: pattern' AS violation FROM e WHERE m = 1
    UNION ALL SELECT event_id, 'kind: not allowed' FROM e WHERE event_type = 'error'
    UNION ALL SELECT event_id, 'value: minimum' FROM e WHERE value < 10
    UNION ALL SELECT event_id, 'label: required' FROM e WHERE m = 2
    UNION ALL SELECT event_id, 'unknown keys: extra' FROM e WHERE m = 3
""")
def contract_check(t: Tables) -> DataFrame:
    m = F.col("user_id") % 4
    doc = F.to_json(F.struct(
        F.lit("activities/1").alias("schema"), F.when(m == 1, F.lit("run-1")).otherwise(F.concat(F.lit("cc:run:"), F.col("user_id").cast("string"))).alias("run_id"),
        F.col("event_type").alias("kind"), "value", F.when(m != 2, F.lit("x")).alias("label"), F.when(m == 3, F.lit(1)).alias("extra"), "props",
    ))
    contract = contracts.Contract(
        "activities/1", required=("schema", "run_id", "label"), enums={"kind": ("view", "click", "purchase", "signup")}, patterns={"run_id": r"^cc:run:\d+$"},
        minimums={"value": 10.0}, closed_keys=("schema", "run_id", "kind", "value", "label", "props"),
    )
    return contracts.violations(t.events.select("event_id", doc.alias("doc")), contract, ["event_id"])


_FLAT = _TRIM % "line"


@query("xml_folders", f"""
    WITH {_LN} done AS (SELECT 1)
    SELECT 'doc-' || doc_id AS export_id, cast(i AS int) AS pos, 'F' || i AS id, 'a > b ' || i AS name, 'D' || doc_id || '-' || i AS resource_code, CASE i % 3 WHEN 0 THEN '' ELSE 'file' END AS submission_type, 'group' AS folder_type,
           cast(length(line) AS string) AS out_of, 'G' || i AS grade_item_code, CASE i % 2 WHEN 0 THEN 'new' ELSE 'old' END AS date_due, CASE i % 4 WHEN 0 THEN 'True' ELSE '' END AS is_hidden, 'R' || i || ',R0' AS rubric_ids, {_FLAT} AS html FROM ln WHERE i % 5 <> 4
    UNION ALL SELECT 'doc-' || doc_id, i, 'F' || i, 'empty', '', '', '', '', '', '', '', '', '' FROM ln WHERE i % 5 = 4
""")
def xml_folders(t: Tables) -> DataFrame:
    """Assignment folders: a ">" in an attribute, due date as element or attribute, self-closing ones, texts as CDATA."""
    files = xml_of(
        t, "'<d:dropbox xmlns:d=\"urn:x\"><!-- <folder/> -->'",
        "if(i % 5 = 4, concat('<folder id=\"F', i, '\" name=\"empty\"/>'), concat('<d:folder id=\"F', i, '\" name=\"a > b ', i, '\" d:resource_code=\"D', doc_id, '-', i, '\" submission_type=\"', if(i % 3 = 0, '', 'file'), '\" folder_type=\"group\" out_of=\"', length(z.r), '\" grade_item=\"G', i, '\" is_hidden=\"', if(i % 4 = 0, 'True', ''), '\"', if(i % 2 = 0, '', ' date_due=\"old\"'), '>',"
        " if(i % 2 = 0, '<date_due>new</date_due>', ''), '<instructions><text>', if(i % 2 = 0, z.e, concat('<![CDATA[', replace(z.r, ']]>', ''), ']]>')), '</text></instructions><associations><rubric>R', i, '</rubric><rubric>R0</rubric></associations></d:folder>'))",
        "'</d:dropbox>'", "dropbox_d2l.xml",
    )
    rows = silver.dropbox_folders(files)
    columns = ["export_id", "pos", "id", "name", "resource_code", "submission_type", "folder_type", "out_of", "grade_item_code", "date_due", "is_hidden", "rubric_ids", "html"]
    return rows.withColumns({"rubric_ids": F.array_join("rubric_ids", ","), "pos": F.col("pos").cast("int")}).select(*columns)


@query("xml_discussions", f"""
    WITH {_LN} done AS (SELECT 1)
    SELECT 'doc-' || doc_id AS export_id, 'forum' AS kind, 'FO1' AS id, 'Talk & more' AS name, '' AS parent_id, '' AS out_of, '' AS requires_approval, '' AS must_post_to_participate, '' AS html FROM {{documents}}
    UNION ALL SELECT 'doc-' || doc_id, 'discussion_topic', 'T' || i, 'Topic ' || i, 'FO1', cast(length(line) AS string), CASE i % 2 WHEN 0 THEN 'yes' ELSE '' END, 'no', {_FLAT} FROM ln
""")
def xml_discussions(t: Tables) -> DataFrame:
    files = xml_of(
        t, "'<discussion><forum id=\"FO1\"><content><title>Talk &amp; more</title></content><topics>'",
        "concat('<topic id=\"T', i, '\"><content><title>Topic ', i, '</title><description><text>', z.e, '</text></description></content><properties><score_out_of>', length(z.r), '</score_out_of>',"
        " if(i % 2 = 0, '<requires_approval>yes</requires_approval>', ''), '<must_post_to_participate>no</must_post_to_participate></properties></topic>')",
        "'</topics></forum></discussion>'", "discussion_d2l_1.xml",
    )
    return silver.discussions(files).select("export_id", "kind", "id", "name", "parent_id", "out_of", "requires_approval", "must_post_to_participate", "html")


@query("xml_checklists", """
    SELECT 'doc-' || doc_id AS export_id, 'checklist' AS kind, 'C' || doc_id AS id, 'List ' || lang AS name, 'CL-' || doc_id AS resource_code FROM {documents}
""")
def xml_checklists(t: Tables) -> DataFrame:
    made = F.concat(
        F.lit('<checklists><checklist id="C'), F.col("doc_id").cast("string"), F.lit('" x:resource_code="CL-'), F.col("doc_id").cast("string"), F.lit('" xmlns:x="u"><name>List '), "lang",
        F.lit("</name><category><name>"), escaped(xml_safe(F.col("text"))), F.lit("</name></category></checklist></checklists>"),
    )
    files = t.documents.select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("export_id"), F.lit("checklist_d2l.xml").alias("rel_path"), made.alias("xml"))
    return silver.checklists(files).select("export_id", "kind", "id", "name", "resource_code")


@query("quiz_records", f"""
    WITH d AS (SELECT doc_id, lang, doc_id % 4 AS m, string_split(text, chr(10))[1] AS line FROM {{documents}})
    SELECT 'doc-' || doc_id AS export_id, 'A' || doc_id AS id, 'I' || doc_id AS ident, 'Quiz ' || lang AS name, CASE WHEN m % 2 = 0 THEN 'G-' || lang ELSE 'text' END AS grade_item_code, 'yes' AS show_clock, 'best' AS mark_calculation_type, '3' AS attempts_allowed,
           CASE m WHEN 0 THEN 'intro' WHEN 1 THEN {_FLAT} WHEN 2 THEN '' ELSE 'intro' END AS html FROM d
""")
def quiz_records(t: Tables) -> DataFrame:
    """Quizzes with their own rubric text, with an intro only, with neither, and with an empty rubric; questions have texts in every one."""
    m, first = F.col("doc_id") % 4, escaped(xml_safe(F.get(F.split("text", "\n"), F.lit(0))))
    number = F.col("doc_id").cast("string")
    grade = F.when(m % 2 == 0, F.concat(F.lit('<grade_item resource_code="G-'), "lang", F.lit('">x</grade_item>'))).otherwise(F.lit("<grade_item>text</grade_item>"))
    intro = F.when(m == 2, F.lit("")).otherwise(F.lit("<intro_message>intro</intro_message>"))
    rubric = F.when(m == 1, F.concat(F.lit("<rubric><flow_mat><material><mattext>"), first, F.lit("</mattext></material></flow_mat></rubric>"))).when(m == 3, F.lit("<rubric/>")).otherwise(F.lit(""))
    made = F.concat(
        F.lit('<questestinterop><assessment id="A'), number, F.lit('" ident="I'), number, F.lit('" title="Quiz '), "lang", F.lit('">'), rubric,
        F.lit("<assess_procextension><attempts_allowed>3</attempts_allowed><show_clock>yes</show_clock><mark_calculation_type>best</mark_calculation_type>"), grade, intro,
        F.lit('</assess_procextension><section title="S"><item ident="q"><presentation><material><mattext>'), first, F.lit(" question</mattext></material></presentation></item></section></assessment></questestinterop>"),
    )
    files = t.documents.select(F.concat(F.lit("doc-"), number).alias("export_id"), F.lit("quiz_d2l_1.xml").alias("rel_path"), made.alias("xml"))
    return silver.quizzes(files).select("export_id", "id", "ident", "name", "grade_item_code", "show_clock", "mark_calculation_type", "attempts_allowed", "html")


@query("quiz_nested", f"""
    WITH {_LN} n AS (SELECT doc_id, i, length(line) AS w FROM ln)
    SELECT 'doc-' || doc_id AS export_id, 'Outer ' || i AS title, 2 AS candidate_count, cast(w AS string) AS draw_count FROM n
    UNION ALL SELECT 'doc-' || doc_id, 'Inner ' || i, 1, cast(w AS string) FROM n
""")
def quiz_nested(t: Tables) -> DataFrame:
    """Sections inside sections: each counts the questions of its own; the last entry inside is the draw count of both."""
    files = xml_of(
        t, "'<questestinterop><assessment title=\"Quiz\">'",
        "concat('<section title=\"Outer ', i, '\"><qti_metadatafield><fieldlabel>qmd_numberofitems</fieldlabel><fieldentry>0</fieldentry></qti_metadatafield><section title=\"Inner ', i, '\"><qti_metadatafield><fieldlabel>qmd_numberofitems</fieldlabel><fieldentry>', length(z.r),"
        " '</fieldentry></qti_metadatafield><item ident=\"a\"/></section><item ident=\"b\"><x/></item><itemref linkrefid=\"c\"/></section>')",
        "'</assessment></questestinterop>'", "quiz_d2l_1.xml",
    )
    return silver.quiz_sections(files).select("export_id", "title", "candidate_count", "draw_count")


@query("xml_manifest_resources", f"""
    WITH {_LN} done AS (SELECT 1)
    SELECT 'doc-' || doc_id AS export_id, cast(i AS int) AS pos, 'R' || i AS identifier, 'content' AS material_type, CASE WHEN i % 3 = 0 THEN '' ELSE 'p/' || length(line) || '>.html' END AS href, i % 3 = 0 AS missing_href FROM ln
""")
def xml_manifest_resources(t: Tables) -> DataFrame:
    files = xml_of(
        t, "'<manifest><resources>'",
        "concat('<x:resource identifier=\"R', i, '\" type=\"webcontent\" x:material_type=\"content\"', if(i % 3 = 0, '', concat(' href=\"p/', length(z.r), '>.html\"')), if(i % 2 = 0, '/>', '><file/></x:resource>'))",
        "'</resources></manifest>'", "imsmanifest.xml",
    )
    return X.manifest_resources(files, ["export_id"]).select("export_id", F.col("pos").cast("int").alias("pos"), "identifier", "material_type", "href", "missing_href")


@query("xml_manifest_items", f"""
    WITH {_LN} done AS (SELECT 1)
    SELECT 'doc-' || doc_id AS export_id, 'M' || i AS identifier, 1 AS depth, {_FLAT} AS title, CASE WHEN i % 3 = 0 THEN true ELSE false END AS self_hidden FROM ln
    UNION ALL SELECT 'doc-' || doc_id, 'C' || i, 2, 'Child ' || length(line), false FROM ln
""")
def xml_manifest_items(t: Tables) -> DataFrame:
    files = xml_of(
        t, "'<manifest><organizations><organization>'",
        "concat('<item identifier=\"M', i, '\"', if(i % 3 = 0, ' isvisible=\"False\"', ''), '><title>', z.e, '</title><item identifier=\"C', i, '\"><title>Child ', length(z.r), '</title></item></item>')",
        "'</organization></organizations></manifest>'", "imsmanifest.xml",
    )
    return xml_index.manifest_items(xml_index.index(files, ["export_id"]), ["export_id"]).select("export_id", "identifier", "depth", "title", "self_hidden")


@query("rubric_names", """
    SELECT 'doc-' || doc_id AS export_id, 'RUB-' || doc_id AS rubric_id, 'Rubric ' || doc_id AS rubric_name FROM {documents}
""")
def rubric_names(t: Tables) -> DataFrame:
    return rubrics.rubrics(rubric_files(t)).select("export_id", "rubric_id", "rubric_name")


@query("release_codes", f"""
    WITH {_LN} done AS (SELECT 1)
    SELECT DISTINCT 'doc-' || doc_id AS export_id, 'D' || length(line) AS code FROM ln
""")
def release_codes(t: Tables) -> DataFrame:
    files = xml_of(t, "'<release>'", "concat('<rule><object x:resource_code=\"D', length(z.r), '\"/></rule>')", "'</release>'", "conditionalrelease_d2l.xml")
    return silver.condition_codes(files)
