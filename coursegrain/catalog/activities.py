"""Activities, lookups and edges.  One course per order, one activity per order line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import activities as A
from ..operators import findings as R
from ..operators import gold, identity, rubrics
from ..operators.scan import together
from ..sources import sinks
from .registry import Tables, query


def fleet(t: Tables) -> DataFrame:
    """Activities with the silver columns; the odd lines carry no rubric list."""
    has = F.when(F.col("out_of").cast("int") > 20, F.array("rubric_id")).otherwise(F.expr("cast(array() as array<string>)"))
    return t.v_activities.withColumn("rubric_ids", has)


def by_package(df: DataFrame) -> DataFrame:
    """The rows of a package beside each other: what every lookup and edge of an activity needs, moved once."""
    return together(df, "export_id")


def graded(t: Tables) -> DataFrame:
    return A.with_grade_items(by_package(fleet(t)), by_package(t.v_grade_items), ["pos", "name", "out_of"])


def resolved(t: Tables) -> DataFrame:
    acts = A.with_conditions(graded(t), by_package(t.v_conditions))
    return A.with_quicklinks(acts, A.quicklink_counts(by_package(t.v_links)))


_GRADE = """
    gi AS (SELECT export_id, resource_code, arg_max(name, pos) AS name, arg_max(out_of, pos) AS out_of FROM {v_grade_items} GROUP BY ALL),
    ag AS (SELECT a.*, CASE WHEN grade_item_code = '' THEN '' WHEN gi.resource_code IS NULL THEN '(unresolved)' ELSE gi.name END AS grade_item_name,
                  CASE WHEN gi.resource_code IS NULL THEN '' ELSE gi.out_of END AS grade_item_out_of, CASE WHEN grade_item_code = '' THEN NULL WHEN gi.resource_code IS NULL THEN 'NO' ELSE 'yes' END AS grade_resolved
           FROM {v_activities} a LEFT JOIN gi ON a.export_id = gi.export_id AND a.grade_item_code = gi.resource_code AND a.grade_item_code <> '')
"""
_COND = """
    cc AS (SELECT DISTINCT export_id, code FROM {v_conditions}), ca AS (SELECT DISTINCT export_id FROM {v_conditions}),
    ac AS (SELECT a.*, CASE WHEN condition_set = '' THEN NULL WHEN cc.code IS NOT NULL THEN 'yes' WHEN ca.export_id IS NOT NULL THEN 'NO' ELSE 'n/a' END AS condition_resolved
           FROM {v_activities} a LEFT JOIN cc ON a.export_id = cc.export_id AND a.condition_set = cc.code LEFT JOIN ca ON a.export_id = ca.export_id)
"""
_LINKS = """
    lk AS (SELECT export_id, resource_code, count(*) AS links FROM (SELECT export_id, unnest(regexp_extract_all(href, 'r[Cc]ode=([A-Za-z0-9._-]+)', 1)) AS resource_code FROM {v_links}) GROUP BY ALL)
"""


@query("activity_grade", f"WITH {_GRADE} SELECT export_id, kind, name, grade_item_code, grade_item_name, grade_item_out_of, grade_resolved FROM ag")
def activity_grade(t: Tables) -> DataFrame:
    rows = A.with_grade_items(fleet(t), t.v_grade_items, ["pos", "name", "out_of"])
    return rows.select("export_id", "kind", "name", "grade_item_code", "grade_item_name", "grade_item_out_of", "grade_resolved")


@query("activity_rubric", """
    SELECT a.export_id, a.kind, a.name, a.pos, a.rubric_id || ': ' || coalesce(r.rubric_name, '(unresolved)') AS rubrics_resolved, CASE WHEN r.rubric_id IS NULL THEN 'NO' ELSE 'yes' END AS resolved
    FROM {v_activities} a LEFT JOIN {v_rubrics} r ON a.export_id = r.export_id AND a.rubric_id = r.rubric_id WHERE cast(out_of AS int) > 20
""")
def activity_rubric(t: Tables) -> DataFrame:
    links = A.rubric_links(fleet(t), t.v_rubrics, ["export_id", "kind", "name", "pos"])
    label = F.concat("rubric_id", F.lit(": "), F.coalesce("rubric_name", F.lit("(unresolved)")))
    return links.select("export_id", "kind", "name", "pos", label.alias("rubrics_resolved"), "resolved")


@query("activity_condition", f"WITH {_COND} SELECT export_id, condition_set, condition_resolved, count(*) AS n FROM ac GROUP BY ALL")
def activity_condition(t: Tables) -> DataFrame:
    return A.with_conditions(fleet(t), t.v_conditions).groupBy("export_id", "condition_set", "condition_resolved").agg(F.count("*").alias("n"))


@query("linked_only", f"""
    WITH {_LINKS},
    l AS (SELECT a.export_id, kind, a.resource_code, coalesce(links, 0) AS links FROM {{v_activities}} a LEFT JOIN lk ON a.export_id = lk.export_id AND a.resource_code = lk.resource_code),
    sw AS (SELECT export_id, max(CASE WHEN links > 0 THEN 1 ELSE 0 END) AS m FROM l WHERE kind = 'quiz' GROUP BY export_id), pk AS (SELECT DISTINCT export_id FROM lk)
    SELECT l.export_id, 'checklist' AS kind, resource_code, count(*) AS n FROM l LEFT JOIN pk ON l.export_id = pk.export_id WHERE kind = 'dropbox_folder' AND (links > 0 OR pk.export_id IS NULL) GROUP BY ALL
    UNION ALL SELECT l.export_id, 'quiz', resource_code, count(*) FROM l JOIN sw ON l.export_id = sw.export_id WHERE kind = 'quiz' AND (links > 0 OR m = 0) GROUP BY ALL
""")
def linked_only(t: Tables) -> DataFrame:
    counts = A.quicklink_counts(by_package(t.v_links))
    acts = by_package(t.v_activities.select("export_id", "kind", "resource_code"))
    checklists = A.keep_linked(acts.filter("kind = 'dropbox_folder'").withColumn("kind", F.lit("checklist")), counts, only_if_any_match=False)
    quizzes = A.keep_linked(acts.filter("kind = 'quiz'"), counts, only_if_any_match=True)
    return checklists.unionByName(quizzes).groupBy("export_id", "kind", "resource_code").agg(F.count("*").alias("n"))


@query("orphan_grade_items", """
    SELECT export_id, 'R04' AS rule_id, 'warnings' AS severity, 'grade_item' AS subject_kind, name AS subject, 'grade item with no linked activity: ''' || name || '''' AS message
    FROM {v_grade_items} g WHERE type_id <> '9' AND NOT EXISTS (SELECT 1 FROM {v_activities} a WHERE a.export_id = g.export_id AND a.grade_item_code = g.resource_code)
""")
def orphan_grade_items(t: Tables) -> DataFrame:
    return R.orphans(A.orphan_grade_items(t.v_grade_items, t.v_activities))


@query("quiz_grade_break", """
    SELECT export_id, 'R02' AS rule_id, 'breaks' AS severity, 'quiz' AS subject_kind, name AS subject, 'quiz ''' || name || ''': grade_item ' || grade_item_code || ' not found in grades_d2l.xml' AS message
    FROM {v_activities} a WHERE kind = 'quiz' AND grade_item_code <> '' AND NOT EXISTS (SELECT 1 FROM {v_grade_items} g WHERE a.export_id = g.export_id AND a.grade_item_code = g.resource_code)
""")
def quiz_grade_break(t: Tables) -> DataFrame:
    return R.quiz_grade_breaks(t.v_activities.filter("kind = 'quiz'"), t.v_grade_items)


@query("points_mismatch", f"""
    WITH {_GRADE}
    SELECT export_id, 'R19' AS rule_id, 'breaks' AS severity, kind AS subject_kind, name AS subject, kind || ' ''' || name || ''': folder out_of ' || out_of || ' != grade item out_of ' || grade_item_out_of AS message
    FROM ag WHERE kind = 'dropbox_folder' AND try_cast(out_of AS double) <> try_cast(grade_item_out_of AS double)
""")
def points_mismatch(t: Tables) -> DataFrame:
    folders = A.with_grade_items(fleet(t).filter("kind = 'dropbox_folder'"), t.v_grade_items, ["pos", "name", "out_of"])
    return R.points_mismatches(A.points_mismatch(folders))


def edges(t: Tables) -> DataFrame:
    """Every kind of edge looks up its own columns among the rows of its package; no edge moves afterwards."""
    links = A.rubric_links(by_package(fleet(t)), by_package(t.v_rubrics), ["export_id", "kind", "name", "resource_code", "pos"])
    return A.relationships(resolved(t), links, A.orphan_grade_items(by_package(t.v_grade_items), by_package(t.v_activities)))


_EDGES = f"""
    {_GRADE}, {_COND}, {_LINKS},
    e AS (SELECT export_id, kind AS source_kind, name AS source_name, resource_code AS source_code, pos, 'grade_item' AS join_type, grade_item_code AS target, grade_resolved AS resolved FROM ag WHERE grade_resolved IS NOT NULL
        UNION ALL SELECT export_id, kind, name, resource_code, pos, 'condition_set', condition_set, condition_resolved FROM ac WHERE condition_resolved IS NOT NULL
        UNION ALL SELECT a.export_id, kind, name, a.resource_code, pos, 'manifest_quicklink', coalesce(links, 0) || ' link(s)', CASE WHEN links > 0 THEN 'yes' ELSE 'none' END FROM {{v_activities}} a LEFT JOIN lk ON a.export_id = lk.export_id AND a.resource_code = lk.resource_code
        UNION ALL SELECT a.export_id, kind, name, resource_code, pos, 'rubric', a.rubric_id, CASE WHEN r.rubric_id IS NULL THEN 'NO' ELSE 'yes' END FROM {{v_activities}} a LEFT JOIN {{v_rubrics}} r ON a.export_id = r.export_id AND a.rubric_id = r.rubric_id WHERE cast(out_of AS int) > 20
        UNION ALL SELECT export_id, 'grade_item', name, resource_code, pos, 'linked_activity', '(none found in dropbox/discussions/quizzes)', 'none' FROM {{v_grade_items}} g WHERE type_id <> '9' AND NOT EXISTS (SELECT 1 FROM {{v_activities}} a WHERE a.export_id = g.export_id AND a.grade_item_code = g.resource_code))
"""


@query("activities_union", f"WITH {_EDGES} SELECT export_id, source_kind, source_name, source_code, join_type, target, resolved, count(*) AS n FROM e GROUP BY ALL")
def activities_union(t: Tables) -> DataFrame:
    return edges(t).groupBy("export_id", "source_kind", "source_name", "source_code", "join_type", "target", "resolved").agg(F.count("*").alias("n"))


@query("findings_joins", f"""
    WITH {_EDGES}
    SELECT export_id, 'R01' AS rule_id, 'breaks' AS severity, source_kind AS subject_kind, source_name AS subject,
           source_kind || ' ''' || source_name || ''': ' || CASE join_type WHEN 'rubric' THEN 'rubric id' ELSE join_type END || ' ' || target || ' not found in ' || CASE join_type WHEN 'grade_item' THEN 'grades_d2l.xml' WHEN 'rubric' THEN 'rubrics_d2l.xml' ELSE 'conditionalrelease_d2l.xml' END AS message
    FROM e WHERE resolved = 'NO'
""")
def findings_joins(t: Tables) -> DataFrame:
    return A.join_findings(edges(t))


@query("rubric_usage", f"""
    WITH {_GRADE},
    u AS (SELECT export_id, rubric_id, CASE kind WHEN 'dropbox_folder' THEN 0 WHEN 'discussion_topic' THEN 1 ELSE 2 END AS k, pos,
                 CASE kind WHEN 'dropbox_folder' THEN 'Assignment: ' WHEN 'discussion_topic' THEN 'Discussion: ' ELSE 'Quiz: ' END || name || CASE WHEN grade_item_name <> '' THEN ' (grade item: ' || grade_item_name || ')' ELSE '' END AS label FROM ag WHERE cast(out_of AS int) > 20)
    SELECT export_id, rubric_id, label, arg_min(k, (k, pos)) AS first_kind, arg_min(pos, (k, pos)) AS first_pos FROM u GROUP BY ALL
""")
def rubric_usage(t: Tables) -> DataFrame:
    acts = A.with_grade_items(fleet(t), t.v_grade_items, ["pos", "name", "out_of"])
    return rubrics.usage(A.rubric_links(acts, t.v_rubrics, ["export_id", "kind", "name", "resource_code", "grade_item_name", "pos"]))


_LINEAGE = "'cc:lineage:' || left(sha256('[\"org_unit_id\",\"' || export_id || '\"]'), 32)"


def with_lineage(df: DataFrame) -> DataFrame:
    from ..functions.keys import scoped_key

    return df.withColumn("source_lineage_key", scoped_key("lineage", F.lit("org_unit_id"), F.col("export_id")))


@query("edge_keys", f"""
    WITH {_EDGES},
    o AS (SELECT *, row_number() OVER (PARTITION BY export_id, source_kind, source_code, join_type, target, resolved ORDER BY pos) - 1 AS ord, {_LINEAGE} AS lin FROM e)
    SELECT export_id, source_kind, source_code, join_type, target, resolved, cast(ord AS int) AS duplicate_ordinal,
           'cc:relationship:' || left(sha256('["' || lin || '","' || source_kind || '","' || source_code || '","' || join_type || '","' || target || '","' || resolved || '","' || ord || '"]'), 32) AS relationship_key
    FROM o
""")
def edge_keys(t: Tables) -> DataFrame:
    # positions are line number x 10^11 + part, so a range of one line number is one chunk
    numbered = A.duplicate_ordinals(edges(t), "pos", F.floor(F.col("pos") / 100000000000))
    return identity.edge_keys(with_lineage(numbered)).select("export_id", "source_kind", "source_code", "join_type", "target", "resolved", "duplicate_ordinal", "relationship_key")


def grade_entities(t: Tables) -> DataFrame:
    rows = with_lineage(by_package(t.v_grade_items)).withColumns({"resource_code": F.when(F.col("type_id") == "9", "").otherwise(F.col("resource_code")), "identifier": F.when(F.col("is_bonus") == "True", "").otherwise(F.col("identifier"))})
    return identity.entity_keys(rows, F.lit("grade_item"), ["resource_code", "identifier"], F.concat_ws("|", "name", F.lit("")))


_ENTITIES = f"""
    g AS (SELECT export_id, CASE WHEN type_id = '9' THEN '' ELSE resource_code END AS resource_code, CASE WHEN is_bonus = 'True' THEN '' ELSE identifier END AS identifier, name, {_LINEAGE} AS lin FROM {{v_grade_items}}),
    b AS (SELECT *, CASE WHEN resource_code <> '' THEN 'resource_code' WHEN identifier <> '' THEN 'identifier' ELSE 'source_context' END AS basis, CASE WHEN resource_code <> '' THEN resource_code WHEN identifier <> '' THEN identifier ELSE name || '|' END AS v FROM g),
    ent AS (SELECT *, 'cc:entity:' || left(sha256('["' || lin || '","grade_item","' || basis || '","' || v || '"]'), 32) AS entity_key FROM b)
"""


@query("entity_keys", f"""
    WITH {_ENTITIES}
    SELECT export_id, name, basis AS identity_basis, CASE basis WHEN 'resource_code' THEN 'durable_source_id' WHEN 'identifier' THEN 'scoped_source_id' ELSE 'fallback' END AS identity_quality, entity_key, count(*) AS n FROM ent GROUP BY ALL
""")
def entity_keys(t: Tables) -> DataFrame:
    return grade_entities(t).groupBy("export_id", "name", "identity_basis", "identity_quality", "entity_key").agg(F.count("*").alias("n"))


@query("edge_endpoints", f"""
    WITH {_ENTITIES}, {_GRADE},
    al AS (SELECT DISTINCT export_id, resource_code AS alias, entity_key FROM ent WHERE resource_code <> '' UNION SELECT export_id, identifier, entity_key FROM ent WHERE identifier <> ''),
    one AS (SELECT export_id, alias, min(entity_key) AS k FROM al GROUP BY ALL HAVING count(DISTINCT entity_key) = 1)
    SELECT ag.export_id, ag.resource_code AS source_code, grade_item_code AS target, s.k AS source_entity_key, tg.k AS target_entity_key,
           CASE WHEN s.k IS NOT NULL AND tg.k IS NOT NULL THEN 'resolved_endpoints' WHEN s.k IS NOT NULL OR tg.k IS NOT NULL THEN 'partial_endpoints' ELSE 'evidence_only' END AS endpoint_quality, count(*) AS n
    FROM ag LEFT JOIN one s ON ag.export_id = s.export_id AND ag.resource_code = s.alias LEFT JOIN one tg ON ag.export_id = tg.export_id AND ag.grade_item_code = tg.alias WHERE grade_item_code <> '' GROUP BY ALL
""")
def edge_endpoints(t: Tables) -> DataFrame:
    aliases = identity.entity_aliases(grade_entities(t), ["resource_code", "identifier"])
    rows = t.v_activities.filter("grade_item_code <> ''").select("export_id", F.col("resource_code").alias("source_code"), F.col("grade_item_code").alias("target"))
    return identity.edge_endpoints(rows, aliases).groupBy("export_id", "source_code", "target", "source_entity_key", "target_entity_key", "endpoint_quality").agg(F.count("*").alias("n"))


@query("edge_identity", f"""
    WITH {_EDGES}, {_ENTITIES},
    al AS (SELECT DISTINCT export_id, resource_code AS alias, entity_key FROM ent WHERE resource_code <> '' UNION SELECT export_id, identifier, entity_key FROM ent WHERE identifier <> ''),
    one AS (SELECT export_id, alias, min(entity_key) AS k FROM al GROUP BY ALL HAVING count(DISTINCT entity_key) = 1),
    o AS (SELECT *, row_number() OVER (PARTITION BY export_id, source_kind, source_code, join_type, target, resolved ORDER BY pos) - 1 AS ord, {_LINEAGE} AS lin FROM e)
    SELECT o.export_id, 'cc:relationship:' || left(sha256('["' || lin || '","' || source_kind || '","' || source_code || '","' || join_type || '","' || target || '","' || resolved || '","' || ord || '"]'), 32) AS relationship_key,
           s.k AS source_entity_key, tg.k AS target_entity_key,
           CASE WHEN s.k IS NOT NULL AND tg.k IS NOT NULL THEN 'resolved_endpoints' WHEN s.k IS NOT NULL OR tg.k IS NOT NULL THEN 'partial_endpoints' ELSE 'evidence_only' END AS endpoint_quality
    FROM o LEFT JOIN one s ON o.export_id = s.export_id AND o.source_code = s.alias LEFT JOIN one tg ON o.export_id = tg.export_id AND o.target = tg.alias
""")
def edge_identity(t: Tables) -> DataFrame:
    """Every edge with its own key and the keys of both ends."""
    numbered = A.duplicate_ordinals(edges(t), "pos", F.floor(F.col("pos") / 100000000000))
    aliases = identity.entity_aliases(grade_entities(t), ["resource_code", "identifier"])
    found = identity.edge_endpoints(identity.edge_keys(with_lineage(numbered)), aliases)
    return found.select("export_id", "relationship_key", "source_entity_key", "target_entity_key", "endpoint_quality")


@query("activity_details", f"""
    WITH {_GRADE},
    q AS (SELECT *, cast(out_of AS int) AS o FROM ag),
    p AS (SELECT *, CASE WHEN kind = 'quiz' THEN grade_item_out_of ELSE out_of END AS pts FROM q),
    d AS (SELECT export_id, kind, resource_code, pos, 0 AS ord, 'Points' AS detail, CASE WHEN try_cast(pts AS double) IS NULL THEN pts ELSE cast(cast(cast(pts AS double) AS int) AS string) END || ' pts' AS value FROM p WHERE pts <> ''
      UNION ALL SELECT export_id, kind, resource_code, pos, 1, 'Gradebook item', grade_item_name FROM p WHERE grade_item_name <> ''
      UNION ALL SELECT export_id, kind, resource_code, pos, 3, 'Attempts allowed', '2' FROM p WHERE kind = 'quiz' AND o > 10
      UNION ALL SELECT export_id, kind, resource_code, pos, 4, 'Time limit', CASE WHEN o = 20 THEN 'No time limit' ELSE (o - 20) || ' minutes' END FROM p WHERE kind = 'quiz'
      UNION ALL SELECT export_id, kind, resource_code, pos, 6, 'Questions', o || ' drawn from ' || (2 * o) || ' candidates' FROM p WHERE kind = 'quiz'
      UNION ALL SELECT export_id, kind, resource_code, pos, 7, 'Sections', cast(o AS string) FROM p WHERE kind = 'quiz'
      UNION ALL SELECT export_id, kind, resource_code, pos, 9, 'Active', 'no' FROM p WHERE kind = 'quiz' AND l_linestatus = 'O')
    SELECT export_id, kind, resource_code, ord, detail, value, count(*) AS n FROM d GROUP BY ALL
""")
def activity_details(t: Tables) -> DataFrame:
    acts = graded(t)
    o = F.col("out_of").cast("int")
    rows = acts.withColumns({
        "rubrics_resolved": F.lit(""), "attempts_allowed": F.when(o > 10, "2").otherwise(""), "time_limit": F.when(o == 20, "0").otherwise((o - 20).cast("string")),
        "enforce_time_limit": F.lit("no"), "drawn": o, "candidates": o * 2, "sections": o, "question_types": F.lit(""), "is_active": F.when(F.col("l_linestatus") == "O", "no").otherwise("yes"),
    })
    return A.details(rows).groupBy("export_id", "kind", "resource_code", "ord", "detail", "value").agg(F.count("*").alias("n"))


@query("activity_summary", f"""
    WITH {_EDGES},
    a AS (SELECT export_id, count(*) FILTER (WHERE kind = 'dropbox_folder') AS folders, count(*) FILTER (WHERE kind = 'dropbox_folder' AND grade_item_code <> '') AS folders_graded,
                 count(*) FILTER (WHERE kind = 'discussion_topic') AS topics, count(*) FILTER (WHERE kind = 'quiz') AS quizzes FROM {{v_activities}} GROUP BY export_id),
    x AS (SELECT export_id, count(*) AS edges, count(*) FILTER (WHERE resolved = 'NO') AS unresolved, count(*) FILTER (WHERE join_type = 'linked_activity') AS orphans FROM e GROUP BY export_id)
    SELECT a.export_id, folders, folders_graded, topics, quizzes, edges, unresolved, orphans FROM a JOIN x ON a.export_id = x.export_id
""")
def activity_summary(t: Tables) -> DataFrame:
    kind, graded = F.col("kind"), F.col("grade_item_code") != ""
    a = by_package(t.v_activities).groupBy("export_id").agg(
        F.count_if(kind == "dropbox_folder").alias("folders"), F.count_if((kind == "dropbox_folder") & graded).alias("folders_graded"),
        F.count_if(kind == "discussion_topic").alias("topics"), F.count_if(kind == "quiz").alias("quizzes"),
    )
    e = edges(t).groupBy("export_id").agg(
        F.count("*").alias("edges"), F.count_if(F.col("resolved") == "NO").alias("unresolved"), F.count_if(F.col("join_type") == "linked_activity").alias("orphans")
    )
    return a.join(e, "export_id")


@query("review_sheets", f"""
    WITH {_EDGES},
    pk AS (SELECT DISTINCT export_id FROM lk),
    s AS (SELECT 'Activity_Joins' AS sheet, export_id, source_kind AS c1, source_name AS c2, source_code AS c3, join_type AS c4, target AS c5, resolved AS c6, '' AS c7, '' AS c8, '' AS c9 FROM e
        UNION ALL SELECT 'Dropbox_Folders', export_id, '', name, resource_code, out_of, grade_item_code, '', '', condition_set, '' FROM {{v_activities}} WHERE kind = 'dropbox_folder'
        UNION ALL SELECT 'Discussions', export_id, kind, '', '', name, resource_code, out_of, grade_item_code, '', condition_set FROM {{v_activities}} WHERE kind = 'discussion_topic'
        UNION ALL SELECT 'Grade_Items', export_id, '', identifier, resource_code, name, type_id, '', out_of, is_bonus, exclude_from_final_grade_calc FROM {{v_grade_items}}
        UNION ALL SELECT 'Checklists', a.export_id, '', name, a.resource_code, '', '', '', '', '', '' FROM {{v_activities}} a LEFT JOIN lk ON a.export_id = lk.export_id AND a.resource_code = lk.resource_code LEFT JOIN pk ON a.export_id = pk.export_id
            WHERE kind = 'dropbox_folder' AND (links > 0 OR pk.export_id IS NULL)
        UNION ALL SELECT 'Quizzes', export_id, '', '', name, resource_code, grade_item_code, CASE WHEN l_linestatus = 'O' THEN 'no' ELSE 'yes' END, CASE WHEN cast(out_of AS int) > 10 THEN '2' ELSE '' END, cast(cast(out_of AS int) - 20 AS string), ''
            FROM {{v_activities}} WHERE kind = 'quiz'
        UNION ALL SELECT 'Diagnostics', export_id, 'R01', 'breaks', source_kind, source_name, source_kind || ' ''' || source_name || ''': ' || CASE join_type WHEN 'rubric' THEN 'rubric id' ELSE join_type END || ' ' || target || ' not found in '
            || CASE join_type WHEN 'grade_item' THEN 'grades_d2l.xml' WHEN 'rubric' THEN 'rubrics_d2l.xml' ELSE 'conditionalrelease_d2l.xml' END, '', '', '', '' FROM e WHERE resolved = 'NO'
        UNION ALL SELECT 'Diagnostics', export_id, 'R02', 'breaks', 'quiz', name, 'quiz ''' || name || ''': grade_item ' || grade_item_code || ' not found in grades_d2l.xml', '', '', '', ''
            FROM {{v_activities}} a WHERE kind = 'quiz' AND grade_item_code <> '' AND NOT EXISTS (SELECT 1 FROM {{v_grade_items}} g WHERE a.export_id = g.export_id AND a.grade_item_code = g.resource_code)
        UNION ALL SELECT 'Diagnostics', export_id, 'R04', 'warnings', 'grade_item', source_name, 'grade item with no linked activity: ''' || source_name || '''', '', '', '', '' FROM e WHERE join_type = 'linked_activity'
        UNION ALL SELECT 'Diagnostics', export_id, 'R19', 'breaks', kind, name, kind || ' ''' || name || ''': folder out_of ' || out_of || ' != grade item out_of ' || grade_item_out_of, '', '', '', ''
            FROM ag WHERE kind = 'dropbox_folder' AND try_cast(out_of AS double) <> try_cast(grade_item_out_of AS double))
    SELECT sheet, export_id, c1, c2, c3, c4, c5, c6, c7, c8, c9, count(*) AS n FROM s GROUP BY ALL
""")
def review_sheets(t: Tables) -> DataFrame:
    """All seven sheets, a column of a sheet at its fixed place (c1 to c9) and equal rows counted."""
    acts, items, looked_up = by_package(fleet(t)), by_package(t.v_grade_items), graded(t)
    folders, quizzes, joins = acts.filter("kind = 'dropbox_folder'"), acts.filter("kind = 'quiz'"), edges(t)
    flat = t.v_activities  # sheets without a lookup are counted as they are read; with one layout for all, one task took every sheet
    blank = {c: F.lit("") for c in ("id", "source_file", "date_due", "is_hidden", "category_name")}
    o = F.col("out_of").cast("int")
    settings = {"is_active": F.when(F.col("l_linestatus") == "O", "no").otherwise("yes"), "attempts_allowed": F.when(o > 10, "2").otherwise(""), "time_limit": (o - 20).cast("string")}
    sheets = sinks.review_sheets({
        "Dropbox_Folders": flat.filter("kind = 'dropbox_folder'").withColumns(blank), "Discussions": flat.filter("kind = 'discussion_topic'").withColumns(blank), "Grade_Items": t.v_grade_items.withColumns(blank),
        "Checklists": A.keep_linked(folders, A.quicklink_counts(by_package(t.v_links)), only_if_any_match=False).withColumns(blank),
        "Quizzes": flat.filter("kind = 'quiz'").withColumns(blank | settings), "Activity_Joins": joins,
        "Diagnostics": R.union([
            A.join_findings(joins), R.quiz_grade_breaks(quizzes, items), R.orphans(A.orphan_grade_items(items, acts)),
            R.points_mismatches(A.points_mismatch(looked_up.filter("kind = 'dropbox_folder'"))),
        ]),
    })

    def counted(name: str, sheet: DataFrame) -> DataFrame:
        # a sheet is counted before the sheets come together, so edges don't move again
        cells = [c for c in sheet.columns if c != "export_id"]
        rows = sheet.select(F.lit(name).alias("sheet"), "export_id", *[(F.col(cells[i]) if i < len(cells) else F.lit("")).alias(f"c{i + 1}") for i in range(9)])
        return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))

    return R.union([counted(name, sheet) for name, sheet in sheets.items()])


@query("unplaced", f"""
    WITH {_LINKS}
    SELECT a.export_id, kind, a.name, a.resource_code, count(*) AS n FROM {{v_activities}} a LEFT JOIN lk ON a.export_id = lk.export_id AND a.resource_code = lk.resource_code WHERE lk.links IS NULL GROUP BY ALL
""")
def unplaced(t: Tables) -> DataFrame:
    placed = A.quicklink_counts(t.v_links).withColumnRenamed("resource_code", "rcode")
    return gold.unplaced(t.v_activities, placed).groupBy("export_id", "kind", "name", "resource_code").agg(F.count("*").alias("n"))
