"""Tool files to entity tables.  Input ``files``: export_id, rel_path, xml."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .. import constants as K
from ..functions.binding import let
from ..functions.numbers import to_int
from ..functions.text import clean, unescape
from . import xml as X
from . import xml_index

_KEYS = ["export_id", "rel_path"]


def at_path(files: DataFrame, pattern: str) -> DataFrame:
    """Package-root files by name pattern (SQL LIKE)."""
    return files.filter(F.col("rel_path").like(pattern))


GRADE_ITEM = (
    "_id string, _identifier string, _resource_code string, _category_id string, name string, short_name string, "
    "type_id string, is_active string, "
    "scoring struct<out_of:string,max_grade:string,is_bonus:string,exclude_from_final_grade_calc:string>"
)


def grade_items(files: DataFrame) -> DataFrame:
    """Grade items with their category name."""
    names = (
        X.elements(files, "category", "_id string, name string", _KEYS)
        .select(*_KEYS, X.field("e._id").alias("category_id"), X.field("e.name").alias("category_name"), "pos")
    )
    last = names.groupBy(*_KEYS, "category_id").agg(F.max_by("category_name", "pos").alias("category_name"))
    items = X.elements(files, "item", GRADE_ITEM, _KEYS).select(
        *_KEYS, "pos", X.field("e._id").alias("id"), X.field("e._identifier").alias("identifier"),
        X.field("e._resource_code").alias("resource_code"), X.field("e.name").alias("name"),
        X.field("e.short_name").alias("short_name"), X.field("e.type_id").alias("type_id"),
        X.field("e.is_active").alias("is_active"), X.field("e._category_id").alias("category_id"),
        X.field("e.scoring.out_of").alias("out_of"), X.field("e.scoring.max_grade").alias("max_grade"),
        X.field("e.scoring.is_bonus").alias("is_bonus"),
        X.field("e.scoring.exclude_from_final_grade_calc").alias("exclude_from_final_grade_calc"),
    )
    return items.join(last, [*_KEYS, "category_id"], "left").withColumn("category_name", F.coalesce("category_name", F.lit("")))


def rubric_names(files: DataFrame) -> DataFrame:
    """Rubric id to name; attribute before child, last duplicate wins."""
    rows = X.elements(files, "rubric", "_id string, _name string, name string", _KEYS)
    name = F.coalesce(F.nullif(X.field("e._name"), F.lit("")), X.field("e.name"))
    return (
        rows.select("export_id", "pos", X.field("e._id").alias("rubric_id"), name.alias("n"))
        .filter("rubric_id <> ''").groupBy("export_id", "rubric_id").agg(F.max_by("n", "pos").alias("rubric_name"))
    )


def condition_codes(files: DataFrame) -> DataFrame:
    """Every resource code in a release file, whatever element carries it."""
    return files.select(
        "export_id", F.explode(F.regexp_extract_all("xml", F.lit(r"""\bresource_code\s*=\s*["']([^"']+)["']"""), F.lit(1))).alias("code")
    ).distinct()


_ATTRIBUTE = r"""([\w.-]+)\s*=\s*(?:"[^"]*"|'[^']*')"""
_ATTRIBUTE_VALUE = r"""[\w.-]+\s*=\s*["']((?<=")[^"]*|(?<=')[^']*)"""


def attribute_map(tag: Column) -> Column:
    """Attributes of an opening tag as a map, namespace prefixes cut; a repeated name keeps the last value."""
    opening = F.regexp_extract(tag, r"(?s)^<[^\s/>]+(.*?)/?>$", 1)
    found = F.struct(
        F.regexp_extract_all(opening, F.lit(_ATTRIBUTE), F.lit(1)).alias("names"),
        F.regexp_extract_all(opening, F.lit(_ATTRIBUTE_VALUE), F.lit(1)).alias("values"),
    )
    return let(found, lambda f: _last_values(f["names"], f["values"]))


def _last_values(names: Column, values: Column) -> Column:
    pairs = F.arrays_zip(names.alias("k"), F.transform(values, lambda v: clean(unescape(v))).alias("v"))
    last = F.filter(pairs, lambda p, i: F.array_position(F.slice(names, i + 2, F.greatest(F.size(names), F.lit(1))), p["k"]) == 0)
    return F.map_from_entries(last)


def conditions(files: DataFrame) -> DataFrame:
    """Conditions of each condition set with their attributes verbatim."""
    sets = files.select("export_id", F.posexplode(X.element_strings(F.col("xml"), "condition_set")).alias("set_no", "_set"))
    rows = sets.select(
        "export_id", "set_no", X.attribute(F.regexp_extract("_set", r"(?s)^<[^>]*>", 0), "resource_code").alias("resource_code"),
        F.posexplode(F.regexp_extract_all("_set", F.lit(r"""(?s)<(?:\w+:)?condition(?=[\s/>])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""), F.lit(0))).alias("condition_no", "_c"),
    )
    return rows.withColumn("attributes", attribute_map(F.col("_c"))).drop("_c")


def condition_references(rows: DataFrame) -> DataFrame:
    """Objects a condition points at: its non-empty attributes among the known targets, in target order."""
    targets = F.array(*[F.struct(F.lit(k).alias("kind"), F.element_at("attributes", k).alias("value")) for k in K.CONDITION_TARGETS])
    return rows.select(
        "export_id", "set_no", "condition_no", "resource_code", F.posexplode(targets).alias("ref_no", "t")
    ).select("export_id", "set_no", "condition_no", "resource_code", "ref_no", F.col("t.kind").alias("ref_kind"), F.col("t.value").alias("ref_value")).filter(
        "coalesce(ref_value, '') <> ''"
    )


_ASSOCIATIONS = "associations struct<rubric:array<string>>"
FOLDER = (
    "_id string, _name string, _resource_code string, _submission_type string, _folder_type string, _out_of string, "
    "_grade_item string, _date_due string, _is_hidden string, _condition_set string, date_due string, "
    f"instructions struct<text:string,_VALUE:string>, {_ASSOCIATIONS}"
)


def _rubric_ids(path: str) -> Column:
    return F.filter(F.transform(F.coalesce(F.col(path), F.expr("cast(array() as array<string>)")), clean), lambda v: v != "")


def _html(path: str) -> Column:
    return clean(F.concat(F.coalesce(F.col(f"{path}._VALUE"), F.lit("")), F.coalesce(F.col(f"{path}.text"), F.lit(""))))


ACTIVITY_COLUMNS = [
    "export_id", "kind", "source_file", "pos", "id", "name", "resource_code", "grade_item_code", "rubric_ids", "condition_set",
    "out_of", "is_hidden", "date_due", "html", "attempts_allowed", "time_limit", "enforce_time_limit", "is_active",
    "parent_id", "submission_type", "folder_type", "requires_approval", "must_post_to_participate", "ident", "show_clock", "mark_calculation_type",
]


def _activity(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    empty_list = F.expr("cast(array() as array<string>)")
    return df.select(*[F.col(c) if c in have else (empty_list if c == "rubric_ids" else F.lit("")).alias(c) for c in ACTIVITY_COLUMNS])


def dropbox_folders(files: DataFrame) -> DataFrame:
    rows = X.elements(files, "folder", FOLDER, _KEYS)
    due = F.coalesce(F.nullif(X.field("e.date_due"), F.lit("")), X.field("e._date_due"))
    return _activity(rows.select(
        "export_id", F.lit("dropbox_folder").alias("kind"), F.col("rel_path").alias("source_file"), "pos", X.field("e._id").alias("id"),
        X.field("e._name").alias("name"), X.field("e._resource_code").alias("resource_code"), X.field("e._grade_item").alias("grade_item_code"),
        _rubric_ids("e.associations.rubric").alias("rubric_ids"), X.field("e._condition_set").alias("condition_set"),
        X.field("e._submission_type").alias("submission_type"), X.field("e._folder_type").alias("folder_type"),
        X.field("e._out_of").alias("out_of"), X.field("e._is_hidden").alias("is_hidden"), due.alias("date_due"), _html("e.instructions").alias("html"),
    ))


_PROPS = "properties struct<is_hidden:string,score_out_of:string,grade_item_id:string,requires_approval:string,must_post_to_participate:string>"
TOPIC = (
    f"_id string, _resource_code string, _condition_set string, content struct<title:string,description:struct<text:string,_VALUE:string>>, {_PROPS}, {_ASSOCIATIONS}"
)
FORUM = f"_id string, _resource_code string, _condition_set string, content struct<title:string>, {_PROPS}"


#: Positions below one forum; more topics than a file can hold.
_STRIDE = 1 << 32


def discussions(files: DataFrame) -> DataFrame:
    """One row per forum and one per topic of the forum."""
    forums = files.select(*_KEYS, F.posexplode(X.element_strings(F.col("xml"), "forum")).alias("forum_no", "_forum"))
    head = F.regexp_replace("_forum", r"(?s)<(?:\w+:)?topics?(?=[\s/>]).*</(?:\w+:)?topics?\s*>", "")
    read = forums.withColumn("f", F.from_xml(head, FORUM, X.OPTIONS))
    forum_rows = _activity(read.select(
        "export_id", F.lit("forum").alias("kind"), F.col("rel_path").alias("source_file"), (F.col("forum_no") * _STRIDE).alias("pos"),
        X.field("f._id").alias("id"), X.field("f.content.title").alias("name"), X.field("f._resource_code").alias("resource_code"),
        X.field("f.properties.is_hidden").alias("is_hidden"), X.field("f._condition_set").alias("condition_set"),
    ))
    topics = read.select(*_KEYS, "forum_no", X.field("f._id").alias("forum_id"), F.posexplode(X.element_strings(F.col("_forum"), "topic")).alias("n", "_topic"))
    t = topics.withColumn("e", F.from_xml("_topic", TOPIC, X.OPTIONS))
    topic_rows = _activity(t.select(
        "export_id", F.lit("discussion_topic").alias("kind"), F.col("rel_path").alias("source_file"), (F.col("forum_no") * _STRIDE + F.col("n") + 1).alias("pos"),
        X.field("e._id").alias("id"), X.field("e.content.title").alias("name"), X.field("e._resource_code").alias("resource_code"),
        X.field("e.properties.grade_item_id").alias("grade_item_code"), _rubric_ids("e.associations.rubric").alias("rubric_ids"),
        X.field("e._condition_set").alias("condition_set"), X.field("e.properties.score_out_of").alias("out_of"),
        X.field("e.properties.is_hidden").alias("is_hidden"), _html("e.content.description").alias("html"), F.col("forum_id").alias("parent_id"),
        X.field("e.properties.requires_approval").alias("requires_approval"), X.field("e.properties.must_post_to_participate").alias("must_post_to_participate"),
    ))
    return forum_rows.unionByName(topic_rows)


_ENTRY = "name:string,_sort_order:string,description:struct<text:string,_VALUE:string>"
CHECKLIST = (
    f"_id string, _resource_code string, _display_in_new_window string, name string, "
    f"category array<struct<{_ENTRY},item:array<struct<{_ENTRY}>>>>"
)


def checklists(files: DataFrame) -> DataFrame:
    rows = X.elements(files, "checklist", CHECKLIST, _KEYS)
    return _activity(rows.select(
        "export_id", F.lit("checklist").alias("kind"), F.col("rel_path").alias("source_file"), "pos", X.field("e._id").alias("id"),
        X.field("e.name").alias("name"), X.field("e._resource_code").alias("resource_code"),
    ))


def checklist_entries(files: DataFrame) -> DataFrame:
    """Categories and items in display order: sort_order first (bad values count as 0), then document order."""
    rows = X.elements(files, "checklist", CHECKLIST, _KEYS).withColumnRenamed("pos", "checklist_no")
    cats = rows.select("export_id", "checklist_no", X.field("e._resource_code").alias("resource_code"), F.posexplode("e.category").alias("category_no", "c"))
    order = lambda p: to_int(F.col(p))
    # a category's label goes before its items, so that the file is read once
    label = F.struct(F.lit(-1).alias("no"), F.col("c.name").alias("name"), F.lit(None).cast("string").alias("_sort_order"), F.col("c.description").alias("description"))
    items = F.transform("c.item", lambda i, n: F.struct(n.alias("no"), i["name"].alias("name"), i["_sort_order"].alias("_sort_order"), i["description"].alias("description")))
    entries = cats.select(
        "export_id", "checklist_no", "resource_code", order("c._sort_order").alias("category_order"), "category_no",
        F.explode(F.when(F.col("c.item").isNull(), F.array(label)).otherwise(F.concat(F.array(label), items))).alias("i"),
    )
    is_label = F.col("i.no") < 0
    return entries.select(
        "export_id", "checklist_no", "resource_code", "category_order", "category_no", F.when(is_label, -1).otherwise(order("i._sort_order")).alias("item_order"),
        F.col("i.no").alias("item_no"), F.when(is_label, "label").otherwise("li").alias("entry"), X.field("i.name").alias("text"), _html("i.description").alias("html"),
    )


_SETTINGS = ("is_active", "attempts_allowed", "time_limit", "enforce_time_limit", "date_due", "intro_message", "show_clock", "mark_calculation_type")


def quizzes(files: DataFrame) -> DataFrame:
    """First assessment of each quiz file with its settings, read from the element index."""
    return quizzes_of(xml_index.stored_index(files, _KEYS))


def quizzes_of(index: DataFrame) -> DataFrame:
    """Settings are the children of an ``assess_procextension``; the quiz's own text is the first one inside its own rubric.

    Everything a file needs is found by comparing intervals: the assessment, its
    rubric and the extensions are marked in windows over the file, then one
    group by file picks the values.
    """
    used = xml_index.by_file(index.filter(F.col("tag").isin("assessment", "rubric", "assess_procextension", "mattext", "grade_item", *_SETTINGS)), _KEYS)
    whole, sibling = W.partitionBy(*_KEYS), W.partitionBy(*_KEYS, "_family")
    # an extension and its children are one family; grandchildren belong to another
    family = F.when(F.col("tag") == "assess_procextension", F.col("pre")).otherwise(F.col("parent"))
    first = used.withColumn("_family", family).withColumns({
        "_setting": F.max(F.col("tag") == "assess_procextension").over(sibling) & (F.col("tag") != "assess_procextension"),
        "_quiz": F.min(F.when(F.col("tag") == "assessment", F.col("pre"))).over(whole),
    })
    own = first.withColumn("_rubric", F.min(F.when((F.col("tag") == "rubric") & (F.col("parent") == F.col("_quiz")), F.struct("pre", "last"))).over(whole))
    in_rubric = (F.col("pre") > F.col("_rubric.pre")) & (F.col("pre") <= F.col("_rubric.last"))
    setting = lambda n, value: F.min_by(value, F.when(F.col("_setting") & (F.col("tag") == n), F.col("pre"))).alias(f"_{n}")
    read = own.groupBy(*_KEYS).agg(
        F.min_by(F.struct(*[clean(xml_index.attribute(n)).alias(n) for n in ("id", "title", "resource_code", "ident")]), F.when(F.col("pre") == F.col("_quiz"), F.col("pre"))).alias("_a"),
        F.min_by(xml_index.text(), F.when((F.col("tag") == "mattext") & in_rubric, F.col("pre"))).alias("_mat"),
        setting("grade_item", F.struct(xml_index.attribute("resource_code").alias("code"), xml_index.text().alias("text"))),
        *[setting(n, xml_index.text()) for n in _SETTINGS],
    ).filter("_a is not null")
    html = F.regexp_replace(F.coalesce("_mat", "_intro_message", F.lit("")), r"(?is)<scribe-shadow\b.*?</scribe-shadow>", "")
    text = lambda n: F.coalesce(f"_{n}", F.lit(""))
    return _activity(
        read.select(
            "export_id", F.lit("quiz").alias("kind"), F.col("rel_path").alias("source_file"), F.lit(0).alias("pos"), F.col("_a.id").alias("id"), F.col("_a.title").alias("name"),
            F.col("_a.resource_code").alias("resource_code"), F.coalesce(F.nullif("_grade_item.code", F.lit("")), "_grade_item.text", F.lit("")).alias("grade_item_code"),
            text("is_active").alias("is_active"), text("attempts_allowed").alias("attempts_allowed"), text("time_limit").alias("time_limit"),
            text("enforce_time_limit").alias("enforce_time_limit"), text("date_due").alias("date_due"), html.alias("html"),
            F.col("_a.ident").alias("ident"), text("show_clock").alias("show_clock"), text("mark_calculation_type").alias("mark_calculation_type"),
        )
    )


_SECTION_TAGS = ("section", "item", "itemref", "fieldlabel", "fieldentry")
_LABELS = {"draw_count": "qmd_numberofitems", "points_per_question": "qmd_weighting", "type": "qmd_questiontype"}


def _labelled(rows: DataFrame) -> DataFrame:
    """Sections, questions and references with the last entry of each label anywhere inside.

    A label and its entry are children of one element.  In the order of the file,
    with a section or question standing where its last element stands, the last
    entry so far lies inside it if it came after its opening tag: one running value
    serves every level.
    """
    pair = W.partitionBy(*_KEYS, "parent")
    newest = lambda tag, value: F.max(F.when(F.col("tag") == tag, F.struct(F.col("pre").alias("at"), value.alias("value")))).over(pair)
    paired = rows.withColumns({"_label": newest("fieldlabel", xml_index.text()), "_entry": newest("fieldentry", xml_index.text())["value"]})
    entry = (F.col("tag") == "fieldlabel") & (F.col("pre") == F.col("_label.at"))
    spans = F.col("tag").isin("section", "item", "itemref")
    so_far = W.partitionBy(*_KEYS).orderBy(F.when(spans, F.col("last")).otherwise(F.col("parent")), spans, "pre").rowsBetween(W.unboundedPreceding, 0)
    last = lambda label: F.last(F.when(entry & (F.col("_label.value") == label), F.struct("parent", F.coalesce("_entry", F.lit("")).alias("entry"))), True).over(so_far)
    # an entry that no label names is done with here
    known = paired.filter(spans | (entry & F.col("_label.value").isin(*_LABELS.values()))).drop("content").withColumns({f"_{n}": last(label) for n, label in _LABELS.items()}).filter(spans)
    own = {n: F.coalesce(F.when(F.col(f"_{n}.parent") > F.col("pre"), F.col(f"_{n}.entry")), F.lit("")) for n in _LABELS}
    return known.select(*_KEYS, "pre", "parent", "tag", "title", *[v.alias(n) for n, v in own.items()])


def quiz_sections(files: DataFrame) -> DataFrame:
    """Sections, nested ones too, with a title or questions of their own: draw count, candidates, weight, question types."""
    return quiz_sections_of(xml_index.index(files, _KEYS, tags=_SECTION_TAGS))


def quiz_sections_of(index: DataFrame) -> DataFrame:
    """From the element index with one exchange: a section and its own questions are one family."""
    used = index.filter(F.col("tag").isin(*_SECTION_TAGS)).select(
        *_KEYS, "pre", "last", "parent", "tag", F.when(F.col("tag") == "section", xml_index.attribute("title")).alias("title"),
        F.when(F.col("tag").isin("fieldlabel", "fieldentry"), F.col("content")).alias("content"),
    )
    rows = xml_index.by_file(used, _KEYS)
    asked = F.col("tag").isin("item", "itemref")
    # the types go into one row a family, not into each of its questions; a file given twice has its sections twice
    families = _labelled(rows).groupBy(*_KEYS, F.when(asked, F.col("parent")).otherwise(F.col("pre")).alias("_family")).agg(
        F.collect_list(F.when(F.col("tag") == "section", F.struct("pre", "title", "draw_count", "points_per_question"))).alias("_s"),
        F.count(F.when(asked, 1)).cast("int").alias("candidate_count"),
        F.collect_list(F.when((F.col("tag") == "item") & (F.col("type") != ""), F.col("type"))).alias("question_types"),
    )
    sections = families.select(*_KEYS, F.explode("_s").alias("_s"), "candidate_count", "question_types").select(*_KEYS, "_s.*", "candidate_count", "question_types").select(
        *_KEYS, (F.row_number().over(W.partitionBy(*_KEYS).orderBy("pre")) - 1).alias("section_no"), clean(F.col("title")).alias("title"),
        "candidate_count", "draw_count", "points_per_question", "question_types",
    )
    return sections.filter("title <> '' or candidate_count > 0")


def quiz_rollup(sections: DataFrame) -> DataFrame:
    """Per quiz file: sections, candidates, drawn questions and the sorted question-type summary; a file's types are counted in its own row."""
    from ..functions.numbers import to_number

    totals = sections.groupBy(*_KEYS).agg(
        F.count("*").alias("sections"), F.sum("candidate_count").alias("candidates"),
        F.coalesce(F.sum(to_number(F.col("draw_count")).cast("bigint")), F.lit(0)).alias("drawn"),
        F.flatten(F.collect_list("question_types")).alias("_types"),
    )
    named = lambda t: F.concat(t, F.lit(": "), F.size(F.filter("_types", lambda x: x == t)).cast("string"))
    return totals.withColumn("question_types", F.array_join(F.transform(F.array_sort(F.array_distinct("_types")), named), "; ")).drop("_types")


def orgunits(files: DataFrame) -> DataFrame:
    """Identity evidence of the organisation-unit file."""
    e = F.from_xml("xml", "_identifier string, code string, name string", X.OPTIONS)
    return files.select("export_id", e.alias("e")).select(
        "export_id", F.nullif(X.field("e._identifier"), F.lit("")).alias("orgunit_identifier"),
        F.nullif(X.field("e.code"), F.lit("")).alias("orgunit_code"), F.nullif(X.field("e.name"), F.lit("")).alias("orgunit_name"),
    )
