"""Per-course models: section routing, weeks, front matter, documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import classify
from ..functions.text import clean_label, clean_text, contains_any
from .pages import heading_path, path_label
from .scan import first_per, previous


def topic_label(manifest_title: Column, html_title: Column, href: Column) -> Column:
    pick = F.coalesce(F.nullif(manifest_title, F.lit("")), F.nullif(html_title, F.lit("")), href, F.lit(""))
    return clean_text(pick)


def overview_locks(members: DataFrame) -> DataFrame:
    """Modules that hold both an overview page and a separate resources page.  ``members``: export_id, module_pos, page."""
    bucket = classify.heading_bucket(F.col("page"), page_title=True)
    flags = members.withColumn("_b", bucket).groupBy("export_id", "module_pos").agg(
        F.bool_or(F.coalesce(F.col("_b") == "overview", F.lit(False))).alias("has_overview"),
        F.bool_or(F.coalesce(F.col("_b") == "resources", F.lit(False))).alias("has_resources"),
    )
    return flags.withColumn("locked", F.col("has_overview") & F.col("has_resources"))


def route(segs: DataFrame) -> DataFrame:
    """Bucket, label and note of every page segment.

    ``segs``: page, heading, level, up_1..up_4, has_headings (any heading on the
    page), has_blocks, locked.  A page without headings is one entry (segment 0).
    """
    staged = segs.withColumns(
        {
            "_page_bucket": classify.heading_bucket(F.col("page"), page_title=True),
            "_own": classify.heading_bucket(F.col("heading")),
            "_default": classify.page_default_bucket(F.col("page")),
            "_path": path_label(F.col("page"), heading_path(segs)),
        }
    )
    page_bucket, own = F.col("_page_bucket"), F.col("_own")
    fallback = F.coalesce(page_bucket, F.col("_default"))
    is_overview = F.coalesce(page_bucket == "overview", F.lit(False))
    intro = F.col("heading") == ""
    plain = ~F.col("has_headings")
    kept = is_overview & F.col("locked") & F.coalesce(own == "resources", F.lit(False))
    drawn_in = is_overview & ~F.coalesce(own.isin("objectives", "resources", "checklist"), F.lit(False))
    bucket = (
        F.when(plain, fallback)
        .when(intro, F.coalesce(page_bucket, F.lit("overview")))
        .when(kept | drawn_in, "overview")
        .otherwise(F.coalesce(own, fallback))
    )
    label = (
        F.when(plain, F.col("page"))
        .when(intro, F.when(page_bucket.isNotNull(), F.col("page")).otherwise(""))
        .when(kept | drawn_in | own.isNotNull() | (fallback != "other"), F.col("heading"))
        .otherwise(F.col("_path"))
    )
    note = F.when(
        ~plain & ~intro & kept,
        F.concat(
            F.lit("resource-like heading '"), "heading", F.lit("' from overview page '"), "page",
            F.lit("' kept in Overview because the module also has a separate resources/materials page"),
        ),
    )
    return (
        staged.filter("has_blocks or heading <> ''")
        .withColumns({"bucket": bucket, "label": label, "routing_note": note})
        .withColumn("level", F.when(plain | intro, 0).otherwise(F.col("level")))
        .drop("_page_bucket", "_own", "_default", "_path")
    )


def week_sections(routed: DataFrame) -> DataFrame:
    """Routed entries with blocks to the sections of a week.

    Practice, assessment and lesson entries are kept under ``other_sections``.
    """
    b = F.col("bucket")
    section = (
        F.when(b == "overview", "overview").when(b == "objectives", "learning_objectives").when(b == "resources", "resources")
        .when(b == "checklist", "checklist").otherwise("other_sections")
    )
    bare = clean_label(F.col("label"))
    overview_label = F.when(F.lower(bare).isin(*K.BARE_OVERVIEW_LABELS) | (bare == ""), "").otherwise(F.concat(bare, F.lit(":")))
    label = (
        F.when(b == "overview", overview_label).when(b == "objectives", "")
        .otherwise(F.coalesce(F.nullif("label", F.lit("")), F.col("page")))
    )
    return routed.filter("has_blocks").withColumns({"section": section, "section_label": label})


_TOOL_SECTION = {"assignments": ("dropbox_link", "quiz_link"), "discussions": ("discussion_link",), "checklist": ("checklist_link",)}


def hidden_section(kind: Column) -> Column:
    """Week section that shows a hidden manifest item without a page of its own."""
    out = F.when(F.lit(False), "")
    for section, kinds in _TOOL_SECTION.items():
        out = out.when(kind.isin(*kinds), section)
    return out.otherwise("other_sections")


def before_week_labels(routed: DataFrame, keep: list[str]) -> DataFrame:
    """Local heading label of each entry before week 1; a label repeated from the entry above is left out.

    ``routed`` is one row per entry with a consecutive ``ord`` inside ``keep``.
    """
    label, page = clean_label(F.col("label")), clean_label(F.col("page"))
    local = clean_label(F.element_at(F.split(F.col("_l"), "›"), -1))
    staged = routed.withColumns({"_l": label, "_p": page}).withColumn(
        "local_label", F.when(F.col("_l") == "", "").when((F.col("_p") != "") & (F.lower(local) == F.lower("_p")), "").otherwise(local)
    ).drop("_l", "_p")
    prior = previous(staged, keep, "ord", {"local_label": "_before"})
    same = F.lower("local_label") == F.lower(F.coalesce("_before", F.lit("")))
    return prior.withColumn("shown_label", F.when((F.col("local_label") != "") & ~same, F.concat("local_label", F.lit(":"))).otherwise("")).drop("_before")


def before_week_pages(topics: DataFrame, skip_introduction: DataFrame) -> DataFrame:
    """Pages shown before week 1: first topic per href, introduction pages only where the field is still empty.

    ``topics``: export_id, pos, href, page, title, is_hidden; ``skip_introduction``: packages whose introduction is filled.
    """
    intro = classify.is_course_introduction(F.col("title"), F.col("is_hidden"))
    flagged = topics.join(skip_introduction.select("export_id", F.lit(True).alias("_filled")).distinct(), "export_id", "left")
    open_rows = flagged.filter(~(intro & F.coalesce("_filled", F.lit(False)))).drop("_filled")
    linked = first_per(open_rows.filter("href <> ''"), ["export_id", "href"], ["pos"])
    return linked.unionByName(open_rows.filter("href = ''"))


def dividers(sections: DataFrame, keep: list[str], mode: str) -> DataFrame:
    """Whether a divider stands before each section: ``page`` only between two known, different pages; ``object`` always."""
    before = previous(sections, keep, "ord", {"source_page": "_before"})
    here, there = clean_text(F.col("source_page")), clean_text(F.coalesce("_before", F.lit("")))
    if mode == "page":
        decided = F.col("_before").isNotNull() & (here != "") & (there != "") & (here != there)
    else:
        decided = F.col("_before").isNotNull()
    return before.withColumn("divider", decided).drop("_before")


def front_matter_candidates(topics: DataFrame, segs: DataFrame) -> DataFrame:
    """Course-level fields found in package pages: a heading match first, then a page-title match.

    ``topics``: export_id, topic_no, manifest_title, html_title, is_hidden, body;
    ``segs``: export_id, topic_no, seg_no, heading, text (text empty when the segment has no blocks).
    """
    fields = F.array(*[F.lit(f) for f in K.FRONT_MATTER_TITLE_WORDS])
    title = F.concat("manifest_title", F.lit(" "), "html_title")
    visible = topics.filter(~F.col("is_hidden")).withColumn("_title", title).withColumn("_week", classify.is_weekish(F.col("_title")))

    def hits(column: Column, words: dict) -> Column:
        low = F.lower(column)
        return F.array_compact(F.array(*[F.when(contains_any(low, ws), F.lit(f)) for f, ws in words.items()]))

    headed = (
        segs.filter("heading <> '' and text <> ''").select("export_id", "topic_no", "seg_no", "text", F.explode(hits(F.col("heading"), K.FRONT_MATTER_HEADING_WORDS)).alias("field"))
        .join(visible.filter(~F.col("_week")).select("export_id", "topic_no"), ["export_id", "topic_no"], "left_semi")
        .select("export_id", "field", F.lit(1).alias("pass"), "topic_no", "seg_no", "text")
    )
    scoped_too = F.col("field").isin("course_description", "course_introduction")
    titled = (
        visible.filter("body <> ''").select("export_id", "topic_no", "_week", F.col("body").alias("text"), F.explode(hits(F.col("_title"), K.FRONT_MATTER_TITLE_WORDS)).alias("field"))
        .filter(~F.col("_week") | scoped_too)
        .select("export_id", "field", F.lit(2).alias("pass"), "topic_no", F.lit(0).alias("seg_no"), "text")
    )
    return headed.unionByName(titled)


def front_matter(packages: DataFrame, candidates: DataFrame, syllabus: DataFrame) -> DataFrame:
    """Four fields per package: package text, else the linked syllabus unless its texts conflict, else needs review.

    ``syllabus``: export_id, field, ref_no, url, text.
    """
    best = first_per(candidates, ["export_id", "field"], ["pass", "topic_no", "seg_no"]).select("export_id", "field", F.col("text").alias("_own"))
    norm = F.lower(clean_text(F.col("text")))
    linked = syllabus.filter("text <> ''").withColumn("_n", norm).groupBy("export_id", "field").agg(
        F.count_distinct("_n").alias("_texts"), F.count("*").alias("_refs"), F.min_by(F.struct("text", "url"), "ref_no").alias("_s")
    )
    wanted = packages.select("export_id", F.explode(F.array(*[F.lit(f) for f in K.FRONT_MATTER_TITLE_WORDS])).alias("field"))
    joined = wanted.join(best, ["export_id", "field"], "left").join(linked, ["export_id", "field"], "left")
    usable = F.col("_texts") == 1
    origin = (
        F.when(F.col("_own").isNotNull(), "package").when(usable, "syllabus").otherwise("needs_review")
    )
    state = (
        F.when(F.col("_own").isNotNull() & F.col("_refs").isNotNull(), "compared").when(F.col("_own").isNotNull(), "package")
        .when(usable, "supplemented").when(F.col("_refs") > 1, "conflicting").otherwise("not_found")
    )
    return joined.select(
        "export_id", "field", origin.alias("origin"), state.alias("state"),
        F.when(F.col("_own").isNotNull(), F.col("_own")).when(usable, F.col("_s.text")).alias("text"), F.when(usable | F.col("_own").isNotNull(), F.col("_s.url")).alias("syllabus_url"),
    )


def front_matter_findings(fields: DataFrame) -> DataFrame:
    from .findings import finding

    label = F.when(F.lit(False), "")
    for field, text in (("course_description", "Course Description"), ("required_materials", "Textbook/s or Required Materials"), ("course_learning_outcomes", "Course Learning Outcomes"), ("course_introduction", "Course Introduction")):
        label = label.when(F.col("field") == field, text)
    message = (
        F.when(F.col("state") == "compared", F.concat(F.lit("Linked syllabus comparison: "), label, F.lit("; package-local content retained as primary")))
        .when(F.col("state") == "supplemented", F.concat(F.lit("Front matter: "), label, F.lit(" not found in package-local course pages; supplemented verbatim from the linked syllabus "), F.col("syllabus_url")))
        .when(F.col("state") == "conflicting", F.concat(F.lit("Front matter: "), label, F.lit(" has conflicting linked-syllabus candidates; none was promoted automatically.")))
        .otherwise(F.concat(F.lit("Front matter: "), label, F.lit(" not found; rendered as Needs review.")))
    )
    return finding(fields.filter("state <> 'package'"), "B09", "notes", "front_matter", F.col("field"), message)


def unplaced(activities: DataFrame, placed: DataFrame) -> DataFrame:
    """Folders, topics and quizzes whose code is placed in no module."""
    kinds = activities.filter(F.col("kind").isin("dropbox_folder", "discussion_topic", "quiz"))
    return kinds.join(placed.select("export_id", F.col("rcode").alias("resource_code")).distinct(), ["export_id", "resource_code"], "left_anti")


def document_parts(sections: DataFrame, columns: list[str], size: int = 1000) -> DataFrame:
    """Nested JSON of each course in parts of at most ``size`` sections.

    The parts of a course, read in order, are its whole document; a course of any
    length never has to fit into one row.
    """
    part = F.floor(F.col("ord") / size).cast("int")
    rows = F.transform(F.array_sort(F.collect_list(F.struct("ord", *columns))), lambda s: F.struct(*[s[c].alias(c) for c in columns]))
    return sections.withColumn("part", part).groupBy("export_id", "part").agg(F.to_json(rows).alias("sections"), F.count("*").alias("n_sections"))


def report_lines(sections: DataFrame) -> DataFrame:
    """Ordered report lines, one row per line; every section is a heading line and a body line."""
    rows = sections.select("export_id", "ord", F.posexplode(F.array(
        F.when(F.col("label") != "", F.concat(F.lit("**"), "label", F.lit(":**"))), F.nullif("body", F.lit("")),
    )).alias("sub", "line"))
    return rows.filter("line is not null").select("export_id", (F.col("ord") * 2 + F.col("sub")).alias("ord"), "line")


def needs_review(packages: DataFrame, fields: DataFrame) -> DataFrame:
    """Expected front-matter cells without text."""
    wanted = packages.select("export_id", F.explode(F.array(*[F.lit(f) for f in K.FRONT_MATTER_TITLE_WORDS])).alias("field"))
    have = fields.filter("text is not null").select("export_id", "field", F.lit(1).alias("_hit"))
    return wanted.join(have, ["export_id", "field"], "left").groupBy("export_id").agg(F.count_if(F.col("_hit").isNull()).alias("needs_review"))
