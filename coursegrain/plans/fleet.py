"""All packages of a catalogue in one pass: files to silver tables, edges, findings and course models.

Every table is keyed by ``export_id``.  Tables that several others build on are
written once to the cluster's shared folder and read back: each archive is
parsed once, plans stay short, and a lost executor only re-reads a table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean, html_to_text
from ..operators import activities as A
from ..operators import blocks, duplicates, findings, gold, identity, model, pages, rubrics, silver, structure, tree
from ..operators import xml as X
from ..operators import xml_index
from ..session import shared_folder
from ..sources import packages

def stored(fn):
    """A table computed once, written to the shared folder and read back from there."""

    def get(self: Fleet) -> DataFrame:
        path = f"{self.store}/{fn.__name__}"
        fn(self).write.parquet(path)
        return self.raw.sparkSession.read.parquet(path)

    get.__name__, get.__doc__ = fn.__name__, fn.__doc__
    return cached_property(get)


_TOOLS = "coalesce(open_error, '') = ''"


class Fleet:
    """Tables of a catalogue.  ``files``: export_id, rel_path, bytes, sha256, content, open_error."""

    def __init__(self, files: DataFrame, config: DataFrame | None = None, store: str | None = None) -> None:
        self.raw = packages.without_junk(files)
        self.store = store or shared_folder(files.sparkSession, "silver")
        self.config = config

    # ----- package
    @stored
    def manifest_choice(self) -> DataFrame:
        return packages.manifests(self.raw.select("export_id", "rel_path"))

    @stored
    def files(self) -> DataFrame:
        return packages.rerooted(self.raw.filter(_TOOLS), self.manifest_choice)

    @cached_property
    def packages(self) -> DataFrame:
        whole = F.col("rel_path") == ""  # an archive that did not open; a member that did not is ``unreadable``
        return self.raw.groupBy("export_id").agg(F.max(F.when(whole, F.col("open_error"))).alias("open_error"), F.max(F.when(whole, F.col("sha256"))).alias("transport_sha256"))

    @cached_property
    def alt_findings(self) -> DataFrame:
        """Every location with images that lack alternative text; ``findings`` has the package's report line."""
        return findings.alt_findings(self.images_missing_alt)

    @cached_property
    def unreadable(self) -> DataFrame:
        """Members of opened archives that could not be read."""
        return self.raw.filter("open_error is not null and rel_path <> ''").select("export_id", "rel_path", "bytes", "open_error")

    @cached_property
    def inventory(self) -> DataFrame:
        return packages.inventory(self.files)

    @stored
    def fingerprints(self) -> DataFrame:
        return identity.fingerprints(self.files)

    @cached_property
    def lineage(self) -> DataFrame:
        named = identity.export_identity(self.packages.withColumn("source_name", F.col("export_id")), silver.orgunits(self.tool("orgunitconfig/orgunitconfig.xml")))
        return identity.lineage(named.join(self.fingerprints.select("export_id", "digest"), "export_id", "left"))

    def tool(self, pattern: str) -> DataFrame:
        return X.well_formed(packages.text_files(self.files, pattern))

    # ----- structure
    @stored
    def resources(self) -> DataFrame:
        return X.manifest_resources(self.tool("imsmanifest.xml"), ["export_id"])

    @stored
    def manifest_items(self) -> DataFrame:
        return xml_index.manifest_items(xml_index.index(packages.text_files(self.files, "imsmanifest.xml"), ["export_id"]), ["export_id"])

    @stored
    def quiz_index(self) -> DataFrame:
        """Elements of all quiz files; settings, sections and draw rules read it."""
        return xml_index.index(packages.text_files(self.files, "quiz_d2l_%.xml"), ["export_id", "rel_path"])

    @stored
    def _resolved(self) -> DataFrame:
        return structure.resolve_nodes(self.manifest_items, self.resources)

    @stored
    def nodes(self) -> DataFrame:
        hidden = tree.paths(tree.inherited_hidden(self._resolved))
        path = F.split_part(F.replace("href", F.lit("\\"), F.lit("/")), F.lit("?"), F.lit(1))
        have = self.files.select("export_id", F.col("rel_path").alias("page_path"), F.lit(True).alias("_have"))
        checked = hidden.withColumn("page_path", path).join(have, ["export_id", "page_path"], "left")
        needs = F.col("kind").isin("html_topic", "content_file") & (F.col("href") != "")
        return checked.withColumn("href_missing", needs & F.col("_have").isNull()).drop("_have")

    # ----- pages
    @stored
    def pages(self) -> DataFrame:
        """Readable HTML topics, hidden ones included and marked."""
        readable = self.nodes.filter("kind = 'html_topic' and href <> '' and not href_missing")
        body = self.files.select("export_id", F.col("rel_path").alias("page_path"), "content")
        rows = readable.select("export_id", "pos", "title", "href", "page_path", "is_hidden", "path").join(body, ["export_id", "page_path"])
        text = rows.withColumns({"binary": pages.binary_like(F.col("content")), "html": packages.as_text(F.col("content"))}).drop("content")
        return text.withColumn("rel_path", F.col("page_path")).withColumns({"html_title": pages.page_title(F.col("html")), "body_text": html_to_text(F.col("html"))})

    @stored
    def segments(self) -> DataFrame:
        return pages.segments(self.pages.filter("not binary"), ["export_id", "pos", "title", "href", "is_hidden"])

    @stored
    def blocks(self) -> DataFrame:
        # token rows have a position of their own
        fragments = self.segments.withColumnRenamed("pos", "topic_no")
        return blocks.blocks(fragments, ["export_id", "topic_no", "seg_no"]).withColumnRenamed("topic_no", "pos")

    # ----- activities
    @stored
    def grade_items(self) -> DataFrame:
        return silver.grade_items(self.tool("grades_d2l.xml"))

    @stored
    def quicklinks(self) -> DataFrame:
        return A.quicklink_counts(self.resources)

    @stored
    def activities(self) -> DataFrame:
        folders = silver.dropbox_folders(self.tool("dropbox_d2l.xml"))
        talks = silver.discussions(self.tool("discussion_d2l_%.xml"))
        lists = A.keep_linked(silver.checklists(self.tool("checklist_d2l.xml")), self.quicklinks, only_if_any_match=False).drop("links")
        quizzes = A.keep_linked(silver.quizzes_of(self.quiz_index), self.quicklinks, only_if_any_match=True).drop("links")
        every = findings.union([folders, talks, lists, quizzes])
        graded = A.with_grade_items(every, self.grade_items, ["pos"])
        conditions = silver.condition_codes(self.tool("conditionalrelease_d2l.xml"))
        return A.with_quicklinks(A.with_conditions(graded, conditions), self.quicklinks)

    @stored
    def edges(self) -> DataFrame:
        acts = self.activities.filter("kind <> 'forum'")
        links = A.rubric_links(acts, silver.rubric_names(self.tool("rubrics_d2l.xml")), ["export_id", "kind", "name", "resource_code", "pos"])
        return A.relationships(acts, links, A.orphan_grade_items(self.grade_items, acts))

    # ----- identity
    @cached_property
    def _scopes(self) -> DataFrame:
        return self.lineage.select("export_id", "source_lineage_key")

    @stored
    def structure_keys(self) -> DataFrame:
        return identity.structure_keys(self.nodes.join(self._scopes, "export_id"))

    @stored
    def entities(self) -> DataFrame:
        """Activities and grade items with their keys, and the names that edges use for them."""
        kinds = {"dropbox_folder": "assignment", "discussion_topic": "topic"}
        kind = F.coalesce(*[F.when(F.col("kind") == k, F.lit(v)) for k, v in kinds.items()], F.col("kind"))
        acts = self.activities.select("export_id", "kind", "name", "resource_code", "ident", "id", F.lit("").alias("identifier"), F.concat_ws("|", "source_file", "name").alias("_named"))
        items = self.grade_items.select("export_id", F.lit("grade_item").alias("kind"), "name", "resource_code", F.lit("").alias("ident"), "id", "identifier", F.concat_ws("|", "name", F.lit("")).alias("_named"))
        rows = acts.unionByName(items).join(self._scopes, "export_id")
        return identity.entity_keys(rows, kind, ["resource_code", "identifier", "ident", "id"], F.col("_named")).drop("_named")

    @stored
    def relationships(self) -> DataFrame:
        """Edges with their own keys and the keys of both ends."""
        counted = A.duplicate_ordinals(self.edges, "pos").join(self._scopes, "export_id")
        aliases = identity.entity_aliases(self.entities, ["resource_code", "identifier", "ident", "id"])
        return identity.edge_endpoints(identity.edge_keys(counted), aliases)

    @cached_property
    def rubrics(self) -> DataFrame:
        return rubrics.rubrics(self.tool("rubrics_d2l.xml"))

    # ----- course model
    @stored
    def modules(self) -> DataFrame:
        return tree.split_modules(self.nodes)

    @stored
    def members(self) -> DataFrame:
        return tree.module_members(self.modules, self.nodes.drop("path"))

    @stored
    def routed(self) -> DataFrame:
        """Routed page segments of every week, pages already shown before week 1 left out."""
        page = gold.topic_label(F.col("title"), F.lit(""), F.col("href"))
        topic = self.pages.select("export_id", F.col("pos").alias("topic_no"), "href", page.alias("title"), F.col("body_text").alias("body"))
        placed = self.members.select("export_id", "pos", "module_pos", "module_title", "role", "week_no").join(self.pages.select("export_id", "pos"), ["export_id", "pos"], "left_semi")
        early = placed.filter("role = 'before'").select("export_id", F.col("pos").alias("topic_no")).distinct()
        before, keyed = topic.join(early, ["export_id", "topic_no"], "left_semi"), duplicates.topic_keys(topic)
        exact = duplicates.exact_matches(keyed, duplicates.topic_keys(before)).select("export_id", "topic_no")
        near = duplicates.containment_matches(duplicates.token_sets(topic), duplicates.token_sets(before)).select("export_id", "topic_no")
        skipped = exact.unionByName(near).distinct().select("export_id", F.col("topic_no").alias("pos"))
        weekly = placed.filter("role = 'week'").join(skipped, ["export_id", "pos"], "left_anti")
        text = self.blocks.groupBy("export_id", "pos", "seg_no").agg(F.count("*").alias("n_blocks"))
        segs = self.segments.withColumn("page", page).join(weekly, ["export_id", "pos"]).join(text, ["export_id", "pos", "seg_no"], "left")
        full = pages.heading_ancestors(segs, ["export_id", "module_pos", "pos"])
        locks = gold.overview_locks(weekly.join(self.pages.select("export_id", "pos", page.alias("page")), ["export_id", "pos"])).select("export_id", "module_pos", "locked")
        headed = self.segments.groupBy("export_id", "pos").agg(F.bool_or(F.col("heading") != "").alias("has_headings"))
        ready = full.join(locks, ["export_id", "module_pos"]).join(headed, ["export_id", "pos"]).withColumn("has_blocks", F.coalesce("n_blocks", F.lit(0)) > 0)
        return gold.route(ready)

    @cached_property
    def week_sections(self) -> DataFrame:
        return gold.week_sections(self.routed)

    @cached_property
    def unplaced(self) -> DataFrame:
        return gold.unplaced(self.activities, tree.placed_codes(self.members.filter("role = 'week'")))

    @stored
    def segment_texts(self) -> DataFrame:
        return self.segments.select("export_id", "pos", "seg_no", "heading", html_to_text(F.col("fragment")).alias("body"))

    @stored
    def activity_texts(self) -> DataFrame:
        """What a course document shows of an activity."""
        acts = self.activities.withColumn("list", A.week_list(F.col("kind"))).filter("list is not null")
        return acts.select("export_id", "kind", "name", F.col("resource_code").alias("rcode"), "pos", "list", html_to_text(F.col("html")).alias("body"))

    @stored
    def front_matter(self) -> DataFrame:
        """Four fields of each package from its own pages; linked syllabus texts are joined by ``gold.front_matter`` where a crawl has them."""
        topics = self.pages.select("export_id", F.col("pos").alias("topic_no"), F.col("title").alias("manifest_title"), "html_title", "is_hidden", F.col("body_text").alias("body"))
        segs = self.segment_texts.select("export_id", F.col("pos").alias("topic_no"), "seg_no", "heading", F.col("body").alias("text"))
        none = self.raw.sparkSession.createDataFrame([], "export_id string, field string, ref_no int, url string, text string")
        return gold.front_matter(self.packages.select("export_id"), gold.front_matter_candidates(topics, segs), none)

    @stored
    def course_entries(self) -> DataFrame:
        """Everything that a course document holds, an entry a row: fields, pages before week 1, weeks with pages, activities and hidden items, what is placed nowhere, diagnostics."""
        members = self.members.select("export_id", "pos", "module_pos", "module_title", "role", "week_no")
        week = {"group_no": F.col("module_pos"), "group_title": F.col("module_title")}
        nothing, order = F.lit(None).cast("string"), F.col("pos") * 100_000 + F.col("seg_no")
        body = self.segment_texts.drop("heading")
        shown = model.entries(self.week_sections.join(body, ["export_id", "pos", "seg_no"]), "weeks", F.col("section"), order, model.section(F.col("section_label"), F.col("page"), F.col("body")), **week)
        first = tree.placed_codes(self.members.filter("role = 'week'"))
        activity = model.section(F.col("name"), nothing, F.col("body"))
        tools = model.entries(first.join(self.activity_texts.drop("pos"), ["export_id", "rcode"]), "weeks", F.col("list"), F.col("pos") * 100_000, activity, **week)
        hidden = structure.hidden_records(self.nodes).filter("treatment in ('file', 'link')").join(members.filter("role = 'week'"), ["export_id", "pos"])
        covered = model.entries(hidden, "weeks", gold.hidden_section(F.col("kind")), F.col("pos") * 100_000 + 99_999, model.section(F.concat(F.lit("Hidden: "), "object_name"), nothing, F.col("href")), **week)
        filled = self.front_matter.filter("field = 'course_introduction' and text is not null").select("export_id")
        page = gold.topic_label(F.col("title"), F.lit(""), F.col("href"))
        early = self.pages.join(members.filter("role = 'before'").select("export_id", "pos"), ["export_id", "pos"]).select("export_id", "pos", "href", page.alias("page"), "title", "is_hidden")
        before = model.entries(gold.before_week_pages(early, filled).join(body, ["export_id", "pos"]), "before_week_1", F.lit("sections"), order, model.section(F.lit(""), F.col("page"), F.col("body")))
        front = model.entries(self.front_matter.filter("text is not null"), "front_matter", F.col("field"), F.lit(0), model.section(F.lit(""), nothing, F.col("text")))
        nowhere = self.activity_texts.filter("kind <> 'checklist'").join(first.select("export_id", "rcode").distinct(), ["export_id", "rcode"], "left_anti")
        loose = model.entries(nowhere, "unplaced_activities", F.col("list"), F.col("pos"), activity)
        line = model.text(F.concat(F.lit("Routing: "), "module_title", F.lit(": "), "routing_note", F.lit(".")))
        routing = model.entries(self.routed.filter("routing_note is not null"), "diagnostics", F.lit("lines"), order, line)
        notes = model.entries(gold.front_matter_findings(self.front_matter), "diagnostics", F.lit("lines"), F.lit(-1), model.text(F.col("message")))
        return findings.union([shown, tools, covered, before, front, loose, routing, notes])

    @stored
    def course_model(self) -> DataFrame:
        """Each course as a nested document, see ``model``."""
        return model.documents(self.course_entries)

    # ----- rules
    @cached_property
    def dated(self) -> DataFrame:
        items = self.manifest_items.filter("date_due <> ''")
        folders = self.activities.filter("kind = 'dropbox_folder' and date_due <> ''")
        named = lambda df, what, name: df.select("export_id", F.concat(F.lit(f"{what} '"), name, F.lit("' date_due")).alias("label"), F.col("date_due").alias("raw_date"))
        return named(folders, "dropbox folder", F.col("name")).unionByName(named(items, "manifest item", F.col("title")))

    @cached_property
    def texts(self) -> DataFrame:
        act = self.activities.filter("kind in ('dropbox_folder', 'discussion_topic', 'quiz')")
        tool = act.select("export_id", F.concat("kind", F.lit(" '"), "name", F.lit("'")).alias("label"), F.col("html").alias("text"))
        topic = self.pages.select("export_id", F.concat(F.lit("html topic '"), "title", F.lit("'")).alias("label"), F.col("body_text").alias("text"))
        return tool.unionByName(topic)

    @stored
    def images_missing_alt(self) -> DataFrame:
        page = pages.images_missing_alt(self.pages.filter("not is_hidden").withColumn("location", F.col("href")), ["export_id", "location"])
        tool = pages.images_missing_alt(self.activities.withColumn("location", F.concat("kind", F.lit(" '"), "name", F.lit("'"))), ["export_id", "location"], html="html")
        return page.unionByName(tool)

    @stored
    def findings(self) -> DataFrame:
        """Every rule over every package, one row per finding."""
        ids = self.packages.filter("open_error is null").select("export_id")
        config = self.config if self.config is not None else ids.select(
            "export_id", F.lit(None).cast("date").alias("term_start"), F.lit(None).cast("date").alias("term_end"), F.lit(None).cast("double").alias("expected_total")
        )
        tool_files = self.files.filter("rel_path like '%.xml'").select("export_id", "rel_path", packages.as_text(F.col("content")).alias("xml"))
        shown = self.pages.filter("not binary")
        refs = pages.references(shown, ["export_id", "rel_path", "title"])
        lost = pages.missing_references(refs, self.files).join(shown.select("export_id", "rel_path", "title").distinct(), ["export_id", "rel_path"])
        quizzes = self.activities.filter("kind = 'quiz'")
        sections = silver.quiz_sections_of(self.quiz_index).join(
            quizzes.select("export_id", F.col("source_file").alias("rel_path"), F.col("name").alias("quiz")), ["export_id", "rel_path"], "left"
        )
        linked = structure.linked_paths(self.nodes)
        unlinked = structure.file_scope(structure.unlinked_files(self.files.select("export_id", "rel_path", "bytes"), linked))
        hidden_files = structure.file_scope(self.files.select("export_id", "rel_path", "bytes").join(linked.filter("hidden"), ["export_id", "rel_path"], "left_semi"))
        records = structure.hidden_records(self.nodes)
        return findings.union([
            packages.reroot_notes(self.manifest_choice), findings.unreadable_members(self.unreadable),
            findings.missing_components(ids, self.files), findings.malformed_xml(X.malformed(tool_files, ["export_id", "rel_path"])),
            A.join_findings(self.edges), findings.orphans(A.orphan_grade_items(self.grade_items, self.activities)),
            findings.quiz_grade_breaks(self.activities.filter("kind = 'quiz'"), self.grade_items), findings.quiz_draws(sections), findings.points_mismatches(A.points_mismatch(self.activities.filter("kind = 'dropbox_folder'"))),
            findings.dates(self.dated, config), findings.gradebook_total(ids, self.grade_items, config), findings.gradebook_items(self.grade_items), findings.duplicate_names(self.grade_items),
            findings.placeholders(self.texts), findings.missing_alt(self.images_missing_alt), findings.week_gaps(self.nodes.filter("depth = 1")),
            findings.broken_hrefs(self.nodes, self.files), findings.unresolved_refs(self.nodes), findings.broken_references(lost), findings.empty_pages(shown.filter("not is_hidden")),
            structure.skipped_files(self.nodes), structure.hidden_findings(records, tree.descendant_counts(self.nodes)),
            structure.scope_findings(hidden_files, "hidden manifest-linked non-HTML files preserved as references"),
            structure.scope_findings(unlinked, "files not directly linked from the visible manifest", " (may include support assets referenced inside HTML pages)"),
        ])

    @cached_property
    def severity(self) -> DataFrame:
        return findings.severity_counts(self.findings)

    @cached_property
    def gate(self) -> DataFrame:
        return findings.gate(self.packages, self.findings)
