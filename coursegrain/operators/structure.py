"""Manifest nodes, their topics and the package's file scope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import classify, paths
from ..functions.numbers import format_bytes
from ..functions.text import clean, quoted
from .scan import first_per, top_per


def resolve_nodes(items: DataFrame, resources: DataFrame, res_order: str = "pos") -> DataFrame:
    """Items joined to their resource (last duplicate wins): kind, href, activity code."""
    last = first_per(resources, ["export_id", "identifier"], [F.col(res_order).desc()]).select(
        "export_id", F.col("identifier").alias("identifierref"), "material_type", F.col("href").alias("_href"), F.lit(True).alias("_hit")
    )
    kids = items.filter("parent_pos is not null").select("export_id", F.col("parent_pos").alias("pos"), F.lit(True).alias("_kids")).distinct()
    joined = items.join(last, ["export_id", "identifierref"], "left").join(kids, ["export_id", "pos"], "left")
    found = F.coalesce("_hit", F.lit(False))
    out = joined.withColumns({"href": F.coalesce("_href", F.lit("")), "resource_found": found, "has_children": F.coalesce("_kids", F.lit(False))})
    return out.withColumns(
        {
            "kind": classify.node_kind(F.col("resource_type_key"), F.col("resource_found"), F.col("material_type"), F.col("href"), F.col("has_children")),
            "rcode": F.regexp_extract("href", K.ACTIVITY_CODE, 1),
        }
    ).drop("_href", "_hit", "_kids", "material_type")


def hidden_records(nodes: DataFrame) -> DataFrame:
    """What each hidden item becomes; nothing hidden is dropped.

    Readable hidden pages are only marked here, their body comes from the page tables.
    """
    label = classify.hidden_label(F.col("kind"), F.col("href"))
    name = F.coalesce(F.nullif(clean(F.col("title")), F.lit("")), F.nullif(clean(F.col("href")), F.lit("")), F.lit("hidden manifest item"))
    treatment = (
        F.when(F.col("kind") == "module", "module")
        .when((F.col("kind") == "html_topic") & (F.col("href") != "") & ~F.col("href_missing"), "page")
        .when((F.col("kind") == "content_file") & (F.col("href") != ""), "file")
        .when((F.col("href") != "") | (F.col("description") != ""), "link")
    )
    return nodes.filter("is_hidden").withColumn("treatment", treatment).filter("treatment is not null").select(
        "export_id", "pos", "kind", "title", "href", "treatment", name.alias("object_name"), label.alias("item_type"),
        classify.node_label(F.col("kind")).alias("type_label"),
    )


def hidden_findings(records: DataFrame, descendants: DataFrame) -> DataFrame:
    from .findings import finding

    joined = records.join(descendants.select("export_id", "pos", "descendants"), ["export_id", "pos"], "left")
    title = quoted(F.col("title"))
    message = (
        F.when(F.col("treatment") == "module", F.concat(F.lit("hidden module "), title, F.lit(": included as hidden/faculty-facing section with "), F.coalesce("descendants", F.lit(0)).cast("string"), F.lit(" descendant item(s)")))
        .when(F.col("treatment") == "page", F.concat(F.lit("hidden content "), title, F.lit(": included as hidden/faculty-facing HTML body: "), F.col("href")))
        .when(F.col("treatment") == "file", F.concat(F.lit("hidden content "), title, F.lit(": preserved as hidden/faculty-facing file reference: "), F.col("href")))
        .otherwise(F.concat(F.lit("hidden content "), title, F.lit(": included as hidden/faculty-facing manifest link")))
    )
    return finding(joined, "R16", "notes", F.col("kind"), F.col("title"), message)


def skipped_files(nodes: DataFrame) -> DataFrame:
    from .findings import finding

    rows = nodes.filter((F.col("kind") == "content_file") & (F.col("href") != "") & ~F.col("is_hidden"))
    return finding(rows, "R16", "notes", "content_file", F.col("title"), F.concat(F.lit("content file "), quoted(F.col("title")), F.lit(": body extraction skipped for non-HTML file: "), F.col("href")))


def node_topics(nodes: DataFrame, topics: DataFrame, order: str = "topic_no") -> DataFrame:
    """Topic of each node: by href, else by title; the last duplicate wins on both."""
    by_href = first_per(topics.filter("href <> ''"), ["export_id", "href"], [F.col(order).desc()]).select("export_id", "href", F.col(order).alias("_by_href"))
    by_title = first_per(topics.filter("manifest_title <> ''"), ["export_id", "manifest_title"], [F.col(order).desc()]).select(
        "export_id", F.col("manifest_title").alias("title"), F.col(order).alias("_by_title")
    )
    return (
        nodes.join(by_href, ["export_id", "href"], "left").join(by_title, ["export_id", "title"], "left")
        .withColumn(order, F.coalesce("_by_href", "_by_title")).drop("_by_href", "_by_title")
    )


def linked_paths(nodes: DataFrame) -> DataFrame:
    """Package paths the manifest points at; hidden only when every pointer is a hidden content file."""
    local = nodes.filter(paths.is_local_href(F.col("href"))).select(
        "export_id", paths.href_path_part(F.col("href")).alias("rel_path"), (F.col("is_hidden") & (F.col("kind") == "content_file")).alias("_hidden"),
    )
    return local.filter("rel_path <> ''").groupBy("export_id", "rel_path").agg(
        F.bool_or(~F.col("_hidden")).alias("visible"), F.bool_or("_hidden").alias("hidden")
    )


def unlinked_files(files: DataFrame, linked: DataFrame) -> DataFrame:
    """Package files no manifest item points at, core files excepted."""
    core = (paths.file_category(F.col("rel_path"), "scope") == "d2l_xml") | F.lower(paths.file_name(F.col("rel_path"))).isin(*K.CORE_FILES_SCOPE)
    return files.filter(~core).join(linked.select("export_id", "rel_path"), ["export_id", "rel_path"], "left_anti")


def file_scope(files: DataFrame, types_shown: int = 6, files_shown: int = 8) -> DataFrame:
    """One summary text per package: totals, biggest types and biggest files (both top-k lists)."""
    typed = files.withColumn("category", paths.file_category(F.col("rel_path"), "scope"))
    by_type = typed.groupBy("export_id", "category").agg(F.count("*").alias("n"), F.sum("bytes").alias("b"))
    totals = by_type.groupBy("export_id").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    line = F.concat("category", F.lit(": "), F.col("n").cast("string"), F.lit(" / "), format_bytes(F.col("b")))
    types = top_per(by_type.withColumn("_l", line), ["export_id"], [F.col("b").desc(), "category"], types_shown)
    big_line = F.concat("rel_path", F.lit(" ("), format_bytes(F.col("bytes")), F.lit(")"))
    big = top_per(typed.withColumn("_l", big_line), ["export_id"], [F.col("bytes").desc(), "rel_path"], files_shown)

    def listed(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("export_id").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank_no", "_l"))), lambda s: s["_l"]), ", ").alias(name)
        )

    summary = F.concat(
        F.col("n").cast("string"), F.lit(" file(s), "), format_bytes(F.col("b")), F.lit(" total; by type: "), F.col("types"), F.lit("; largest: "), F.col("largest"),
    )
    return totals.join(listed(types, "types"), "export_id").join(listed(big, "largest"), "export_id").select(
        "export_id", F.col("n").alias("n_files"), F.col("b").alias("bytes"), summary.alias("summary")
    )


def file_scope_rows(files: DataFrame) -> DataFrame:
    """Every type and every file of a package with its size; ``file_scope`` is the short report."""
    typed = files.withColumn("category", paths.file_category(F.col("rel_path"), "scope"))
    by_type = typed.groupBy("export_id", F.col("category").alias("name")).agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    by_file = typed.select("export_id", F.col("rel_path").alias("name"), F.lit(1).cast("bigint").alias("n"), F.col("bytes").cast("bigint").alias("bytes"))
    return by_type.withColumn("part", F.lit("type")).unionByName(by_file.withColumn("part", F.lit("file"))).select("export_id", "part", "name", "n", "bytes")


def scope_findings(summary: DataFrame, label: str, tail: str = "") -> DataFrame:
    from .findings import finding

    return finding(summary, "R16", "notes", "package", F.col("export_id"), F.concat(F.lit(f"Package scope: {label}: "), F.col("summary"), F.lit(tail)))


def syllabus_links(nodes: DataFrame, runs: DataFrame) -> DataFrame:
    """Syllabus references: manifest links, then links inside pages that are not already known.

    ``nodes``: title, href, identifier, path, pos, is_hidden.  ``runs``: page_href, page_title, url, text, ord.
    """
    web = lambda c: c.startswith("http://") | c.startswith("https://")
    about = lambda title, url: F.contains(F.lower(title), F.lit("syllab")) | F.contains(F.lower(url), F.lit("syllab"))
    direct = nodes.filter(web(F.col("href")) & about(F.col("title"), F.col("href"))).withColumn(
        "_key", F.coalesce(F.nullif("identifier", F.lit("")), F.col("title"))
    )
    direct = first_per(direct, ["export_id", "href", "_key"], ["pos"]).select(
        "export_id", F.col("href").alias("url"), F.coalesce(F.nullif("title", F.lit("")), F.lit("Syllabus")).alias("title"), F.col("path").alias("manifest_path"), "is_hidden",
        F.lit("manifest_item_link").alias("discovery"),
    )
    inner = runs.filter(web(F.col("url")) & about(F.col("text"), F.col("url"))).join(direct.select("export_id", "url").distinct(), ["export_id", "url"], "left_anti")
    inner = first_per(inner, ["export_id", "url"], ["ord"])
    placement = first_per(
        nodes.filter(paths.is_local_href(F.col("href"))).select("export_id", paths.href_path_part(F.col("href")).alias("_page"), "path", "is_hidden", "pos"),
        ["export_id", "_page"], ["pos"],
    ).select("export_id", "_page", F.col("path").alias("_path"), F.col("is_hidden").alias("_hidden"))
    text = clean(F.col("text"))
    where = F.coalesce(F.nullif("_path", F.lit("")), clean(F.col("page_title")))
    nested = inner.withColumn("_page", paths.href_path_part(F.col("page_href"))).join(placement, ["export_id", "_page"], "left").select(
        "export_id", "url", F.coalesce(F.nullif(text, F.lit("")), F.lit("Syllabus")).alias("title"),
        F.array_join(F.filter(F.array(where, text), lambda p: p != ""), " > ").alias("manifest_path"), F.coalesce("_hidden", F.lit(False)).alias("is_hidden"),
        F.lit("package_html_link").alias("discovery"),
    )
    return direct.unionByName(nested)


def allowed_host(urls: DataFrame, hosts: DataFrame) -> DataFrame:
    """Whether a URL's host is an allowed host or a sub-domain of one.

    Every dot-suffix of the host is looked up by an equi-join; no pairwise comparison.
    """
    host = paths.url_host(F.col("url"))
    parts = F.split(F.col("host"), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    known = hosts.select(F.lower("host").alias("_s")).distinct()
    looked = urls.withColumn("host", host).withColumn("_s", F.explode(suffixes)).join(known.withColumn("_hit", F.lit(1)), "_s", "left")
    return looked.groupBy(*urls.columns, "host").agg((F.count("_hit") > 0).alias("allowed"))


def heading_score(field: str, heading: Column, parents: Column) -> Column:
    """How well a syllabus heading names a front-matter field; -1 is no match."""
    v, p = heading, parents
    has = lambda w: F.contains(v, F.lit(w))
    if field == "course_description":
        out = F.when(v == "course description", 130).when(v == "description", 120).when(has("course description"), 110).when(v.endswith("description"), 50)
    elif field == "course_learning_outcomes":
        out = (
            F.when(has("program") & ~has("course"), -1)
            .when(v.isin("course learning outcomes", "course outcomes", "student learning outcomes"), 140)
            .when(has("course") & (has("outcome") | has("objective")), 130)
            .when(v == "learning objectives and outcomes", 115)
            .when(has("learning outcome"), 105)
            .when(has("objective") & F.contains(p, F.lit("course")), 90)
        )
    else:
        topics = ("material", "text", "reading", "resource")
        any_of = lambda c: F.contains(c, F.lit(topics[0])) | F.contains(c, F.lit(topics[1])) | F.contains(c, F.lit(topics[2])) | F.contains(c, F.lit(topics[3]))
        out = (
            F.when(v.isin("required materials", "required course materials", "required texts", "textbooks"), 140)
            .when(v.isin("required", "required readings", "required textbooks") & any_of(p), 135)
            .when(has("required") & any_of(v), 130)
            .when(v.isin("materials", "course materials"), 90)
            .when(has("textbook"), 100)
        )
    return F.when(v == "", -1).otherwise(F.coalesce(out, F.lit(-1)))


SYLLABUS_FIELDS = ("course_description", "course_learning_outcomes", "required_materials")


def syllabus_sections(segs: DataFrame, texts: DataFrame, keep: list[str]) -> DataFrame:
    """Best section per field: highest score, then earliest, among sections that hold text.

    ``segs`` carry heading, level, up_1..up_4 and last_seg; ``texts`` the text of each segment.
    """
    value = F.lower(F.regexp_replace(F.regexp_replace("heading", r"\s+", " "), r"^[ :]+|[ :]+$", ""))
    above = F.lower(F.array_join(F.array_compact(F.array(*[F.col(f"up_{k}") for k in range(1, 5)])), " | "))
    scored = segs.withColumns({"_v": value, "_p": above}).select(
        *keep, "seg_no", "heading", "level", "last_seg",
        F.explode(F.array(*[F.struct(F.lit(f).alias("field"), heading_score(f, F.col("_v"), F.col("_p")).alias("score")) for f in SYLLABUS_FIELDS])).alias("s"),
    ).select(*keep, "seg_no", "heading", "level", "last_seg", "s.field", "s.score").filter("score >= 0")
    # a section spans seg_no..last_seg of one document; unroll it and pick texts up by equality
    spans = scored.withColumn("part", F.explode(F.sequence("seg_no", "last_seg")))
    body = texts.select(*keep, F.col("seg_no").alias("part"), F.col("heading").alias("part_heading"), "text").filter("text <> ''")
    joined = spans.join(body, [*keep, "part"])
    piece = F.when((F.col("part") > F.col("seg_no")) & (F.col("part_heading") != ""), F.concat("part_heading", F.lit(": "), "text")).otherwise(F.col("text"))
    full = joined.groupBy(*keep, "field", "seg_no", "heading", "level", "score").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", piece.alias("t")))), lambda s: s["t"]), " ").alias("text")
    )
    return first_per(full, [*keep, "field"], [F.col("score").desc(), "seg_no"])
