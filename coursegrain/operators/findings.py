"""Data-quality rules.  Each rule is one DataFrame with the columns of FINDING."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.classify import is_weekish
from ..functions.numbers import format_points, general_format, to_number
from ..functions.text import clean, is_true, quoted, try_date
from .scan import first_per, top_per

FINDING = ["export_id", "rule_id", "severity", "subject_kind", "subject", "message"]


def finding(df: DataFrame, rule: str, severity: str | Column, subject_kind: str | Column, subject: Column, message: Column) -> DataFrame:
    as_col = lambda v: F.lit(v) if isinstance(v, str) else v
    return df.select(
        "export_id", F.lit(rule).alias("rule_id"), as_col(severity).alias("severity"), as_col(subject_kind).alias("subject_kind"),
        subject.alias("subject"), message.alias("message"),
    )


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def quiz_grade_breaks(quizzes: DataFrame, grade_items: DataFrame) -> DataFrame:
    codes = grade_items.select("export_id", F.col("resource_code").alias("grade_item_code"))
    lost = quizzes.filter("grade_item_code <> ''").join(codes, ["export_id", "grade_item_code"], "left_anti")
    return finding(lost, "R02", "breaks", "quiz", F.col("name"), F.concat(F.lit("quiz "), quoted(F.col("name")), F.lit(": grade_item "), F.col("grade_item_code"), F.lit(" not found in grades_d2l.xml")))


def quiz_draws(sections: DataFrame) -> DataFrame:
    """Draw counts that are no number, or exceed the candidates.  Needs quiz title, section title, draw_count, candidate_count."""
    drawn = to_number(F.col("draw_count")).cast("bigint")
    head = F.concat(F.lit("quiz "), quoted(F.col("quiz")), F.lit(" section "), quoted(F.col("title")), F.lit(": "))
    bad = F.when(drawn.isNull(), F.concat(head, F.lit("invalid draw count "), quoted(F.col("draw_count")))).when(
        drawn > F.col("candidate_count"), F.concat(head, F.lit("draws "), drawn.cast("string"), F.lit(" from "), F.col("candidate_count").cast("string"), F.lit(" candidates"))
    )
    rows = sections.filter("draw_count <> ''").withColumn("_m", bad).filter("_m is not null")
    return finding(rows, "R03", "breaks", "quiz_section", F.col("title"), F.col("_m"))


def orphans(rows: DataFrame) -> DataFrame:
    return finding(rows, "R04", "warnings", "grade_item", F.col("name"), F.concat(F.lit("grade item with no linked activity: "), quoted(F.col("name"))))


def dates(dated: DataFrame, config: DataFrame) -> DataFrame:
    """Term window and stale-year rules.  ``dated``: export_id, label, raw_date; ``config``: term_start, term_end."""
    parsed = dated.withColumn("day", try_date(F.col("raw_date"))).filter("day is not null")
    latest = parsed.groupBy("export_id").agg(F.max(F.year("day")).alias("latest_year"))
    joined = parsed.join(config.select("export_id", "term_start", "term_end"), "export_id", "left").join(latest, "export_id")
    early = F.col("term_start").isNotNull() & (F.col("day") < F.col("term_start"))
    late = F.col("term_end").isNotNull() & (F.col("day") > F.col("term_end"))
    stale = F.year("day") < F.col("latest_year") - 1
    shown = F.concat(F.col("label"), F.lit(" = "), F.col("day").cast("string"))
    rule = F.when(early | late, "R05").when(stale, "R06")
    message = (
        F.when(early, F.concat(F.lit("date before term start ("), F.col("term_start").cast("string"), F.lit("): "), shown))
        .when(late, F.concat(F.lit("date after term end ("), F.col("term_end").cast("string"), F.lit("): "), shown))
        .otherwise(F.concat(F.lit("possible stale date (course's latest year is "), F.col("latest_year").cast("string"), F.lit("): "), shown))
    )
    return joined.filter(rule.isNotNull()).select(
        "export_id", rule.alias("rule_id"), F.when(early | late, "breaks").otherwise("warnings").alias("severity"), F.lit("date").alias("subject_kind"),
        F.col("label").alias("subject"), message.alias("message"),
    )


def no_dates(packages: DataFrame, dated: DataFrame) -> DataFrame:
    some = dated.filter(try_date(F.col("raw_date")).isNotNull()).select("export_id")
    return finding(packages.join(some, "export_id", "left_anti"), "R07", "notes", "package", F.col("export_id"), F.lit("no dated objects found to check"))


def countable(grade_items: DataFrame) -> DataFrame:
    flag = lambda c: F.lower(F.coalesce(F.col(c), F.lit(""))) == "true"
    return grade_items.filter((F.col("type_id") == "1") & ~flag("is_bonus") & ~flag("exclude_from_final_grade_calc"))


def gradebook_totals(grade_items: DataFrame) -> DataFrame:
    """Countable items and their exact decimal total; blank points are 0, text that is no number is skipped."""
    value = F.coalesce(to_number(F.col("out_of")).cast("decimal(28,9)"), F.lit(0).cast("decimal(28,9)"))
    return countable(grade_items).groupBy("export_id").agg(F.count("*").alias("n_countable"), F.sum(value).cast("decimal(38,9)").alias("total"))


def gradebook_total(packages: DataFrame, grade_items: DataFrame, config: DataFrame) -> DataFrame:
    totals = gradebook_totals(grade_items)
    joined = packages.join(totals, "export_id", "left").join(config.select("export_id", "expected_total"), "export_id", "left")
    total = F.coalesce(F.col("total").cast("double"), F.lit(0.0))
    count = F.coalesce("n_countable", F.lit(0))
    expected = F.col("expected_total")
    g = format_points
    off = F.abs(total - expected) > 0.001
    message = (
        F.when(expected.isNull(), F.concat(F.lit("gradebook countable total: "), g(total), F.lit(" (set expected_total in --config to enforce)")))
        .when(off, F.concat(F.lit("gradebook total "), g(total), F.lit(" != expected_total "), g(expected), F.lit(" ("), count.cast("string"), F.lit(" countable items)")))
        .otherwise(F.concat(F.lit("gradebook total matches expected_total "), g(expected)))
    )
    return finding(joined, "R08", F.when(off, "breaks").otherwise("notes"), "gradebook", F.lit("total"), message)


def gradebook_items(grade_items: DataFrame) -> DataFrame:
    """Zero-point items and points that are no number."""
    value = to_number(F.col("out_of"))
    blank = clean(F.col("out_of")) == ""
    zero = (F.col("type_id") == "1") & (blank | (value == 0))
    words = ~blank & value.isNull()
    non_numeric = finding(countable(grade_items).filter(words), "R09", "warnings", "grade_item", F.col("name"), F.concat(F.lit("grade item "), quoted(F.col("name")), F.lit(": non-numeric out_of "), quoted(F.col("out_of"))))
    worthless = finding(grade_items.filter(zero), "R09", "warnings", "grade_item", F.col("name"), F.concat(F.lit("grade item "), quoted(F.col("name")), F.lit(" is worth 0 points")))
    return worthless.unionByName(non_numeric)


def duplicate_names(grade_items: DataFrame) -> DataFrame:
    counted = grade_items.groupBy("export_id", "name").agg(F.count("*").alias("n")).filter("n > 1")
    return finding(counted, "R10", "warnings", "grade_item", F.col("name"), F.concat(F.lit("duplicate grade item name x"), F.col("n").cast("string"), F.lit(": "), quoted(F.col("name"))))


def placeholders(texts: DataFrame, patterns: list[str] | None = None, extra: DataFrame | None = None) -> DataFrame:
    """First placeholder pattern that occurs in each text source.

    The fixed patterns are tested in order inside the row; ``extra`` holds the
    package's own patterns (export_id, pattern_no, pattern) and is only joined
    to sources no fixed pattern hit.
    """
    found = F.coalesce(*[F.nullif(F.regexp_extract("text", f"(?i)({p})", 1), F.lit("")) for p in (patterns or K.PLACEHOLDER_PATTERNS)])
    marked = texts.select("export_id", "label", "text", found.alias("hit"))
    if extra is not None:
        own = marked.filter("hit is null").join(extra, "export_id").withColumn("hit", F.nullif(F.call_function("regexp_extract", F.col("text"), F.concat(F.lit("(?i)("), F.col("pattern"), F.lit(")")), F.lit(1)), F.lit("")))
        own = own.filter("hit is not null").groupBy("export_id", "label").agg(F.min_by("hit", "pattern_no").alias("hit"))
        marked = marked.filter("hit is not null").select("export_id", "label", "hit").unionByName(own.select("export_id", "label", "hit"))
    return finding(marked.filter("hit is not null"), "R11", "breaks", "text", F.col("label"), F.concat(F.lit("placeholder leakage in "), F.col("label"), F.lit(": "), quoted(F.col("hit"))))


def alt_locations(images: DataFrame, shown: int = 3) -> DataFrame:
    """Missing-alt images per location: count, and the first few references in document order."""
    totals = images.groupBy("export_id", "location").agg(F.count("*").alias("n"))
    first = top_per(images, ["export_id", "location"], ["image_no", "image_ref"], shown)
    listed = first.groupBy("export_id", "location").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank_no", "image_ref"))), lambda s: s["image_ref"]), ", ").alias("refs"))
    more = F.when(F.col("n") > shown, F.concat(F.lit("; +"), (F.col("n") - shown).cast("string"), F.lit(" more"))).otherwise("")
    return totals.join(listed, ["export_id", "location"]).withColumn("detail", F.concat("location", F.lit(" -> "), "refs", more)).drop("refs")


def missing_alt(images: DataFrame, order: DataFrame | None = None, shown: int = 10) -> DataFrame:
    """Report line per package: total and the first locations.  ``alt_findings`` has every location."""
    places = alt_locations(images)
    totals = places.groupBy("export_id").agg(F.sum("n").alias("total"), F.count("*").alias("places"))
    top = top_per(places, ["export_id"], ["location"], shown)
    detail = top.groupBy("export_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank_no", "detail"))), lambda s: s["detail"]), "; ").alias("d"))
    more = F.when(F.col("places") > shown, F.concat(F.lit("; +"), (F.col("places") - shown).cast("string"), F.lit(" more locations"))).otherwise("")
    message = F.concat(F.lit("images missing alt text across activities and pages: "), F.col("total").cast("string"), F.lit(" ("), F.col("d"), more, F.lit(")"))
    return finding(totals.join(detail, "export_id"), "R12", "warnings", "package", F.col("export_id"), message)


def alt_findings(images: DataFrame) -> DataFrame:
    """One warning per location with images that have no alternative text."""
    counted = images.groupBy("export_id", "location").agg(F.count("*").alias("n"))
    return finding(counted, "R12", "warnings", "location", F.col("location"), F.concat(F.lit("images missing alt text: "), F.col("n").cast("string")))


#: Gaps up to this many numbers are listed one by one, longer ones as a range.
GAP_LISTED = 1000


def week_gaps(modules: DataFrame) -> DataFrame:
    """Missing numbers between the first and last numbered week of each package.

    Each gap lies between two neighbouring numbers, so the text grows with the
    weeks of a package and not with the numbers they bear.
    """
    number = F.regexp_extract("title", r"(?i)\bweek\s+(\d+)", 1).try_cast("int")
    weeks = modules.filter("kind = 'module'").select("export_id", number.alias("w")).filter("w is not null").distinct()
    following = weeks.withColumn("next", F.lead("w").over(W.partitionBy("export_id").orderBy("w")))
    first, last = F.col("w").cast("bigint") + 1, F.col("next").cast("bigint") - 1
    listed = F.array_join(F.sequence(first, F.least(last, first + GAP_LISTED)).cast("array<string>"), ", ")
    gap = F.when(last - first < GAP_LISTED, listed).otherwise(F.concat(first.cast("string"), F.lit("-"), last.cast("string")))
    gaps = following.groupBy("export_id").agg(
        F.min("w").alias("lo"), F.max("w").alias("hi"), F.array_sort(F.collect_list(F.when(last >= first, F.struct("w", gap.alias("t"))))).alias("missing"),
    ).filter(F.size("missing") > 0)
    text = F.concat(F.lit("["), F.array_join(F.transform("missing", lambda m: m["t"]), ", "), F.lit("]"))
    return finding(gaps, "R13", "notes", "package", F.col("export_id"), F.concat(F.lit("week-module numbering gap (inference): weeks "), text, F.lit(" absent between "), F.col("lo").cast("string"), F.lit(" and "), F.col("hi").cast("string")))


def broken_hrefs(nodes: DataFrame, files: DataFrame) -> DataFrame:
    """Page and file items whose href is not in the package (query cut, not percent-decoded)."""
    wanted = nodes.filter(F.col("kind").isin("html_topic", "content_file") & (F.col("href") != ""))
    target = F.split_part(F.replace(F.col("href"), F.lit("\\"), F.lit("/")), F.lit("?"), F.lit(1))
    lost = wanted.withColumn("rel_path", target).join(files.select("export_id", "rel_path"), ["export_id", "rel_path"], "left_anti")
    what = F.when(F.col("kind") == "content_file", "content file ").otherwise("html topic ")
    return finding(lost, "R14", "breaks", F.col("kind"), F.col("title"), F.concat(what, quoted(F.col("title")), F.lit(": href missing from package: "), F.col("href")))


def unresolved_refs(nodes: DataFrame) -> DataFrame:
    lost = nodes.filter("identifierref <> '' and not resource_found")
    return finding(lost, "R14", "breaks", "item", F.col("title"), F.concat(F.lit("item "), quoted(F.col("title")), F.lit(": identifierref "), F.col("identifierref"), F.lit(" unresolved")))


def broken_references(missing: DataFrame) -> DataFrame:
    """``missing`` carries title and ref of relative references without a file."""
    return finding(missing, "R14", "breaks", "page", F.col("title"), F.concat(F.lit("html topic "), quoted(F.col("title")), F.lit(": broken relative reference: "), F.col("ref")))


def empty_pages(pages: DataFrame) -> DataFrame:
    return finding(pages.filter("body_text = ''"), "R15", "warnings", "page", F.col("title"), F.concat(F.lit("html topic "), quoted(F.col("title")), F.lit(": page body is empty")))


def malformed_xml(files: DataFrame) -> DataFrame:
    return finding(files, "R17", "breaks", "file", F.col("rel_path"), F.concat(F.col("rel_path"), F.lit(" is not well-formed XML")))


def missing_components(packages: DataFrame, files: DataFrame) -> DataFrame:
    """Expected tool files a package does not hold; a missing manifest is a break as well."""
    component = F.when(F.col("rel_path").startswith("discussion_d2l_") & F.col("rel_path").endswith(".xml"), K.EXPECTED_COMPONENTS[3]).when(
        F.col("rel_path").isin(*K.EXPECTED_COMPONENTS[:3]), F.col("rel_path")
    )
    have = files.select("export_id", component.alias("component")).filter("component is not null").distinct()
    wanted = packages.select("export_id", F.explode(F.array(*[F.lit(c) for c in K.EXPECTED_COMPONENTS])).alias("component"))
    lost = wanted.join(have, ["export_id", "component"], "left_anti")
    message = F.when(F.col("component") == K.EXPECTED_COMPONENTS[3], F.concat(F.lit("no "), F.col("component"), F.lit(" present in export"))).otherwise(F.concat(F.col("component"), F.lit(" not present in export")))
    soft = finding(lost, "R18", "warnings", "component", F.col("component"), message)
    hard = finding(lost.filter(F.col("component") == K.MANIFEST_NAME), "R17", "breaks", "component", F.col("component"), F.lit("imsmanifest.xml missing from export"))
    return soft.unionByName(hard)


def points_mismatches(rows: DataFrame) -> DataFrame:
    message = F.concat(F.col("kind"), F.lit(" "), quoted(F.col("name")), F.lit(": folder out_of "), F.col("out_of"), F.lit(" != grade item out_of "), F.col("grade_item_out_of"))
    return finding(rows, "R19", "breaks", F.col("kind"), F.col("name"), message)


def url_status(urls: DataFrame, crawl: DataFrame) -> DataFrame:
    """Join the URL inventory with a crawl result table (url, status, final_url, error)."""
    templated = F.col("url").rlike(r"[{}]")
    joined = urls.join(crawl, "url", "left")
    ok = F.col("status").between(200, 399)
    moved = F.when(F.col("final_url") != F.col("url"), F.concat(F.lit(" -> "), F.col("final_url"))).otherwise("")
    message = (
        F.when(templated, F.concat(F.lit("external URL check skipped for templated URL: "), F.col("url")))
        .when(ok, F.concat(F.lit("external URL ok ("), F.col("status").cast("string"), F.lit("): "), F.col("url"), moved))
        .when(F.col("status").isNotNull(), F.concat(F.lit("external URL returned HTTP "), F.col("status").cast("string"), F.lit(": "), F.col("url")))
        .when(F.col("error").isNotNull(), F.concat(F.lit("external URL check failed: "), F.col("url"), F.lit(" ("), F.col("error"), F.lit(")")))
    )
    return finding(joined.withColumn("_m", message).filter("_m is not null"), "R22", F.when(templated | ok, "notes").otherwise("warnings"), "url", F.col("url"), F.col("_m"))


def severity_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("export_id").pivot("severity", ["breaks", "warnings", "notes"]).count().na.fill(0)


def gate(packages: DataFrame, rows: DataFrame) -> DataFrame:
    """Pass or fail per package: any break fails it."""
    breaks = rows.filter("severity = 'breaks'").groupBy("export_id").agg(F.count("*").alias("breaks"))
    return packages.select("export_id").join(breaks, "export_id", "left").select(
        "export_id", F.coalesce("breaks", F.lit(0)).alias("breaks"), F.when(F.coalesce("breaks", F.lit(0)) > 0, "fail").otherwise("pass").alias("outcome")
    )


def unreadable_members(members: DataFrame) -> DataFrame:
    """Members of an archive that could not be read, while the rest was."""
    message = F.concat(F.lit("package file could not be read: "), F.col("rel_path"), F.lit(" ("), F.col("open_error"), F.lit(")"))
    return finding(members, "B12", "breaks", "package_file", F.col("rel_path"), message)
