"""Activities and the references between them.

The silver tables share ``export_id``; every lookup is an equi-join on
(export_id, code) and every miss stays visible as an edge with its outcome.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.numbers import to_number
from ..functions.text import clean, quoted
from .scan import first_per, prefix_scan


def last_by_code(df: DataFrame, code: str, order: list[str]) -> DataFrame:
    """Lookup table of non-empty codes; the last duplicate in document order wins."""
    return first_per(df.filter(F.col(code) != ""), ["export_id", code], [F.col(c).desc() for c in order])


def with_grade_items(activities: DataFrame, grade_items: DataFrame, order: list[str]) -> DataFrame:
    """Name and points of the grade item an activity points at."""
    lookup = last_by_code(grade_items, "resource_code", order).select(
        "export_id", F.col("resource_code").alias("grade_item_code"), F.col("name").alias("_name"), F.col("out_of").alias("_out_of"), F.lit(True).alias("_hit"),
    )
    has_code = F.col("grade_item_code") != ""
    joined = activities.join(lookup, ["export_id", "grade_item_code"], "left")
    return joined.withColumns(
        {
            "grade_item_name": F.when(~has_code, "").when(F.col("_hit"), F.col("_name")).otherwise("(unresolved)"),
            "grade_item_out_of": F.when(has_code & F.coalesce("_hit", F.lit(False)), F.col("_out_of")).otherwise(""),
            "grade_resolved": F.when(has_code, F.when(F.col("_hit"), "yes").otherwise("NO")),
        }
    ).drop("_name", "_out_of", "_hit")


def rubric_links(activities: DataFrame, rubrics: DataFrame, keep: list[str]) -> DataFrame:
    """One row per (activity, rubric id) with the rubric's name when it exists."""
    names = rubrics.select("export_id", "rubric_id", F.col("rubric_name"))
    links = activities.select(*keep, F.posexplode("rubric_ids").alias("rubric_no", "rubric_id"))
    return links.join(names, ["export_id", "rubric_id"], "left").withColumn(
        "resolved", F.when(F.col("rubric_name").isNotNull(), "yes").otherwise("NO")
    )


def rubric_summary(links: DataFrame, keep: list[str]) -> DataFrame:
    """``id: name; …`` per activity, as long as the activity's own id list."""
    label = F.concat(F.col("rubric_id"), F.lit(": "), F.coalesce("rubric_name", F.lit("(unresolved)")))
    return links.groupBy(*keep).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rubric_no", label.alias("l")))), lambda s: s["l"]), "; ").alias("rubrics_resolved")
    )


def with_conditions(activities: DataFrame, condition_codes: DataFrame) -> DataFrame:
    """Tri-state outcome of the release condition: yes, NO, or n/a when the package has none at all."""
    codes = condition_codes.select("export_id", F.col("code").alias("condition_set"), F.lit(True).alias("_hit")).distinct()
    packages = condition_codes.select("export_id", F.lit(True).alias("_any")).distinct()
    outcome = F.when(
        F.col("condition_set") != "",
        F.when(F.col("_hit"), "yes").when(F.col("_any"), "NO").otherwise("n/a"),
    )
    return (
        activities.join(codes, ["export_id", "condition_set"], "left").join(packages, "export_id", "left")
        .withColumn("condition_resolved", outcome).drop("_hit", "_any")
    )


def quicklink_counts(resources: DataFrame) -> DataFrame:
    """Number of manifest links per activity code."""
    codes = resources.select("export_id", F.explode(F.regexp_extract_all("href", F.lit(K.ACTIVITY_CODE), F.lit(1))).alias("resource_code"))
    return codes.groupBy("export_id", "resource_code").agg(F.count("*").alias("links"))


def with_quicklinks(activities: DataFrame, counts: DataFrame) -> DataFrame:
    return activities.join(counts, ["export_id", "resource_code"], "left").withColumn("links", F.coalesce("links", F.lit(0)))


def keep_linked(activities: DataFrame, counts: DataFrame, only_if_any_match: bool) -> DataFrame:
    """Drop activities no quicklink points at.

    Checklists are filtered when the package has any quicklink; quizzes only when
    at least one quiz of the package matches (``only_if_any_match``).  The switch
    is one boolean per package, aggregated before it is joined back.
    """
    linked = with_quicklinks(activities, counts).withColumn("_linked", F.col("links") > 0)
    if only_if_any_match:
        switch = linked.groupBy("export_id").agg(F.bool_or("_linked").alias("_filter"))
    else:
        switch = counts.select("export_id", F.lit(True).alias("_filter")).distinct()
    joined = linked.join(switch, "export_id", "left")
    return joined.filter(F.col("_linked") | ~F.coalesce("_filter", F.lit(False))).drop("_linked", "_filter")


def orphan_grade_items(grade_items: DataFrame, activities: DataFrame, extra_codes: DataFrame | None = None) -> DataFrame:
    """Countable grade items no activity points at (type 9 is a text item)."""
    used = activities.filter("grade_item_code <> ''").select("export_id", F.col("grade_item_code").alias("resource_code"))
    if extra_codes is not None:
        used = used.unionByName(extra_codes.select("export_id", "resource_code"))
    return grade_items.filter("type_id <> '9'").join(used.distinct(), ["export_id", "resource_code"], "left_anti")


def points_mismatch(activities: DataFrame) -> DataFrame:
    """Activities whose own points differ from their grade item's; text that is no number is ignored."""
    own, other = to_number(F.col("out_of")), to_number(F.col("grade_item_out_of"))
    return activities.filter((own != other) & (F.col("grade_item_out_of") != ""))


def relationships(activities: DataFrame, links: DataFrame, orphans: DataFrame) -> DataFrame:
    """Edge list: grade item, rubric, condition and quicklink edges of every activity, then orphan grade items.

    ``activities`` carry the outcome columns of the ``with_*`` operators.
    """
    base = ["export_id", F.col("kind").alias("source_kind"), F.col("name").alias("source_name"), F.col("resource_code").alias("source_code"), F.col("pos").cast("bigint").alias("pos")]
    # checklists only carry their manifest quicklink
    edges = F.array(
        F.when(F.col("grade_resolved").isNotNull(), F.struct(F.lit(1).alias("sub"), F.lit("grade_item").alias("join_type"), F.col("grade_item_code").alias("target"), F.col("grade_resolved").alias("resolved"))),
        F.when(F.col("condition_resolved").isNotNull(), F.struct(F.lit(3).alias("sub"), F.lit("condition_set").alias("join_type"), F.col("condition_set").alias("target"), F.col("condition_resolved").alias("resolved"))),
        F.when(F.col("resource_code") != "", F.struct(F.lit(4).alias("sub"), F.lit("manifest_quicklink").alias("join_type"), F.concat(F.col("links").cast("string"), F.lit(" link(s)")).alias("target"), F.when(F.col("links") > 0, "yes").otherwise("none").alias("resolved"))),
    )
    direct = activities.select(*base, F.explode(F.array_compact(edges)).alias("e")).select(
        "export_id", "source_kind", "source_name", "source_code", "pos", "e.sub", F.lit(0).alias("item"), "e.join_type", "e.target", "e.resolved",
    )
    rubric = links.select(*base, F.lit(2).alias("sub"), F.col("rubric_no").alias("item"), F.lit("rubric").alias("join_type"), F.col("rubric_id").alias("target"), "resolved")
    lonely = orphans.select(
        "export_id", F.lit("grade_item").alias("source_kind"), F.col("name").alias("source_name"), F.col("resource_code").alias("source_code"),
        F.col("pos").cast("bigint").alias("pos"), F.lit(5).alias("sub"), F.lit(0).alias("item"), F.lit("linked_activity").alias("join_type"),
        F.lit("(none found in dropbox/discussions/quizzes)").alias("target"), F.lit("none").alias("resolved"),
    )
    return direct.unionByName(rubric).unionByName(lonely)


def duplicate_ordinals(edges: DataFrame, pos: str, chunk: Column | None = None) -> DataFrame:
    """0-based occurrence number of each edge among equal edges, in document order."""
    same = ["export_id", "source_kind", "source_code", "join_type", "target", "resolved"]
    counted = prefix_scan(edges.withColumn("_one", F.lit(1)), same, pos, {"_n": ("sum", F.col("_one"))}, chunk, in_place=True)
    return counted.withColumn("duplicate_ordinal", (F.col("_n") - 1).cast("int")).drop("_n", "_one")


def details(activities: DataFrame) -> DataFrame:
    """Detail list of an activity in report order; empty values are left out."""
    from ..functions.numbers import format_points

    kind, name = F.col("kind"), F.col("name")
    is_quiz = kind == "quiz"
    points = F.when(is_quiz, F.col("grade_item_out_of")).otherwise(F.col("out_of"))
    minutes = clean(F.col("time_limit"))
    entry = lambda label, value: F.struct(F.lit(label).alias("detail"), value.alias("value"))
    quiz_only = lambda value: F.when(is_quiz & (value != ""), value)
    rows = F.array(
        entry("Points", F.when(clean(points) != "", F.concat(format_points(points), F.lit(" pts")))),
        entry("Gradebook item", F.when((F.col("grade_item_name") != "") & (is_quiz | (F.col("grade_item_name") != name)), F.col("grade_item_name"))),
        entry("Rubric", F.nullif(F.coalesce("rubrics_resolved", F.lit("")), F.lit(""))),
        entry("Attempts allowed", quiz_only(F.col("attempts_allowed"))),
        entry("Time limit", quiz_only(F.when(minutes == "", "").when(minutes.isin("0", "0.0"), "No time limit").otherwise(F.concat(format_points(minutes), F.lit(" minutes"))))),
        entry("Time limit enforced", F.when(is_quiz & (F.col("enforce_time_limit") != "") & (F.col("enforce_time_limit") != "no"), F.col("enforce_time_limit"))),
        entry("Questions", F.when(is_quiz & (F.col("drawn") > 0), F.concat(F.col("drawn").cast("string"), F.lit(" drawn"), F.when(F.col("candidates") > 0, F.concat(F.lit(" from "), F.col("candidates").cast("string"), F.lit(" candidates"))).otherwise("")))),
        entry("Sections", F.when(is_quiz & (F.col("sections") > 0), F.col("sections").cast("string"))),
        entry("Question types", quiz_only(F.col("question_types"))),
        entry("Active", F.when(is_quiz & (F.col("is_active") != "") & (F.col("is_active") != "yes"), F.col("is_active"))),
    )
    return activities.select("export_id", "kind", "resource_code", "pos", F.posexplode(rows).alias("ord", "d")).select(
        "export_id", "kind", "resource_code", "pos", "ord", "d.detail", "d.value"
    ).filter("value is not null")


def join_findings(edges: DataFrame) -> DataFrame:
    """A break for every unresolved grade item, rubric or condition edge."""
    where = F.when(F.col("join_type") == "grade_item", "grades_d2l.xml").when(F.col("join_type") == "rubric", "rubrics_d2l.xml").otherwise("conditionalrelease_d2l.xml")
    what = F.when(F.col("join_type") == "rubric", "rubric id").otherwise(F.col("join_type"))
    return edges.filter("resolved = 'NO'").select(
        "export_id", F.lit("R01").alias("rule_id"), F.lit("breaks").alias("severity"), F.col("source_kind").alias("subject_kind"), F.col("source_name").alias("subject"),
        F.concat(F.col("source_kind"), F.lit(" "), quoted(F.col("source_name")), F.lit(": "), what, F.lit(" "), F.col("target"), F.lit(" not found in "), where).alias("message"),
    )


def week_list(kind: Column) -> Column:
    """List of a week that shows an activity of this kind."""
    return F.when(kind.isin("dropbox_folder", "quiz"), "assignments").when(kind == "discussion_topic", "discussions").when(kind == "checklist", "checklist")
