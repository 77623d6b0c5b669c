"""Practice cards: frame tags joined to their JSON files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import paths
from ..functions.numbers import format_points
from ..functions.text import html_to_text, unescape


def resolve_files(frames: DataFrame, files: DataFrame) -> DataFrame:
    """File of each frame's data-file: looked up beside the page first, then from the package root."""
    ref = F.regexp_replace(paths.cut_query(F.replace(unescape(paths.unquote(F.col("data_file"))), F.lit("\\"), F.lit("/"))), "^/+", "")
    staged = frames.withColumns({"_near": paths.resolve(paths.parent_dir(F.col("rel_path")), ref), "_root": paths.resolve(F.lit(""), ref)})
    have = files.select("export_id", F.col("rel_path").alias("_p"))
    near = have.select("export_id", F.col("_p").alias("_near"), F.lit(1).alias("_is_near"))
    root = have.select("export_id", F.col("_p").alias("_root"), F.lit(1).alias("_is_root"))
    joined = staged.join(near, ["export_id", "_near"], "left").join(root, ["export_id", "_root"], "left")
    found = F.when(F.col("_is_near") == 1, F.col("_near")).when(F.col("_is_root") == 1, F.col("_root"))
    return joined.withColumn("practice_path", found).drop("_near", "_root", "_is_near", "_is_root")


def cards(docs: DataFrame, keep: list[str], raw: str = "doc") -> DataFrame:
    """Title, type, counts, scoring and prompts of practice JSON documents; unreadable ones keep a row."""
    get = lambda path, kind="string": F.try_variant_get("_v", f"$.{path}", kind)
    size = lambda path: F.coalesce(F.size(get(path, "array<variant>")), F.lit(0))
    text = lambda path: html_to_text(F.coalesce(get(path), F.lit("")))
    parsed = docs.withColumn("_v", F.try_parse_json(raw))
    kind_no = get("type", "int")
    kind = F.when(get("type").isNull(), F.when(get("questions", "array<variant>").isNotNull(), "Quick quiz - legacy").otherwise("Creator+ practice"))
    for number, label in K.PRACTICE_TYPES.items():
        kind = kind.when(kind_no == number, label)
    kind = kind.otherwise(F.concat(F.lit("Creator+ type "), get("type")))
    read = parsed.select(
        *keep, F.col("_v").isNull().alias("unreadable"), F.coalesce(F.nullif(text("title"), F.lit("")), F.lit("Untitled Creator+ practice")).alias("title"),
        kind.alias("practice_type"), get("id").alias("practice_id"), size("questions").alias("questions"), size("sortableItems").alias("items"),
        size("categories").alias("categories"), get("hasScoring", "boolean").alias("_scored"), format_points(get("scorePoints")).alias("_points"),
        text("description").alias("description"), text("customInstructions").alias("instructions"), text("questionText").alias("_prompt"),
        html_to_text(F.coalesce(get("questions[0].text"), get("questions[0].questionText"), F.lit(""))).alias("first_prompt"),
    )
    scoring = F.when(F.col("_scored"), F.when(F.coalesce("_points", F.lit("")) != "", F.concat("_points", F.lit(" pts"))).otherwise("Enabled")).when(~F.col("_scored"), "Not scored")
    labelled = F.array(*[
        F.struct(F.lit(label).alias("label"), F.col(c).alias("text"))
        for label, c in (("Description", "description"), ("Instructions", "instructions"), ("Prompt", "_prompt"), ("First prompt", "first_prompt"))
    ])
    return (
        read.withColumn("scoring", scoring)
        .withColumn("prompts", distinct_prompts(labelled))
        .withColumn("summary", _summary())
        .drop("_scored", "_points", "_prompt")
    )


def distinct_prompts(labelled: Column) -> Column:
    """Non-empty prompts, a text repeated under a later label left out (case-insensitive)."""
    def fresh(entry: Column, i: Column) -> Column:
        earlier = F.slice(labelled, F.lit(1), i)
        return (entry["text"] != "") & ~F.exists(earlier, lambda e: F.lower(e["text"]) == F.lower(entry["text"]))

    return F.filter(labelled, fresh)


def _summary() -> Column:
    entry = lambda label, value: F.when(value.isNotNull(), F.concat(F.lit(f"{label}: "), value))
    many = lambda c: F.when(F.col(c) > 0, F.col(c).cast("string"))
    return F.concat_ws(
        "; ", entry("Practice type", F.col("practice_type")), entry("Practice id", F.nullif(F.coalesce("practice_id", F.lit("")), F.lit(""))),
        entry("Questions", many("questions")), entry("Items", many("items")), entry("Categories/slots", many("categories")), entry("Scoring", F.col("scoring")),
    )


def meta_key(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), "^_+|_+$", "")
