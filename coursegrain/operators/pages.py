"""Page-level evidence: titles, references, images, URLs, heading segments.

Extraction happens inside the row that holds the page, so the only shuffles are
the joins against the package's file list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .. import constants as K
from ..functions import classify, paths
from ..functions.binding import let
from ..functions.text import clean, flatten_html, html_to_text, drop_script_style, strip, unescape

REFERENCE = r"""(?i)(?:src|href)\s*=\s*["']([^"']+)["']"""
IMAGE = r"(?i)<img\b[^>]*>"
MEANINGFUL_ALT = r"""(?i)\balt\s*=\s*("[^"]*[^"\s][^"]*"|'[^']*[^'\s][^']*')"""
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
HEADING = r"(?is)<h([1-4])\b[^>]*>(.*?)</h\1>"
IFRAME = r"(?i)<iframe\b[^>]*>"


def tag_attribute(tag: Column, name: str) -> Column:
    """Attribute of a start tag in any of the three quote styles, entities decoded."""
    pattern = rf"""(?i)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
    value = F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])
    return F.when(F.contains(F.lower(tag), F.lit(name)), unescape(value)).otherwise("")


def page_title(html: Column) -> Column:
    return html_to_text(F.regexp_extract(html, TITLE, 1))


def references(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """Every quoted src/href with its class."""
    refs = pages.select(*keep, F.explode(F.regexp_extract_all(html, F.lit(REFERENCE), F.lit(1))).alias("ref"))
    return refs.withColumn("ref", strip(F.col("ref"))).withColumn(
        "ref_class", classify.reference_class(F.col("ref"))
    )


def missing_references(refs: DataFrame, files: DataFrame, page_path: str = "rel_path") -> DataFrame:
    """Distinct relative references that resolve to no file of the package."""
    target = paths.cut_query(F.replace(unescape(paths.unquote(F.col("ref"))), F.lit("\\"), F.lit("/")))
    wanted = (
        refs.filter("ref_class = 'relative'")
        .select("export_id", page_path, "ref", paths.resolve(paths.parent_dir(F.col(page_path)), target).alias("target"))
        .distinct()
    )
    present = files.select("export_id", F.col("rel_path").alias("target"))
    return wanted.join(present, ["export_id", "target"], "left_anti")


def images_missing_alt(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """One row per image without a meaningful alternative text."""
    tags = pages.select(*keep, F.posexplode(F.regexp_extract_all(html, F.lit(IMAGE), F.lit(0))).alias("image_no", "tag"))
    src = F.nullif(strip(tag_attribute(F.col("tag"), "src")), F.lit(""))
    return tags.filter(~F.col("tag").rlike(MEANINGFUL_ALT)).select(
        *keep, "image_no", F.coalesce(src, F.lit("(image src not found)")).alias("image_ref")
    )


def external_urls(texts: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Distinct web addresses per source, trailing punctuation removed."""
    found = texts.select(*keep, F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(f"({K.EXTERNAL_URL})"), F.lit(1)))).alias("_u"))
    return found.select(*keep, F.regexp_replace(unescape(F.col("_u")), r"[.,;:)\]]+$", "").alias("url")).distinct()


def embeds(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """Embedded frames with their kind; practice frames are recognised by data file or host."""
    tags = pages.select(*keep, F.posexplode(F.regexp_extract_all(html, F.lit(IFRAME), F.lit(0))).alias("embed_no", "tag"))
    read = tags.select(
        *keep, "embed_no", tag_attribute(F.col("tag"), "src").alias("src"),
        strip(tag_attribute(F.col("tag"), "data-file")).alias("data_file"),
        strip(tag_attribute(F.col("tag"), "title")).alias("_title"),
    )
    return read.filter("src <> ''").select(
        *keep, "embed_no", "src", "data_file",
        F.when(F.col("_title") == "", "Embedded media").otherwise(F.col("_title")).alias("title"),
        F.when(classify.is_practice(F.col("data_file"), F.col("src")), "practice").otherwise(classify.embed_kind(F.col("src"))).alias("embed_kind"),
    )


def binary_like(content: Column) -> Column:
    """True when the first 8 KiB look like a binary document rather than a page."""
    return let(F.substring(content, 1, K.SAMPLE_BYTES), lambda sample: _binary_like(sample, content))


def _binary_like(sample: Column, content: Column) -> Column:
    hexa = F.hex(sample)
    head = F.regexp_replace(
        F.lower(F.decode(F.substring(content, 1, K.HTML_SNIFF_BYTES), "ISO-8859-1")), r"^[ \t\n\r\x0B\f]+", ""
    )
    page = head.rlike(r"^(<!doctype|<html|<body|<h1|<h2|<p)") | F.contains(head, F.lit("<html"))
    magic = hexa.startswith("504B0304") | hexa.startswith("D0CF11E0A1B11AE1") | hexa.startswith("255044462D")
    latin = F.decode(sample, "ISO-8859-1")
    office = F.contains(latin, F.lit("[Content_Types].xml")) | F.contains(latin, F.lit("word/document.xml"))
    size = F.length(sample)
    nul = size - F.length(F.regexp_replace(latin, r"\x00", ""))
    control = size - F.length(F.regexp_replace(latin, r"[\x00-\x08\x0E-\x1F\x7F]", ""))
    return (size > 0) & ~page & (magic | office | (nul / size > 0.01) | (control / size > 0.20))


def segments(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """Split a page at its h1-h4 headings; text before the first one is segment 0."""
    raw = pages.select(*keep, drop_script_style(F.col(html)).alias("_raw"))
    cut = raw.select(
        *keep,
        F.regexp_extract_all("_raw", F.lit(HEADING), F.lit(1)).alias("_levels"),
        F.regexp_extract_all("_raw", F.lit(HEADING), F.lit(2)).alias("_heads"),
        F.split("_raw", HEADING, -1).alias("_bodies"),
    )
    heads = F.concat(F.array(F.lit("")), F.col("_heads"))
    levels = F.concat(F.array(F.lit("0")), F.col("_levels"))
    rows = cut.select(*keep, F.posexplode(F.arrays_zip(heads.alias("h"), levels.alias("l"), F.col("_bodies").alias("b"))).alias("seg_no", "s"))
    return rows.select(
        *keep, "seg_no", flatten_html(F.col("s.h")).alias("heading"), F.col("s.l").cast("int").alias("level"),
        F.col("s.b").alias("fragment"),
    )


def heading_ancestors(segs: DataFrame, keep: list[str]) -> DataFrame:
    """Enclosing heading at each level 1-4 (``up_1`` .. ``up_4``), NULL where there is none.

    A level-k heading is open for a row when it is the last heading of level <= k
    and k is below the row's own level.
    """
    before = W.partitionBy(*keep).orderBy("seg_no").rowsBetween(W.unboundedPreceding, -1)
    headed = (F.col("heading") != "") & (F.col("level") > 0)
    out = segs
    for k in range(1, 5):
        last = F.last(F.when(headed & (F.col("level") <= k), F.struct("level", "heading", "seg_no")), True).over(before)
        out = out.withColumn(f"_last_{k}", last)
    for k in range(1, 5):
        is_open = (F.col(f"_last_{k}.level") == k) & (F.col("level") > k)
        out = out.withColumn(f"up_{k}", F.when(is_open, F.col(f"_last_{k}.heading")))
    return out.drop(*[f"_last_{k}" for k in range(1, 5)])


def heading_path(segs: DataFrame) -> Column:
    """Open headings and the own heading, from level 1 down."""
    return F.array_compact(F.array(*[F.col(f"up_{k}") for k in range(1, 5)], F.when(F.col("heading") != "", F.col("heading"))))


def path_label(page: Column, path: Column) -> Column:
    """Page and headings joined with an arrow; of neighbours where one holds the other, the longer stays."""
    from ..functions.text import clean_label

    parts = F.filter(F.transform(F.concat(F.array(page), path), clean_label), lambda p: p != "")

    def step(acc: Column, part: Column) -> Column:
        last = F.element_at(acc, -1)
        overlap = F.contains(F.lower(last), F.lower(part)) | F.contains(F.lower(part), F.lower(last))
        longer = F.when(F.length(part) > F.length(last), part).otherwise(last)
        return (
            F.when(F.size(acc) == 0, F.array(part))
            .when(overlap, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(longer)))
            .otherwise(F.concat(acc, F.array(part)))
        )

    return F.array_join(F.aggregate(parts, F.expr("cast(array() as array<string>)"), step), " › ")


def section_ranges(segs: DataFrame, keep: list[str]) -> DataFrame:
    """``last_seg``: the last segment of each headed section (before the next heading of same or higher rank)."""
    after = W.partitionBy(*keep).orderBy("seg_no").rowsBetween(1, W.unboundedFollowing)
    out = segs.withColumn("_end", F.max("seg_no").over(W.partitionBy(*keep)))
    for k in range(1, 5):
        out = out.withColumn(f"_next_{k}", F.min(F.when((F.col("heading") != "") & (F.col("level") <= k), F.col("seg_no"))).over(after))
    pick = F.when(F.lit(False), F.lit(0))
    for k in range(1, 5):
        pick = pick.when(F.col("level") == k, F.col(f"_next_{k}"))
    return out.withColumn("last_seg", F.coalesce(pick - 1, F.col("_end"))).drop("_end", *[f"_next_{k}" for k in range(1, 5)])
