"""XML payloads of flat tool files.

Tool files are read as whole elements wherever they sit (any depth, any
namespace prefix) and decoded by Spark's ``from_xml``.  The manifest's items and quiz
files nest the same element in itself; they are read from ``xml_index`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import clean, unescape

OPTIONS = {
    "mode": "PERMISSIVE",
    "ignoreNamespace": "true",
    "attributePrefix": "_",
    "valueTag": "_VALUE",
    "columnNameOfCorruptRecord": "_corrupt_record",
    "ignoreSurroundingSpaces": "true",
}
COMMENT = r"(?s)<!--.*?-->"
_ATTRIBUTES = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"
_PIECES = r"(?s)<!\[CDATA\[.*?\]\]>|<!--.*?-->|<|[^<]++"


def plain(xml: Column) -> Column:
    """The same XML without comments, CDATA written as escaped text, so that only markup looks like markup."""

    def piece(p: Column) -> Column:
        inner = F.regexp_replace(p, r"(?s)^<!\[CDATA\[|\]\]>$", "")
        safe = F.replace(F.replace(F.replace(inner, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
        return F.when(p.startswith("<![CDATA["), safe).when(p.startswith("<!--"), F.lit("")).otherwise(p)

    cut = F.array_join(F.transform(F.regexp_extract_all(xml, F.lit(_PIECES), F.lit(0)), piece), "")
    return F.when(F.contains(xml, F.lit("<![CDATA[")), cut).when(F.contains(xml, F.lit("<!--")), F.regexp_replace(xml, COMMENT, "")).otherwise(xml)


def element_strings(xml: Column, name: str) -> Column:
    """Array of the outer XML of every element with this local name (not nested in itself)."""
    close = rf"/(?:\w++:)?{name}\s*+>"
    pattern = rf"<(?:\w++:)?{name}(?=[\s/>]){_ATTRIBUTES}(?:(?<=/)>|(?<!/)>[^<]*+(?:<(?!{close})[^<]*+)*+<{close})"
    return F.regexp_extract_all(plain(xml), F.lit(pattern), F.lit(0))


def elements(files: DataFrame, name: str, schema: str, keep: list[str], xml: str = "xml") -> DataFrame:
    """One row per element: kept columns, position in the file and the decoded struct ``e``."""
    rows = files.select(*keep, F.posexplode(element_strings(F.col(xml), name)).alias("pos", "_raw"))
    return rows.select(*keep, "pos", F.from_xml("_raw", schema, OPTIONS).alias("e"), F.col("_raw").alias("raw"))


def field(path: str) -> Column:
    """Text of a decoded field; an absent one is the empty string."""
    return clean(F.col(path))


def well_formed(files: DataFrame, xml: str = "xml") -> DataFrame:
    """Only the files whose XML can be read whole; a broken one contributes no rows."""
    e = F.from_xml(xml, "_probe string, _corrupt_record string", OPTIONS)
    return files.withColumn("_x", e).filter("_x is not null and _x._corrupt_record is null").drop("_x")


def malformed(files: DataFrame, keep: list[str], xml: str = "xml") -> DataFrame:
    """Files whose XML is not well-formed."""
    schema = "_probe string, _corrupt_record string"
    checked = files.select(*keep, F.from_xml(xml, schema, OPTIONS).alias("_x"), F.col(xml).alias("_raw"))
    return checked.filter(F.col("_x._corrupt_record").isNotNull() | F.col("_x").isNull()).select(*keep)


TOKEN = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<[?!][^>]*>|</?[\w:.-]+(?:\s++[\w:.-]++\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'))*+\s*+/?>|[^<]++"


def tokens(files: DataFrame, keep: list[str], xml: str = "xml") -> DataFrame:
    """Tags and text of each file in document order with element depth, of files that needn't be well-formed."""
    raw = files.select(*keep, F.posexplode(F.regexp_extract_all(xml, F.lit(TOKEN), F.lit(0))).alias("pos", "raw"))
    is_tag = F.col("raw").rlike(r"^</?[\w]")
    close = F.col("raw").startswith("</")
    empty = F.col("raw").rlike(r"(?s)/>$")
    named = raw.select(
        *keep, F.col("pos").cast("bigint").alias("pos"), "raw",
        F.when(is_tag, F.regexp_extract("raw", r"^</?(?:[\w.-]+:)?([\w.-]+)", 1)).alias("tag"),
        F.when(is_tag & ~close, 1).otherwise(0).alias("opens"),
        F.when(is_tag & (close | empty), 1).otherwise(0).alias("closes"),
    )
    seen = W.partitionBy(*keep).orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    return named.withColumn(
        "depth", F.sum(F.col("opens") - F.col("closes")).over(seen) + F.when((F.col("opens") == 1) & (F.col("closes") == 1), 1).otherwise(0)
        + F.when((F.col("opens") == 0) & (F.col("closes") == 1), 1).otherwise(0)
    )


def attribute(raw: Column, name: str) -> Column:
    """Attribute of an opening tag, namespace prefix ignored; absent is the empty string."""
    pattern = rf"(?s)\s(?:[\w.-]+:)?{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)')"
    return unescape(F.concat(F.regexp_extract(raw, pattern, 1), F.regexp_extract(raw, pattern, 2)))


def manifest_resources(files: DataFrame, keep: list[str]) -> DataFrame:
    """Resources of each manifest in document order; duplicates are kept."""
    schema = "_identifier string, _type string, _material_type string, _href string, _link_target string, _title string, _corrupt_record string"
    opening = rf"(?s)<(?:\w+:)?resource(?=[\s/>]){_ATTRIBUTES}>"
    tags = F.regexp_extract_all(plain(F.col("xml")), F.lit(opening), F.lit(0))
    rows = files.select(*keep, F.posexplode(tags).alias("pos", "_raw"))
    closed = F.regexp_replace("_raw", r"(?s)/?>$", "/>")
    e = F.from_xml(closed, schema, OPTIONS)
    return rows.select(*keep, "pos", e.alias("e"), (~F.col("_raw").rlike(r"\shref\s*=")).alias("missing_href")).select(
        *keep, "pos", field("e._identifier").alias("identifier"), field("e._type").alias("type"),
        field("e._material_type").alias("material_type"), field("e._href").alias("href"),
        field("e._link_target").alias("link_target"), field("e._title").alias("title"), "missing_href",
    )
