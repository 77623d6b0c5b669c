"""Scalar functions and classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify, numbers, paths, text
from ..operators import structure
from .registry import Tables, query

_SP = r"[\s\x0B\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_UNESCAPED = "replace(replace(replace(replace(replace(replace(%s, '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&copy;', chr(169)), '&middot;', chr(183)), '&amp;', '&')"


def sql_collapse(expr: str) -> str:
    return f"regexp_replace(regexp_replace({expr}, '{_SP}+', ' ', 'g'), '^ +| +$', '', 'g')"


def sql_html_to_text(expr: str) -> str:
    no_code = rf"regexp_replace({expr}, '(?is)<script\b.*?</script>|<style\b.*?</style>', ' ', 'g')"
    return sql_collapse(_UNESCAPED % f"regexp_replace({no_code}, '<[^>]+>', ' ', 'g')")


_CATEGORY = r"""
    CASE WHEN regexp_matches(base, '^(quiz_d2l_|discussion_d2l)') OR base IN ('imsmanifest.xml') THEN 'd2l_xml'
         WHEN low LIKE '%.xml' THEN 'xml' WHEN regexp_matches(low, '\.({html})$') THEN 'html'
         WHEN regexp_matches(low, '\.(jpg|jpeg|png|gif|svg|webp|bmp)$') THEN 'image'
         WHEN regexp_matches(low, '\.(mp4|mov|avi|m4v|webm|mp3|wav)$') THEN 'media'
         WHEN regexp_matches(low, '\.(pdf|doc|docx|ppt|pptx|xls|xlsx|csv|txt|qmd|rmd)$') THEN 'document'
         WHEN regexp_matches(low, '\.(css|js|json)$') THEN 'frontend_support' ELSE 'other' END
"""


def sql_category(html: str) -> str:
    return _CATEGORY.replace("{html}", html)


@query("file_category", f"""
    WITH f AS (SELECT export_id, rel_path, lower(rel_path) AS low, regexp_extract(lower(rel_path), '([^/]*)$', 1) AS base FROM {{v_files}})
    SELECT export_id, {sql_category('html|htm')} AS inventory_class, {sql_category('html|htm|xhtml')} AS scope_class, count(*) AS n
    FROM f GROUP BY ALL
""")
def file_category(t: Tables) -> DataFrame:
    return t.v_files.groupBy(
        "export_id", paths.file_category(F.col("rel_path")).alias("inventory_class"), paths.file_category(F.col("rel_path"), "scope").alias("scope_class")
    ).agg(F.count("*").alias("n"))


@query("href_normalize", r"""
    WITH h AS (SELECT rel_path, bytes, '\shelf%20A\' || rel_path || '?rev=' || cast(bytes AS string) || '#top' AS href FROM {v_files}
               UNION ALL SELECT cast(page_id AS string), page_id, url FROM {pages}),
         p AS (SELECT *, regexp_replace(regexp_replace(replace(replace(href, '%20', ' '), '\', '/'), '[?#].*$', ''), '^/+', '') AS path_part FROM h)
    SELECT rel_path, bytes, href, path_part, NOT regexp_matches(lower(href), '^(http://|https://|data:|mailto:|javascript:|tel:|#|//)') AS is_local,
           lower(regexp_extract(regexp_extract(path_part, '([^/]*)$', 1), '^.+(\.[^.]+)$', 1)) AS suffix,
           lower(regexp_extract(regexp_extract(path_part, '([^/]*)$', 1), '^.+(\.[^.]+)$', 1)) NOT IN ('', '.html', '.htm', '.xhtml', '.txt', '.md', '.markdown') AS is_content_file
    FROM p
""")
def href_normalize(t: Tables) -> DataFrame:
    files = t.v_files.select("rel_path", "bytes", F.concat(F.lit("\\shelf%20A\\"), "rel_path", F.lit("?rev="), F.col("bytes").cast("string"), F.lit("#top")).alias("href"))
    urls = t.pages.select(F.col("page_id").cast("string").alias("rel_path"), F.col("page_id").alias("bytes"), F.col("url").alias("href"))
    h = F.col("href")
    return files.unionByName(urls).select(
        "rel_path", "bytes", "href", paths.href_path_part(h).alias("path_part"), paths.is_local_href(h).alias("is_local"),
        paths.href_suffix(h).alias("suffix"), paths.is_content_file(h).alias("is_content_file"),
    )


def sql_has(expr: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({expr}, '{w}')" for w in words) + ")"


_OBJ = ["objective", "learning outcome", "outcomes", "goals", "students will be able", "swbat", "competenc"]
_RES = ["reading", "resource", "material", "multimedia", "media", "video", "watch", "listen", "textbook", "reference", "required", "optional", "explore"]
_OVR = ["overview", "introduction", "welcome", "start here", "intro", "orientation", "independent research"]


def sql_bucket(expr: str, page: bool) -> str:
    t = f"lower(trim({expr}))"
    tail = {"resources": sql_has(t, _RES), "lessons": sql_has(t, ["lesson", "lecture"]), "overview": sql_has(t, _OVR)}
    order = ["lessons", "overview", "resources"] if page else ["resources", "lessons", "overview"]
    return (
        f"CASE WHEN contains({t}, 'checklist') THEN 'checklist' WHEN {sql_has(t, ['practice', 'self-assessment', 'self assessment', 'self-check', 'self check'])} THEN 'practice' "
        f"WHEN {sql_has(t, _OBJ)} THEN 'objectives' WHEN {sql_has(t, ['quiz', 'midterm', 'assessment', 'cumulative'])} OR regexp_matches({t}, '\\bexam(s|ination|inations)?\\b') THEN 'assessments' "
        + " ".join(f"WHEN {tail[b]} THEN '{b}'" for b in order) + " END"
    )


@query("heading_bucket", f"""
    SELECT title_no, title, {sql_bucket('title', False)} AS heading_bucket, {sql_bucket('title', True)} AS page_bucket,
           CASE WHEN title = '' OR regexp_matches(title, '(?i)\\b(week|module|unit)\\s*0*(\\d{{1,2}})\\b') THEN 'overview' ELSE 'other' END AS default_bucket
    FROM {{v_titles}}
""")
def heading_bucket(t: Tables) -> DataFrame:
    c = F.col("title")
    return t.v_titles.select(
        "title_no", "title", classify.heading_bucket(c).alias("heading_bucket"), classify.heading_bucket(c, page_title=True).alias("page_bucket"),
        classify.page_default_bucket(c).alias("default_bucket"),
    )


@query("allowed_hosts", r"""
    WITH u AS (SELECT page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host FROM {pages})
    SELECT page_id, url, host, (host = 'example.com' OR host LIKE '%.example.com' OR host = 'example.org' OR host LIKE '%.example.org') AS allowed FROM u
""")
def allowed_hosts(t: Tables) -> DataFrame:
    hosts = t.spark.createDataFrame([("example.com",), ("Example.org",)], "host string")
    return structure.allowed_host(t.pages.select("page_id", "url"), hosts)


@query("url_normalize", r"""
    WITH u AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'https://user:pw@' || regexp_replace(url, '^https?://', '') ELSE 'git@' || replace(regexp_replace(url, '^https?://', ''), '/', ':') END AS remote FROM {pages})
    SELECT page_id, remote, CASE WHEN remote LIKE 'git@%' THEN 'https://' || regexp_extract(remote, '^git@([^:]*):(.*)$', 1) || '/' || regexp_extract(remote, '^git@([^:]*):(.*)$', 2)
           ELSE 'https://' || lower(regexp_extract(remote, '@([^/?#]*)', 1)) || regexp_extract(remote, '^https://[^/]*([^?#]*)', 1) END AS normalized
    FROM u
""")
def url_normalize(t: Tables) -> DataFrame:
    scp = F.concat(F.lit("git@"), F.replace(F.regexp_replace("url", "^https?://", ""), F.lit("/"), F.lit(":")))
    remote = F.when(F.col("page_id") % 2 == 0, F.regexp_replace("url", "^https?://", "https://user:pw@")).otherwise(scp)
    rows = t.pages.select("page_id", remote.alias("remote"))
    return rows.withColumn("normalized", paths.normalize_remote(F.col("remote")))


@query("clean_label", f"""
    SELECT doc_id, regexp_replace(regexp_replace({sql_collapse("text || ' ::'")}, ':+$', ''), ' +$', '') AS label FROM {{documents}}
""")
def clean_label(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.clean_label(F.concat("text", F.lit(" ::"))).alias("label"))


@query("xml_safe", r"""
    SELECT doc_id, regexp_replace(replace(text, 'en', chr(11) || chr(7)), '[^\x{9}\x{A}\x{D}\x{20}-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]', ' ', 'g') AS safe FROM {documents}
""")
def xml_safe(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.xml_safe(F.replace("text", F.lit("en"), F.lit("\x0b\x07"))).alias("safe"))


@query("safe_label", r"""
    SELECT doc_id, CASE WHEN s = '' THEN 'export' ELSE s END AS label
    FROM (SELECT doc_id, regexp_replace(regexp_replace(text, '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g') AS s FROM {documents})
""")
def safe_label(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.safe_label(F.col("text")).alias("label"))


@query("format_points", r"""
    WITH v AS (SELECT cast(l_extendedprice AS string) AS raw FROM {lineitem} UNION ALL SELECT cast(l_discount AS string) FROM {lineitem}
               UNION ALL SELECT cast(cast(l_quantity AS int) AS string) || '.000000000' FROM {lineitem} UNION ALL SELECT p_name FROM {part})
    SELECT raw, CASE WHEN try_cast(raw AS double) IS NULL THEN raw
                     WHEN cast(raw AS double) = floor(cast(raw AS double)) THEN cast(cast(raw AS bigint) AS string)
                     ELSE printf('%g', cast(raw AS double)) END AS points, count(*) AS n
    FROM v GROUP BY ALL
""")
def format_points(t: Tables) -> DataFrame:
    li = t.lineitem
    raw = (
        li.select(F.col("l_extendedprice").cast("string").alias("raw"))
        .union(li.select(F.col("l_discount").cast("string")))
        .union(li.select(F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".000000000"))))
        .union(t.part.select("p_name"))
    )
    # format each distinct text once
    return raw.groupBy("raw").agg(F.count("*").alias("n")).withColumn("points", numbers.format_points(F.col("raw")))
