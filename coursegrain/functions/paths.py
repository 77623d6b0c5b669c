"""Package paths and hrefs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .binding import let
from .text import clean, unescape


def _one_of(words) -> str:
    return "|".join(words)


def unquote(c: Column) -> Column:
    """Percent-decoding that keeps ``+`` and malformed escapes as written."""

    def decoded(raw: Column) -> Column:
        safe = F.replace(F.regexp_replace(raw, r"%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))
        return F.when(F.contains(raw, F.lit("%")), F.coalesce(F.try_url_decode(safe), raw)).otherwise(raw)

    return let(c, decoded)


def cut_query(c: Column) -> Column:
    return F.split_part(F.split_part(c, F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1))


def href_path_part(href: Column) -> Column:
    plain = F.replace(unescape(unquote(F.coalesce(href, F.lit("")))), F.lit("\\"), F.lit("/"))
    return F.regexp_replace(cut_query(plain), "^/+", "")


def has_scheme(href: Column) -> Column:
    return F.lower(clean(href)).rlike("^(" + "|".join(K.NON_LOCAL_PREFIXES) + ")")


def is_local_href(href: Column) -> Column:
    return (clean(href) != "") & ~has_scheme(href)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1)


def href_suffix(href: Column) -> Column:
    name = file_name(href_path_part(href))
    return F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1))


def is_content_file(href: Column) -> Column:
    return let(href_suffix(href), lambda ext: (ext != "") & ~ext.isin(*K.PAGE_SUFFIXES))


def parent_dir(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def resolve(base_dir: Column, ref: Column) -> Column:
    """Join a relative reference to a folder and fold ``.`` and ``..``."""
    steps = F.split(F.concat_ws("/", base_dir, ref), "/")
    folded = F.aggregate(
        steps,
        F.expr("cast(array() as array<string>)"),
        lambda acc, s: F.when((s == "") | (s == "."), acc)
        .when(s == "..", F.when(F.size(acc) > 0, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.concat(acc, F.array(s))),
    )
    return F.array_join(folded, "/")


def is_junk(path: Column) -> Column:
    return F.exists(F.split(path, "/"), lambda p: p.isin(*K.JUNK_PARTS) | p.startswith("._"))


def file_category(path: Column, variant: str = "inventory") -> Column:
    """First matching class of a package file; ``variant`` picks the inventory or scope lists."""
    low, name = F.lower(path), F.lower(file_name(path))
    core, html = (
        (K.CORE_FILES_INVENTORY, K.HTML_SUFFIXES_INVENTORY)
        if variant == "inventory"
        else (K.CORE_FILES_SCOPE, K.HTML_SUFFIXES_SCOPE)
    )
    ends = lambda words: low.rlike(rf"\.({_one_of(words)})$")
    return (
        F.when(name.isin(*core) | name.startswith(K.CORE_PREFIXES[0]) | name.startswith(K.CORE_PREFIXES[1]), "d2l_xml")
        .when(ends(K.XML_SUFFIXES), "xml")
        .when(ends(html), "html")
        .when(ends(K.IMAGE_SUFFIXES), "image")
        .when(ends(K.MEDIA_SUFFIXES), "media")
        .when(ends(K.DOCUMENT_SUFFIXES), "document")
        .when(ends(K.FRONTEND_SUFFIXES), "frontend_support")
        .otherwise("other")
    )


def normalize_remote(url: Column) -> Column:
    """Repository address without credentials, query or fragment; scp form becomes https."""
    raw = clean(url)
    scp = F.regexp_extract(raw, r"^git@([^:]*):(.*)$", 1)
    scp_path = F.regexp_extract(raw, r"^git@([^:]*):(.*)$", 2)
    scheme = F.regexp_extract(raw, r"^(https?)://", 1)
    authority = F.regexp_extract(raw, r"^https?://([^/?#]*)", 1)
    host = F.lower(F.regexp_replace(authority, r"^.*@", ""))
    path = F.regexp_extract(raw, r"^https?://[^/?#]*([^?#]*)", 1)
    return (
        F.when(raw == "", F.lit(None).cast("string"))
        .when(raw.startswith("git@") & F.contains(raw, F.lit(":")), F.concat(F.lit("https://"), scp, F.lit("/"), scp_path))
        .when(scheme != "", F.concat(scheme, F.lit("://"), host, path))
        .otherwise(raw)
    )


def url_host(url: Column) -> Column:
    authority = F.regexp_extract(url, r"(?i)^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    bare = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", "")
    return F.regexp_replace(F.lower(bare), r"\.+$", "")
