"""Classifiers over titles, headings, links and markup attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .binding import let
from .paths import is_content_file
from .text import clean, contains_any, strip


def is_weekish(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(K.WEEKISH)


def week_number(c: Column) -> Column:
    return F.regexp_extract(F.coalesce(c, F.lit("")), K.WEEKISH, 2).try_cast("int")


def heading_bucket(c: Column, page_title: bool = False) -> Column:
    """Section bucket of a heading (or page title); NULL when no word of the vocabulary occurs."""
    return let(F.lower(strip(F.coalesce(c, F.lit("")))), lambda t: _bucket(t, page_title))


def _bucket(t: Column, page_title: bool) -> Column:
    tail = [("resources", K.RESOURCE_WORDS), ("lessons", K.LESSON_WORDS), ("overview", K.OVERVIEW_WORDS)]
    if page_title:
        tail = tail[1:] + tail[:1]
    out = (
        F.when(contains_any(t, K.CHECKLIST_WORDS), "checklist")
        .when(contains_any(t, K.PRACTICE_WORDS), "practice")
        .when(contains_any(t, K.OBJECTIVE_WORDS), "objectives")
        .when(contains_any(t, K.ASSESSMENT_WORDS) | t.rlike(K.EXAM_PATTERN), "assessments")
    )
    for bucket, words in tail:
        out = out.when(contains_any(t, words), bucket)
    return out


def page_default_bucket(page: Column) -> Column:
    return F.when((F.coalesce(page, F.lit("")) == "") | is_weekish(page), "overview").otherwise("other")


def embed_kind(src: Column) -> Column:
    return F.when(contains_any(F.lower(F.coalesce(src, F.lit(""))), K.VIDEO_HOSTS), "Video embed").otherwise("Embedded media")


def is_practice(data_file: Column, src: Column) -> Column:
    return F.lower(F.coalesce(data_file, F.lit(""))).endswith(".practice.json") | F.contains(
        F.lower(F.coalesce(src, F.lit(""))), F.lit(K.PRACTICE_HOST)
    )


def node_kind(resource_type_key: Column, resource_found: Column, material_type: Column, href: Column, has_children: Column) -> Column:
    """Kind of a manifest item from its own key, its resource and its children."""
    target = F.lower(F.regexp_extract(F.coalesce(href, F.lit("")), K.QUICKLINK_TYPE, 1))
    quick = F.when(F.lit(False), "")
    for name, kind in K.QUICKLINK_KINDS.items():
        quick = quick.when(target == name, kind)
    material = F.coalesce(material_type, F.lit(""))
    return (
        F.when(F.coalesce(resource_type_key, F.lit("")) == "D2L.LE.Lti.Link", "lti_link")
        .when(~resource_found, F.when(has_children, "module").otherwise("unresolved"))
        .when(material == "contentmodule", "module")
        .when(material == "content", F.when(is_content_file(href), "content_file").otherwise("html_topic"))
        .when(material == "contentlink", quick.otherwise("quicklink"))
        .when(material == "imsbasiclti_xmlv1p0", "lti_link")
        .when(material == "", "unknown")
        .otherwise(material)
    )


def node_label(kind: Column) -> Column:
    out = F.when(F.lit(False), "")
    for name, label in K.NODE_LABELS.items():
        out = out.when(kind == name, label)
    fallback = F.replace(F.coalesce(kind, F.lit("")), F.lit("_"), F.lit(" "))
    return out.otherwise(F.when(fallback == "", "manifest item").otherwise(fallback))


def hidden_label(kind: Column, href: Column) -> Column:
    from .paths import href_suffix

    ext = F.upper(F.regexp_replace(href_suffix(href), r"^\.+", ""))
    fallback = F.replace(F.coalesce(kind, F.lit("")), F.lit("_"), F.lit(" "))
    return (
        F.when(kind == "html_topic", "HTML content page")
        .when(kind == "content_file", F.when(ext == "", "course file").otherwise(F.concat(ext, F.lit(" course file"))))
        .otherwise(F.when(fallback == "", "manifest item").otherwise(fallback))
    )


def _visual_hit(tokens: Column, key: str) -> Column:
    if key == "side-quest":
        return F.arrays_overlap(tokens, F.array(*[F.lit(x) for x in ("side-quest", "side-quest-panel", "side-quest-header")]))
    if key in ("callout", "note"):
        return F.exists(tokens, lambda t: (t == key) | t.endswith(f"-{key}"))
    if key == "timeline":
        return F.array_contains(tokens, key)
    return F.exists(tokens, lambda t: F.contains(t, F.lit(key)))


def class_tokens(classes: Column) -> Column:
    return F.filter(F.split(F.coalesce(classes, F.lit("")), r"\s+"), lambda t: t != "")


def style_note(style: Column) -> Column:
    """Up to two colour/border facts of an inline style."""

    def fact(name: str, label: str) -> Column:
        found = clean(F.regexp_extract(style, rf"(?i){name}\s*:\s*([^;]+)", 1))
        return let(found, lambda v: F.when((v != "") & ~F.lower(v).startswith("url("), F.concat(F.lit(f"{label}: "), v)))

    facts = F.array(
        fact("background-color", "background"), fact("background", "background"),
        fact("border-color", "border"), fact("border", "border"),
    )
    return F.when(F.coalesce(style, F.lit("")) == "", "").otherwise(F.array_join(F.slice(F.array_compact(facts), 1, 2), "; "))


def _class_label(tokens: Column) -> Column:
    label = F.when(F.arrays_overlap(tokens, F.array(*[F.lit(x) for x in K.VISUAL_EXCLUDED])), F.lit(None).cast("string"))
    for key, name in K.VISUAL_LABELS:
        label = label.when(_visual_hit(tokens, key), name)
    return F.when(F.size(tokens) > 0, label)


def visual_label(tag: Column, classes: Column, style: Column) -> Column:
    """Label of a visual container, NULL when the element is none.

    The first matching class decides; a quiet label hides the element, and an
    inline style speaks only where no class matched.
    """

    def chosen(label: Column) -> Column:
        return (
            F.when(label.isin(*K.QUIET_VISUAL_LABELS), F.lit(None).cast("string"))
            .when(label.isNotNull(), label)
            .otherwise(let(style_note(style), lambda n: F.when(n != "", F.concat(F.lit("Styled section ("), n, F.lit(")")))))
        )

    tokens = F.transform(class_tokens(classes), F.lower)
    return F.when(tag.isin(*K.VISUAL_TAGS), let(let(tokens, _class_label), chosen))


def is_course_introduction(title: Column, is_hidden: Column) -> Column:
    return ~is_hidden & ~is_weekish(title) & contains_any(F.lower(title), K.INTRODUCTION_WORDS)


def reference_class(ref: Column) -> Column:
    """external / server / relative / empty for one quoted src or href."""
    from .paths import cut_query, has_scheme, unquote
    from .text import unescape

    target = cut_query(F.replace(unescape(unquote(strip(ref))), F.lit("\\"), F.lit("/")))
    inside = let(target, lambda t: F.when(t == "", "empty").when(t.startswith("/"), "server").otherwise("relative"))
    return F.when((strip(ref) == "") | has_scheme(ref), "external").otherwise(inside)
