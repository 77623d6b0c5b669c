"""Text normalisers built only from JVM-side column expressions."""

from __future__ import annotations

from functools import reduce
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

# Every character Python, HTML and XML readers treat as blank space.
_BLANK = r"\s\x0B\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
SPACE = f"[{_BLANK}]"
_SOLID = f"[!-~[^{_BLANK}]]"
NOT_XML_SAFE = r"[^\x{9}\x{A}\x{D}\x{20}-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]"
SCRIPT_STYLE = r"(?is)<(script|style)\b.*?</\1>"

def strip(c: Column) -> Column:
    """Trim every kind of blank space at both ends; the text between them is passed over, not searched."""
    return F.regexp_extract(c, f"(?s)^{SPACE}*+((?:.*{_SOLID})?)", 1)


def clean(c: Column) -> Column:
    return strip(F.coalesce(c.cast("string"), F.lit("")))


def collapse(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, f"{SPACE}+", " "), f"^{SPACE}+|{SPACE}+$", "")


def xml_safe(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), NOT_XML_SAFE, " ")


def clean_text(c: Column) -> Column:
    return collapse(xml_safe(c))


def clean_label(c: Column) -> Column:
    return strip(F.regexp_replace(clean_text(c), ":+$", ""))


def safe_label(c: Column) -> Column:
    kept = F.regexp_replace(F.regexp_replace(c, r"[^A-Za-z0-9._-]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(kept, F.lit("")), F.lit("export"))


def _reference_table() -> tuple[str, str]:
    """The HTML5 table of the standard library as one string, and the prefix pattern of its bare names.

    One string literal keeps plans small; a map literal of 2,231 entries makes
    every plan traversal slow.
    """
    bare_names = sorted((k for k in html5 if not k.endswith(";")), key=lambda k: (-len(k), k))
    table = "".join(f"\x01{name}\x02{char}" for name, char in sorted(html5.items())) + "\x01"
    return table, "^(" + "|".join(bare_names) + ")"


# Code points 128-159 as browsers read them: Windows-1252 where it defines one.
_WINDOWS = "".join(bytes([n]).decode("cp1252", errors="ignore") or chr(n) for n in range(128, 160))
_TABLE, _BARE = _reference_table()

_FROM_CODE = """
element_at(transform(array(coalesce({code}, 1114112L)), n -> CASE
    WHEN n = 13 THEN chr(13)
    WHEN n BETWEEN 128 AND 159 THEN substring(v.w, CAST(n - 127 AS INT), 1)
    WHEN n = 0 OR n BETWEEN 55296 AND 57343 OR n > 1114111 THEN decode(unhex('0000FFFD'), 'UTF-32')
    WHEN n BETWEEN 1 AND 8 OR n = 11 OR n BETWEEN 14 AND 31 OR n = 127 OR n BETWEEN 64976 AND 65007
        OR n % 65536 >= 65534 THEN ''
    ELSE decode(unhex(lpad(hex(n), 8, '0')), 'UTF-32') END), 1)
"""
_BY_NAME = """
element_at(transform(array(regexp_extract(p, {pattern}, 1)), k -> CASE WHEN k <> '' THEN
    concat(nullif(split_part(split_part(v.t, concat(chr(1), k, chr(2)), 2), chr(1), 1), ''),
           substring(p, length(k) + 1)) END), 1)
"""
_COMMON_REPLACED = reduce(
    lambda inner, pair: f"replace({inner}, '{pair[0]}', {pair[1]})",
    (
        ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "chr(34)"), ("&#39;", "chr(39)"), ("&apos;", "chr(39)"),
        ("&nbsp;", "chr(160)"), ("&copy;", "chr(169)"), ("&middot;", "chr(183)"), ("&amp;", "'&'"),
    ),
    "v.s",
)
_UNESCAPE = f"""
v -> CASE
  WHEN NOT contains(v.s, '&') THEN v.s
  WHEN NOT rlike(v.s, r'&(?!(?:amp|lt|gt|quot|nbsp|copy|middot|#39|apos);|[^#A-Za-z]|$)') THEN {_COMMON_REPLACED}
  ELSE array_join(transform(split(v.s, '&'), (p, i) -> CASE
    WHEN i = 0 THEN p
    WHEN rlike(p, '^#[0-9]') THEN concat(
      {_FROM_CODE.format(code="try_cast(regexp_extract(p, '^#([0-9]+)', 1) AS BIGINT)")},
      regexp_replace(p, '^#[0-9]+;?', ''))
    WHEN rlike(p, '^#[xX][0-9a-fA-F]') THEN concat(
      {_FROM_CODE.format(code="try_cast(conv(regexp_extract(p, '^#[xX]([0-9a-fA-F]+)', 1), 16, 10) AS BIGINT)")},
      regexp_replace(p, '^#[xX][0-9a-fA-F]+;?', ''))
    ELSE coalesce(
      {_BY_NAME.format(pattern="'^([A-Za-z][A-Za-z0-9]*;)'")},
      {_BY_NAME.format(pattern="v.b")},
      concat('&', p)) END), '') END
"""


def unescape(c: Column) -> Column:
    """HTML character references to text.

    Common references are plain replacements (``&amp;`` last, so nothing is
    unescaped twice).  Only text holding any other reference takes the general
    route: split at ``&`` and decode the head of each piece.
    """
    bound = F.struct(c.alias("s"), F.lit(_TABLE).alias("t"), F.lit(_BARE).alias("b"), F.lit(_WINDOWS).alias("w"))
    return F.element_at(F.call_function("transform", F.array(bound), F.expr(_UNESCAPE)), 1)


def flatten_html(c: Column) -> Column:
    return collapse(unescape(F.regexp_replace(c, r"<[^>]+>", " ")))


def drop_script_style(c: Column) -> Column:
    return F.regexp_replace(c, SCRIPT_STYLE, " ")


def html_to_text(c: Column) -> Column:
    return flatten_html(drop_script_style(c))


def rich_text(c: Column) -> Column:
    """Flatten cell HTML but keep a line per block element."""
    return let(unescape(F.coalesce(c, F.lit(""))), _rich_text)


def _rich_text(raw: Column) -> Column:
    broken = F.regexp_replace(raw, r"(?i)<(?:(?:p|br|div|tr|li|td)\b[^>]*|/(?:p|div|tr|li|td)\s*)>", "\n")
    plain = unescape(F.regexp_replace(broken, r"<[^>]+>", ""))
    lines = F.filter(F.transform(F.split(plain, r"[\n\r\x0B\x0C\x1C\x1D\x1E\x85\u2028\u2029]"), collapse), lambda x: x != "")
    return F.when(F.contains(raw, F.lit("<")) & F.contains(raw, F.lit(">")), F.array_join(lines, "\n")).otherwise(strip(raw))


def md_escape(c: Column) -> Column:
    return F.replace(clean_text(c), F.lit("|"), F.lit("\\|"))


def md_run(text: Column, href: Column) -> Column:
    """One inline run: only web and mail links stay clickable."""
    return let(md_escape(text), lambda shown: let(clean(href), lambda link: _md_run(shown, link)))


def _md_run(shown: Column, link: Column) -> Column:
    live = link.startswith("http://") | link.startswith("https://") | link.startswith("mailto:")
    return (
        F.when(shown == "", F.lit(""))
        .when(live, F.concat(F.lit("["), shown, F.lit("]("), link, F.lit(")")))
        .when(link != "", F.concat(shown, F.lit(" ("), md_escape(link), F.lit(")")))
        .otherwise(shown)
    )


def quoted(c: Column) -> Column:
    """A value in single quotes for report messages."""
    return F.concat(F.lit("'"), F.coalesce(c, F.lit("")), F.lit("'"))


def contains_any(c: Column, words) -> Column:
    """True when any of the words occurs in the (already lower-case) text."""
    found = F.contains(c, F.lit(words[0]))
    for word in words[1:]:
        found = found | F.contains(c, F.lit(word))
    return found


def is_true(c: Column) -> Column:
    """Both boolean vocabularies of the tool files: true/false and yes/no."""
    return F.lower(clean(c)).isin("true", "yes")


def try_date(c: Column) -> Column:
    """ISO date or date-time to a date; anything else becomes NULL."""
    return let(F.replace(clean(c), F.lit("Z"), F.lit("")), _iso_date)


def _iso_date(raw: Column) -> Column:
    iso = raw.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,6})?)?)?([+-]\d{2}:?\d{2})?)?$")
    return F.when(iso, F.substring(raw, 1, 10).try_cast("date"))
