"""Main text of a page by composite text density.

For every node of the parsed page: characters per tag, lowered where links hold
much of the text.  A node's sum adds the densities of its children (its own text
counts as a child).  The node of the largest sum holds the main text; the lowest
density on the path from it to the body is the threshold, and what stands beside
that path with at least this density belongs to the text, too.  An article or main
element raises its nodes' sums and densities by ``BONUS``, and one that holds the page's only
first-level headings is chosen unless paragraphs beside it hold more text; the
article or main that the node lies in is kept but for its blocks below the threshold
that hold little besides links, and but for unmarked blocks below it that stand
beside paragraphs (an advert, a line at the foot).  Chrome that the page names by tag,
role, class or id (menus, adverts, forms, comments ...) is left out before.  Only what names a part
of the layout (a sidebar, a menu, a form around the page) stays where it holds most of the
page's text outside links and no prose stands outside chrome; comments, adverts and notices never do.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import packed, unpacked

# Element names by role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
DROPPED = set("head script style noscript template iframe object svg canvas button select textarea input dialog title xmp noembed noframes".split())
#: Chrome by tag, unless it holds most of the page's text.
FRAMES = {"nav", "footer", "aside", "form"}
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header"
    " hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tr", "td", "th", "thead"}, "tfoot": {"tr", "td", "th", "tbody"},
}
#: A closing rule looks no further up than these.
FENCE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}
#: Whole words of class, id or role that name chrome.
CHROME = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs"
    " masthead footer sidebar aside complementary contentinfo cookie cookies consent notice notices alert popup modal overlay newsletter subscribe"
    " subscription signup login share sharing social comment comments commentlist disqus reply replies respond related recommended search pagination pager toolbar"
    " foot copyright".split()
)
#: Those that may name a part of the layout with the story in it.
LAYOUT = set("nav navbar navigation menu sidebar aside complementary masthead toolbar overlay modal".split())
LAYOUT_TAGS = {"nav", "aside", "form"}
#: Words of names that say that the story is in the element.
CONTENT = set("article body content entry main page post prose story text".split())
#: Signs outside links from which on a block is prose.
PROSE = 40
#: Containers without a meaning of their own.
UNMARKED = {"div", "section", "center"}
ROOTS = {"article", "main"}
#: Blocks that are kept or left out as one; items, rows and cells go with their list or table.
SIEVED = set("address center details dir div dl fieldset figure header hgroup menu ol p pre section table ul".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: What a sum or a density counts more inside an article or main.
BONUS = 1.5
#: What follows in a name says what the element has or lacks; what stands before a state is open or shut on it.
SETTINGS = {"has", "have", "no", "not", "non", "with", "without"}
STATES = {"open", "closed", "enabled", "disabled", "on", "off"}
NEVER = {"html", "body", "article", "main"}

TAG = re.compile(r"""(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
PLAIN_TAG = re.compile(r"(/?)([A-Za-z][^\s/>]*)([^>]*+)>")
ATTRIBUTE = re.compile(r"""([^\s"'/=>][^\s"'/=>]*+)(?:\s*+=\s*+(?:"([^"]*+)"?|'([^']*+)'?|([^\s"'>][^\s>]*+)))?""")
NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
WORDS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")


def _chrome_words(token: str) -> tuple[list[str], bool]:
    """The words of a name that name chrome, and whether the name has no others."""
    words = [w.lower() for w in WORDS.findall(token)]
    if words and words[-1] in STATES:
        return [], False
    end = next((n for n, w in enumerate(words) if w in SETTINGS), len(words))
    found = [w for w in words[:end] if w in CHROME]
    return found, len(found) == len(words)


def _named(value: str) -> int:
    """The kind that a class, id or role gives: a name of other words besides decides only where no name says that the story is here."""
    tokens = value.split()
    named = [_chrome_words(t) for t in tokens]
    story = any(not found and WORDS.findall(t) and WORDS.findall(t)[-1].lower() in CONTENT for t, (found, _) in zip(tokens, named, strict=True))
    words = [w for found, whole in named if found and (whole or not story) for w in found]
    return 0 if not words else 3 if all(w in LAYOUT for w in words) else 1


def _kind(tag: str, attributes: str) -> int:
    """2: never text; 1: chrome by its name; 3: a part of the layout by its name; 0: none of them."""
    if tag in DROPPED:
        return 2
    kind = 0 if tag not in FRAMES else 3 if tag in LAYOUT_TAGS else 1
    if not attributes or tag in NEVER:
        return kind
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true") or (name == "style" and NO_DISPLAY.search(value)):
            return 2
        if kind != 1 and name in ("class", "id", "role"):
            kind = _named(value) or kind
    return kind


class Page:
    """Nodes in page order: tag, parent, chrome or not; and texts with the node that holds them."""

    def __init__(self, source: str) -> None:
        self.tags, self.parents, self.kinds = ["html"], [-1], [0]
        #: (node, text) in page order; text None where a block starts or ends, " " for a line break
        self.items: list[tuple[int, str | None]] = []
        self._parse(source)
        self.chrome = self._chrome()

    def _parse(self, source: str) -> None:
        stack, opened = [0], Counter({"html": 1})
        tags, items = self.tags, self.items
        quotes, at, size = True, 0, len(source)

        def pop_to(name: str) -> None:
            while stack[-1]:
                tag = tags[stack.pop()]
                opened[tag] -= 1
                if tag in BLOCKS:
                    items.append((stack[-1], None))
                if tag == name:
                    return

        while at < size:
            begin = source.find("<", at)
            if begin < 0:
                begin = size
            if begin > at:
                items.append((stack[-1], source[at:begin]))
            if begin == size:
                break
            if source.startswith("<!--", begin):
                end = source.find("-->", begin + 4)
                at = size if end < 0 else end + 3
                continue
            if source[begin + 1 : begin + 2] in ("!", "?"):
                end = source.find(">", begin)
                at = size if end < 0 else end + 1
                continue
            found = TAG.match(source, begin + 1) if quotes else None
            if found is None:
                found = PLAIN_TAG.match(source, begin + 1)
                if found is not None:
                    quotes = False  # an open quote: from here on a tag ends at its first ">"
            if found is None:
                items.append((stack[-1], "<"))
                at = begin + 1
                continue
            at = found.end()
            closing, name, attributes = found.groups()
            name = name.lower()
            if closing:
                if opened[name] > 0 and name != "html":
                    pop_to(name)
                elif name == "br":
                    items.append((stack[-1], " "))
                continue
            if name == "html":
                continue
            if name == "br":
                items.append((stack[-1], " "))
            if name in BLOCKS:
                if opened["p"] > 0:
                    pop_to("p")
                fence = FENCE.get(name, ())
                shut = CLOSES.get(name, ())
                if any(opened[s] > 0 for s in shut):
                    for depth in range(len(stack) - 1, 0, -1):
                        tag = tags[stack[depth]]
                        if tag in fence:
                            break
                        if tag in shut:
                            pop_to(tag)
                            break
                items.append((stack[-1], None))
            node = len(tags)
            tags.append(name)
            self.parents.append(stack[-1])
            self.kinds.append(2 if self.kinds[stack[-1]] == 2 else _kind(name, attributes))
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at)
                close = -1 if end is None else source.find(">", end.end())
                at = size if close < 0 else close + 1
            elif name not in VOID and not attributes.endswith("/"):
                stack.append(node)
                opened[name] += 1

    def _chrome(self) -> list[bool]:
        """Nodes left out: what is never text and named chrome, but for parts of the layout that hold most of the text outside links of a page without prose outside chrome."""
        tags, parents, kinds, count = self.tags, self.parents, self.kinds, len(self.tags)
        out, linked = [False] * count, [False] * count
        for node in range(1, count):
            out[node] = out[parents[node]] or kinds[node] != 0
            linked[node] = linked[parents[node]] or tags[node] == "a"
        if 3 not in kinds:
            return out
        plain, run, prose = [0] * count, 0, False
        for node, text in self.items:
            if text is None:
                run = 0
            elif text and kinds[node] != 2 and not linked[node]:
                signs = len(text) - text.count(" ") - text.count("\n")
                plain[node] += signs
                if not out[node]:
                    run += signs
                    prose = prose or run >= PROSE
        if prose:
            return out
        for node in range(count - 1, 0, -1):
            # what a part of the layout holds in chrome that never counts isn't its text
            if kinds[node] != 1:
                plain[parents[node]] += plain[node]
        for node in range(1, count):
            most = 2 * plain[node] > plain[0]
            out[node] = out[parents[node]] or kinds[node] in (1, 2) or (kinds[node] == 3 and not most)
        return out

    def main_text(self) -> str:
        tags, parents, count = self.tags, self.parents, len(self.tags)
        own, chars, link_chars, links, below = [0] * count, [0] * count, [0] * count, [0] * count, [0] * count
        for node, text in self.items:
            if text and not self.chrome[node]:
                own[node] += len(text) - text.count(" ") - text.count("\n")
        for node in range(count):
            chars[node] = own[node]
        for node in range(count - 1, 0, -1):  # children come after their parents
            if self.chrome[node]:
                continue
            if tags[node] == "a":
                link_chars[node], links[node] = chars[node], links[node] + 1
            up = parents[node]
            chars[up] += chars[node]
            link_chars[up] += link_chars[node]
            links[up] += links[node]
            below[up] += below[node] + 1
        if not chars[0]:
            return ""
        share = link_chars[0] / chars[0]
        density = [0.0] * count
        for node in range(count):
            c = chars[node]
            if c:
                tag_count, lc, lt = below[node] or 1, link_chars[node] or 1, links[node] or 1
                base = math.log(c / (c - link_chars[node] or 1) * lc + share * c + math.e)
                density[node] = c / tag_count * max(math.log(c / lc * tag_count / lt), 0.0) / math.log(base) if base > 1 else 0.0
        sums = [float(n) for n in own]
        root = [-1] * count  # the outermost article or main that a node lies in
        for node in range(1, count):
            sums[parents[node]] += density[node]
            root[node] = root[parents[node]]
            if root[node] < 0 and tags[node] in ROOTS and not self.chrome[node] and chars[node]:
                root[node] = node
        chosen = self._titled(chars, root)
        open_nodes = [n for n in range(count) if not self.chrome[n] and chars[n] and chosen in (-1, root[n])]
        best = max(open_nodes, key=lambda n: (sums[n] * (BONUS if root[n] >= 0 else 1), -n))
        path = [best]
        while parents[path[-1]] >= 0:
            path.append(parents[path[-1]])
        on_path = set(path)
        least = min(density[n] for n in path)
        # Below the article on the path, or else the main element, only blocks of links need the threshold; elsewhere all that stands beside the path does.
        whole = next((n for name in ("article", "main") for n in reversed(path) if tags[n] == name), best)
        strays = self._strays(chars)
        keep = [False] * count
        for node in range(count):
            if self.chrome[node]:
                continue
            up, weight = parents[node], BONUS if root[node] >= 0 else 1
            if tags[node] in SIEVED and node not in on_path and density[node] < least and (2 * link_chars[node] > chars[node] or strays[node]):
                continue
            if node in (best, whole) or (up >= 0 and keep[up]):
                keep[node] = True
            elif up in on_path and node not in on_path:
                if chosen < 0 or root[node] == chosen:
                    keep[node] = density[node] * weight >= least or (root[node] >= 0 and root[node] == root[best] and tags[node] in HEADINGS)
            if chosen >= 0 and root[node] == node != chosen and density[node] * weight >= least:
                keep[node] = True
        return self._blocks(keep)

    def _strays(self, chars: list[int]) -> list[bool]:
        """Unmarked elements without blocks inside, beside paragraphs and the like that hold far more: an advert, a line at the foot."""
        blocks, marked = [0] * len(self.tags), [0] * len(self.tags)
        for node in range(1, len(self.tags)):
            if self.tags[node] in BLOCKS and not self.chrome[node]:
                blocks[self.parents[node]] += 1
                marked[self.parents[node]] += 0 if self.tags[node] in UNMARKED else chars[node]
        return [t in UNMARKED and not b and marked[up] > 4 * c for t, b, up, c in zip(self.tags, blocks, self.parents, chars, strict=True)]

    def _titled(self, chars: list[int], root: list[int]) -> int:
        """The article or main that holds all first-level headings of the page, or -1: none, several, or more text in paragraphs beside it."""
        tags, count = self.tags, len(self.tags)
        titled = {root[n] for n in range(count) if tags[n] == "h1" and chars[n] and not self.chrome[n]}
        found = titled.pop() if len(titled) == 1 else -1
        beside = sum(chars[n] for n in range(count) if tags[n] == "p" and not self.chrome[n] and root[n] != found)
        return found if found >= 0 and beside <= chars[found] else -1

    def _blocks(self, keep: list[bool]) -> str:
        blocks, run = [], []
        for node, text in self.items:
            if text is None:
                if run:
                    blocks.append("".join(run))
                    run = []
            elif keep[node]:
                run.append(html.unescape(text) if "&" in text else text)
        blocks.append("".join(run))
        return "\n".join(filter(None, (" ".join(b.split()) for b in blocks)))


def main_text(source: str | None) -> str:
    return Page(source).main_text() if source else ""


def extract(pages: DataFrame, source: str = "html") -> DataFrame:
    """All rows and columns plus text and n_chars (code points).

    Null or empty html, and pages without text, give the empty string.  Rows are
    independent, so repeated rows get equal results.  Input columns named like an
    output are replaced.
    """

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(v) for v in batch], dtype=object)

    done = packed(pages, _html=F.col(f"`{source}`")).withColumn("text", text_of("_html"))
    return unpacked(done.withColumn("n_chars", F.length("text").cast("long")), pages.columns, "text", "n_chars")
