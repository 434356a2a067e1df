"""Main-text extraction by tree scoring.

Paragraphs earn points for length and commas and pass them to their ancestors, less with distance; an element's points
are discounted by the share of its text that is links.  The best container is kept, with those of its siblings that read
like it, whatever their length; menus, forms, adverts and the like are cut out of the tree beforehand.

Parsing and scoring take time in proportion to the page, however deep, unbalanced or broken its markup is.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
DROPPED = frozenset("head script style title textarea nav footer aside form noscript iframe button select option template svg canvas object audio video math dialog menu input label fieldset noembed noframes xmp map".split())
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
PARAGRAPHS = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6 div section article main".split())
#: A start tag here closes an open paragraph.
CLOSES_P = BLOCKS - {"body", "html"}
#: Elements that a start tag of their like closes if it is open below the nearest container: paragraphs, items, rows, cells.
KIND = {"p": 0, "li": 1, "dt": 2, "dd": 2, "tr": 3, "td": 4, "th": 4}
LIMITS = frozenset("ul ol dl table tbody thead tfoot menu body html div article section main".split())
#: Words of a class, id or role that mark what is no main text.
UNLIKELY = frozenset(
    "ad ads advert adverts advertisement advertising adbox adsense banner breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies disclaimer disqus footer gdpr header masthead menu "
    "modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promotion related recommended replies reply respond share sharing sidebar signup skip social sponsor sponsored "
    "subscribe subscription tags toolbar widget complementary contentinfo alert search login".split()
)
#: Words that mark a container as main text.
LIKELY = frozenset("article body content entry main page post story text".split())
#: Words of a name that says what an element has or lacks, not what it is.
SAYS_HAS = frozenset("has with no without".split())

#: A comment, a declaration, or the name of a tag; and what stands in a tag up to a quote or its end.
_TAG = re.compile(r"<(?:!--(?:.*?--!?>|.*)|[!?][^>]*+>|/[^a-zA-Z>][^>]*+>|(/?)([a-zA-Z][^\s/>]*+))", re.S)
_UNQUOTED = re.compile(r"[^>\"']*+")
_NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "parent", "children", "words", "length", "linked", "commas", "flow", "points", "open", "inside")

    def __init__(self, tag: str, parent: Node | None, words: frozenset = frozenset()) -> None:
        self.tag, self.parent, self.words = tag, parent, words
        self.children: list[Node | str] = []
        self.length = self.linked = self.commas = 0
        #: Length and commas of the text that is not in blocks of its own.
        self.flow = (0, 0)
        self.points = 0.0
        #: The nearest open element of each KIND below the nearest container, and whether an article is open.
        self.open: tuple = (None,) * 5 if parent is None or tag in LIMITS else parent.open
        if tag in KIND:
            k = KIND[tag]
            self.open = (*self.open[:k], self, *self.open[k + 1 :])
        self.inside: bool = tag in ("article", "main") or parent is not None and parent.inside


def _marks(attributes: str) -> tuple[frozenset, bool, bool]:
    """The words of class, id and role, whether a name says that the element is no main text, and whether it is hidden.

    A name that has words of both sorts, as comment-body, is of the unlikely sort unless it is a header's or says what
    the element has or lacks; an element with such a name and another that speaks for it stays.
    """
    words, bad, good, hidden = set(), False, False, False
    for name, *values in _NAMED.findall(attributes):
        value = "".join(values).lower()
        if name.lower() == "hidden" or name.lower() == "aria-hidden" and value == "true":
            hidden = True
        elif name.lower() in ("class", "id", "role"):
            for part in value.split():
                own = _WORD.findall(part)
                against = bool(UNLIKELY.intersection(own))
                if LIKELY.intersection(own) and (not against or "header" in own) or SAYS_HAS.intersection(own):
                    good = good or bool(LIKELY.intersection(own))
                else:
                    bad = bad or against
                words.update(own)
    return frozenset(words), bad and not good, hidden


class _Scanner:
    """Finds the ends of tags; once a quote turns out to be open to the end of the page, quotes mean nothing any more."""

    def __init__(self, html: str) -> None:
        self.html, self.quotes = html, True

    def end(self, at: int) -> int:
        """The place of the > that ends the tag whose name ends at `at`, or -1."""
        if self.quotes:
            here = at
            while (here := _UNQUOTED.match(self.html, here).end()) < len(self.html):
                if self.html[here] == ">":
                    return here
                here = self.html.find(self.html[here], here + 1) + 1
                if not here:
                    break
            self.quotes = False
        return self.html.find(">", at)


def parse(html: str) -> Node:
    """The tree of a page without what is never main text; any input gives a tree."""
    root = node = Node("html", None)
    scanner, opened = _Scanner(html), Counter()
    skip, depth, at = "", 0, 0
    end, last = len(html), html.rfind(">")

    def closed(upto: Node) -> Node:
        """Leave all open elements up to this one."""
        at = node
        while at is not upto.parent:
            opened[at.tag] -= 1
            at = at.parent
        return at

    while at < end:
        m = _TAG.search(html, at) if at <= last or "<!--" in html[max(at, last) :] else None
        if not skip and (text := html[at : m.start() if m else end]):
            node.children.append(text)
        if m is None:
            break
        at = m.end()
        close, tag = m.groups()
        if not tag:
            continue
        stop = scanner.end(at)
        if stop < 0:
            if not skip:
                node.children.append(m[0])
            continue
        attributes, at = html[at:stop], stop + 1
        tag = tag.lower()
        if not close and tag in RAW:
            # the text of these ends at their own end tag only
            ends = re.compile(rf"</{tag}[\s/>]", re.I).search(html, at)
            at = ends.start() if ends else end
            if not skip and tag not in DROPPED:
                continue
        if skip:
            if tag == skip and not attributes.endswith("/"):
                depth += -1 if close else 1
                if not depth:
                    skip = ""
            continue
        if close:
            if opened[tag] > 0:
                found = node
                while found.tag != tag:
                    found = found.parent
                node = closed(found)
            continue
        if tag == "br":
            node.children.append(" ")
            continue
        if tag in CLOSES_P and node.open[0] is not None:
            node = closed(node.open[0])
        if tag in KIND and tag != "p":
            found = node.open[KIND[tag]] or (node.open[4] if tag == "tr" else None)
            if found is not None:
                node = closed(found)
        if tag in ("html", "body"):
            continue
        words, unlikely, hidden = _marks(attributes) if attributes else (frozenset(), False, False)
        if tag in DROPPED or hidden or (tag == "header" and not node.inside) or (unlikely and tag not in ("article", "main")):
            if tag not in VOID and not attributes.endswith("/"):
                skip, depth = tag, 1
            continue
        new = Node(tag, node, words)
        node.children.append(new)
        if tag not in VOID and not attributes.endswith("/"):
            node = new
            opened[tag] += 1
    return root


def _measure(root: Node) -> list[Node]:
    """All elements in page order, with the lengths of their text and of its linked part, without recursion."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    for node in reversed(order):
        strings = [c for c in node.children if isinstance(c, str)]
        length, commas = sum(len(c.strip()) for c in strings), sum(c.count(",") for c in strings)
        node.flow = (node.flow[0] + length, node.flow[1] + commas)
        node.length, node.commas = node.length + length, node.commas + commas
        if node.tag == "a":
            node.linked = node.length
        if up := node.parent:
            up.length, up.commas, up.linked = up.length + node.length, up.commas + node.commas, up.linked + node.linked
            if node.tag not in BLOCKS:
                up.flow = (up.flow[0] + node.length, up.flow[1] + node.commas)
    return order


def _density(node: Node) -> float:
    return node.linked / node.length if node.length else 0.0


def _reads_like_text(node: Node | str) -> bool:
    """Whether what stands beside the main container belongs to it: headings, text of its own and what holds paragraphs.

    Lists of links do not, nor do boxes without a paragraph, a heading or the end of a sentence.
    """
    if isinstance(node, str):
        return bool(node.strip())
    if re.fullmatch("h[1-6]|hgroup", node.tag):
        return True
    density = _density(node)
    if node.tag not in BLOCKS or node.tag in ("p", "pre", "blockquote", "figure", "figcaption", "table", "ul", "ol", "dl"):
        return density < 0.5
    if density >= 0.25:
        return False
    stack: list = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            if x.rstrip().endswith((".", "!", "?", ":", "\u2026", "\u3002", "\u201d", '"')):
                return True
        elif x.tag in ("p", "pre", "blockquote") or re.fullmatch("h[1-6]", x.tag):
            return True
        else:
            stack += x.children
    return False


def best(root: Node) -> list[Node | str]:
    """The container of the main text and those siblings that belong to it, in page order.

    The container is widened to the article that it is part of, or, as long as all that stands beside it belongs to it,
    to its parent.
    """
    order = _measure(root)
    for node in order:
        if node.tag not in PARAGRAPHS or not node.flow[0]:
            continue
        points = 1.0 + node.flow[1] + min(node.flow[0] / 100, 3.0)
        up, share = (node if node.tag in ("div", "section", "article", "main", "td") else node.parent), 1.0
        for distance in range(1, 6):
            if up is None:
                break
            up.points += points * share
            up, share = up.parent, 0.5 / distance
    top, most = root, -1.0
    for node in order:
        if node.tag not in BLOCKS or node.tag in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6"):
            continue
        node.points *= 1 - _density(node)
        if node.tag in ("article", "main") or node.words & LIKELY:
            node.points *= 1.5
        if node.points > most and node.parent is not None:
            top, most = node, node.points
    if top.parent is None or most <= 0:
        return [root]
    at = top
    while at is not None and at.tag != "article":
        at = at.parent
    top = at or top
    limit = max(10.0, 0.2 * top.points)
    while True:
        beside = [x for x in top.parent.children if isinstance(x, Node) and x.length or isinstance(x, str) and x.strip()]
        kept = [x for x in beside if x is top or isinstance(x, Node) and x.points >= limit or _reads_like_text(x)]
        if len(kept) < len(beside) or top.parent.parent is None:
            return kept
        top = top.parent


def main_text(html: str | None) -> str:
    """The blocks of the main text, one to a line, with character references decoded and white space collapsed."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        if line:
            if text := _SPACE.sub(" ", unescape("".join(line))).strip():
                out.append(text)
            line.clear()

    for top in best(parse(html or "")):
        stack: list = [top]
        while stack:
            x = stack.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                line.append(x)
            elif x.tag in BLOCKS:
                flush()
                stack.append(None)
                stack += reversed(x.children)
            else:
                stack += reversed(x.children)
        flush()
    return "\n".join(out)


@F.arrow_udf(T.StringType())
def _extracted(column: pa.Array) -> pa.Array:
    return pa.array([main_text(x) for x in column.to_pylist()], pa.string())


def extracted(html: Column | str) -> Column:
    return _extracted(html)


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    A null or empty page, and one without text, has an empty text; broken markup is read as far as it goes; repeated rows
    get equal texts; ties between containers go to the first in the page.  Other columns are ignored; an empty table
    gives an empty result.
    """
    return pages.select("page_id", "url", extracted("html").alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
