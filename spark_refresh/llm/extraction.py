"""Main text of web pages by scores on the tree.

A page is read into a tree of elements. Each paragraph of some length gives points for its
length and commas to its parent and, halved, to its grandparent; the points of an element
are discounted by its share of link text. From the best element the choice climbs to the
outermost element below the body that has further paragraphs and few links, so that an article
cut into uneven parts is taken whole; siblings there that score near it, or are prose
themselves, are kept. What is marked as menu, advert, form, notice or comment within them is
left out; marks that an article's own parts may carry as well (``tags``, ``social-...``,
``related``) count only where the element is full of links or has no prose.

Null and empty pages, and pages without text of their own, give an empty text. Each page is
handled by itself, so ties do not occur between rows and repeated rows give repeated results;
of two elements with equal scores the earlier one is taken. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset(
    "script style template noscript iframe object embed applet canvas svg math audio video map head title "
    "nav header footer aside menu form button input select textarea option datalist fieldset dialog".split())
BLOCKS = frozenset(
    "address article blockquote body center dd details dir div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr html "
    "li main ol p pre section summary table tbody td tfoot th thead tr ul caption legend".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6 figcaption dt".split())
CLOSES_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
HEAD = frozenset("base link meta noscript script style template title".split())
#: An opening element ends open ones of these kinds (within the nearest of the second set).
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|menu|nav\w*|breadcrumbs?|sidebar|footer|header|masthead|cookie\w*|consent|"
    r"notice|popup|modal|newsletter|subscribe|signup|login|share|sharing|comments?|commentlist|"
    r"disqus|replies|reply|pager|pagination|skip|copyright|gdpr|byline-share)(?:$|[\s_-]|\d)", re.I)
#: Marks that need a look at the element itself.
DOUBTFUL = re.compile(r"(?:^|[\s_-])(?:social|related|recommend\w*|legal|search|tags?|widget|toolbar|rail|overlay)(?:$|[\s_-]|\d)", re.I)
LIKELY = re.compile(r"(?:^|[\s_-])(?:article|content|main|body|entry|post|story|text)(?:$|[\s_-])", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
TAG = re.compile(r"<(?:!--(?:.*?(?:-->|--!>|$))|!\[CDATA\[.*?(?:\]\]>|$)|[!?][^>]*(?:>|$)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$))", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACE = re.compile(r"\s+")
COMMAS = re.compile(r"[,،、，;；]")
SHORT = 25  # characters of a paragraph that gives no points


class Element:
    __slots__ = ("tag", "children", "parent", "marks", "score", "text_length", "link_length", "within", "doubt")

    def __init__(self, tag: str, parent: Element | None, marks: dict[str, str]) -> None:
        self.tag, self.parent, self.marks = tag, parent, marks
        self.children: list[Element | str] = []
        self.score = self.within = 0.0  # within: points of all paragraphs below
        self.doubt: bool | None = None
        self.text_length = self.link_length = 0

    def dropped(self) -> bool:
        if self.tag in DROPPED:
            return not (self.tag == "header" and any(p.tag in ("article", "main") for p in ancestors(self)))
        if not self.marks:
            return False
        marks = self.marks
        if "hidden" in marks or marks.get("aria-hidden", "").lower() == "true" or marks.get("role", "").lower() in ROLES:
            return True
        if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", marks.get("style", ""), re.I):
            return True
        names = f"{marks.get('class', '')} {marks.get('id', '')}".strip()
        if not names or self.tag in ("html", "body", "article", "main") or LIKELY.search(names):
            return False
        if self.doubt is None:
            self.doubt = bool(UNLIKELY.search(names)) or bool(DOUBTFUL.search(names)) and not has_prose(self)
        return self.doubt


def ancestors(node: Element) -> Iterator[Element]:
    while node.parent is not None:
        node = node.parent
        yield node


def has_prose(node: Element) -> bool:
    """Whether an element has a paragraph of some length, and little of its text in links."""
    text = linked = longest = 0
    stack = [(node, False, False)]
    while stack:
        at, in_link, in_paragraph = stack.pop()
        in_link, in_paragraph = in_link or at.tag == "a", in_paragraph or at.tag in PARAGRAPHS
        own = 0
        for child in at.children:
            if isinstance(child, str):
                own += len(child.strip())
            elif child.tag not in RAW:
                stack.append((child, in_link, in_paragraph))
        text, linked = text + own, linked + own * in_link
        if in_paragraph and not in_link:
            longest = max(longest, own)
    return longest >= 2 * SHORT and linked < 0.3 * text


def parse(html: str) -> Element:
    """The tree of a page. Unclosed elements end where their parent does; stray ends are passed over."""
    root = at = Element("html", None, {})
    place, in_head = 0, False
    while True:
        opened = html.find("<", place)
        if opened < 0:
            break
        found = TAG.match(html, opened)
        if found is None:  # a lone sign
            at.children.append(html[place : opened + 1])
            place = opened + 1
            continue
        if opened > place:
            at.children.append(html[place:opened])
        place = found.end()
        name = found[2]
        if name is None:
            continue
        tag = name.lower()
        if found[1]:
            node = at
            while node is not None and node.tag != tag:
                if tag not in ("html", "body") and node.tag in ("article", "main", "td", "table") and tag in ("b", "i", "a", "span", "em", "strong", "p"):
                    node = None
                    break
                node = node.parent
            if node is not None and node.parent is not None:
                at = node.parent
            in_head = in_head and tag != "head"
            continue
        if tag == "html":
            continue
        if tag == "body" or in_head and tag not in HEAD:
            at = root
        in_head = tag == "head" or in_head and tag in HEAD
        if tag in CLOSES_P:
            node = at
            while node.parent is not None and (node.tag not in BLOCKS or node.tag == "p"):
                if node.tag == "p":
                    at = node.parent
                    break
                node = node.parent
        if tag in ENDS:
            kinds, limit = ENDS[tag]
            node = at
            while node.parent is not None and node.tag not in limit:
                if node.tag in kinds:
                    at = node.parent
                node = node.parent
        marks = {}
        if found[3].strip(" \t\r\n/"):
            for key, a, b, c in ATTRIBUTE.findall(found[3]):
                marks.setdefault(key.lower(), unescape(a or b or c))
        node = Element(tag, at, marks)
        at.children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(html, place)
            close = html.find(">", end.end() - 1) if end else -1
            if tag in ("textarea", "title"):
                node.children.append(html[place : end.start() if end else len(html)])
            place = close + 1 if close >= 0 else len(html)
        elif tag not in VOID and not found[3].rstrip().endswith("/") or tag in BLOCKS and tag not in VOID:
            at = node
    if place < len(html):
        at.children.append(html[place:])
    return root


def measure(root: Element) -> list[Element]:
    """Lengths of text and of link text of every element that is not dropped, and its points."""
    order: list[tuple[Element, bool]] = []
    stack = [(root, False)]
    while stack:
        node, in_link = stack.pop()
        order.append((node, in_link))
        stack.extend((c, in_link or c.tag == "a") for c in reversed(node.children) if isinstance(c, Element) and not c.dropped())
    for node, in_link in reversed(order):
        own = sum(len(SPACE.sub(" ", unescape(c)).strip()) for c in node.children if isinstance(c, str))
        node.text_length += own
        if in_link or node.tag == "a":
            node.link_length = node.text_length
        if node.parent is not None:
            node.parent.text_length += node.text_length
            node.parent.link_length += node.link_length
    for node, _ in order:
        if node.tag not in PARAGRAPHS or node.parent is None or node.text_length < SHORT:
            continue
        points = (1 + len(COMMAS.findall(direct_text(node))) + min(node.text_length / 100, 3)) * (1 - link_density(node))
        for depth, above in enumerate(ancestors(node)):
            if depth < 2:
                above.score += points / (depth + 1)
            else:
                break
        node.within += points
    for node, _ in reversed(order):
        if node.parent is not None:
            node.parent.within += node.within
    for node, _ in order:
        if node.score:
            names = f"{node.marks.get('class', '')} {node.marks.get('id', '')}"
            node.score += 5 * (node.tag in ("article", "main")) + 3 * bool(LIKELY.search(names))
            node.score *= 1 - link_density(node)
    return [node for node, _ in order]


def link_density(node: Element) -> float:
    return min(1.0, node.link_length / node.text_length) if node.text_length else 0.0


def direct_text(node: Element) -> str:
    out, stack = [], [node]
    while stack:
        at = stack.pop()
        for child in at.children:
            if isinstance(child, str):
                out.append(child)
            elif child.tag not in BLOCKS and not child.dropped():
                stack.append(child)
    return " ".join(out)


def blocks(nodes: list[Element]) -> list[str]:
    """The text of the blocks within the elements, in page order."""
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = SPACE.sub(" ", "".join(line)).strip()
        line.clear()
        if text:
            out.append(text)

    for top in nodes:
        stack: list = [top]
        while stack:
            item = stack.pop()
            if item is None:
                end()
            elif isinstance(item, str):
                line.append(unescape(item))
            elif item.tag == "br":
                line.append(" ")
            elif item is top or not item.dropped():
                if item.tag in BLOCKS:
                    end()
                    stack.append(None)
                stack.extend(reversed(item.children))
        end()
    return out


def climbed(best: Element) -> Element:
    """The outermost element around ``best`` that has paragraphs besides it and few links."""
    chosen = best
    for above in ancestors(best):
        if above.parent is None or above.tag == "body" or link_density(above) >= 0.3:
            break
        if above.within > chosen.within + 0.5:
            chosen = above
    return chosen


def main_text(html: str | None) -> str:
    if not html:
        return ""
    nodes = measure(parse(html))
    best = max(nodes, key=lambda n: n.score)
    if best.score <= 0:
        return "\n\n".join(blocks([nodes[0]])) if nodes[0].text_length and link_density(nodes[0]) < 0.5 else ""
    for above in ancestors(best):  # an article whose parts each score as containers is taken whole
        if above.tag in ("article", "main"):
            best = above
            break
    if best.tag not in ("article", "main"):
        best = climbed(best)
    kept = [best]
    if best.parent is not None and best.tag not in ("article", "main", "body"):
        limit = max(10.0, best.score / 5)
        kept = []
        for sibling in best.parent.children:
            if not isinstance(sibling, Element) or (sibling is not best and sibling.dropped()):
                continue
            prose = sibling.tag in PARAGRAPHS and sibling.text_length and (
                link_density(sibling) < 0.25 if sibling.text_length > 80 else sibling.link_length == 0)
            if sibling is best or sibling.score >= limit or prose:
                kept.append(sibling)
    elif best.parent is not None and best.tag == "article":  # pages cut into several articles
        kept = [s for s in best.parent.children if s is best or (isinstance(s, Element) and s.tag == "article" and not s.dropped() and s.score >= best.score / 5)]
    return "\n\n".join(blocks(kept))


def extract(df: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` and ``text``, ``n_chars`` of each page."""
    import pyarrow as pa

    kept = df.select(*keep)
    schema = T.StructType([*kept.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(v.as_py()) for v in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=schema.names)

    return df.select(*keep, df[html].cast("string").alias("_html_")).mapInArrow(read, schema)
